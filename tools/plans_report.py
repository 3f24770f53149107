"""Write PLANS.md: the physical plans of the main operators on the sf0.01 tables.

    python tools/plans_report.py [sf_dir]
"""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def plan_text(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


def main(argv: list[str]) -> None:
    from pyspark.sql import functions as F

    from tablewatch.operators import (
        daily_ingest_counts,
        file_row_counts,
        freshness,
        load_raw_json,
        reconcile_counts,
        table_profile,
    )
    from tablewatch.operators.profile import column_stats_plan
    from tablewatch.operators.sequence import consecutive_ids
    from tablewatch.plans import driver_queries as Q
    from tablewatch.session import build_session, scratch_path

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("plans", master="local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")

    stage = scratch_path(spark, "plans-json")
    t("events").select(F.to_json(F.struct(F.col("event_id").alias("id"), "event_type")).alias("value")).write.text(stage)
    load = load_raw_json(spark, stage, {"id": "$.id"}, "2024-01-31")
    observed = (
        load.observe(
            "load",
            F.count(F.lit(1)).alias("parsed"),
            F.count_if(F.col("_corrupt_record").isNotNull()).alias("rejected"),
        )
        .where(F.col("_corrupt_record").isNull())
        .drop("_corrupt_record")
    )

    tp, rp, legacy = Q._count_inputs(spark, sf)
    cases = [
        ("AUD-1 day count: the date filter is a range in PushedFilters, only `ts` is read",
         daily_ingest_counts(t("events"), "EVENTS", "ts", "2024-01-30")),
        ("REC-1 row count: empty ReadSchema (no column is decoded)",
         table_profile(spark, {"orders": t("orders")}, measure=False)),
        ("REC-2 column statistics: one scan, one partial and one final aggregate for all columns",
         column_stats_plan(t("orders"))),
        ("REC-7 per-file counts: partial aggregate per file before the shuffle",
         file_row_counts(t("lineitem"), "LINEITEM")),
        ("ING-1 raw JSON load as written (corrupt lines filtered after the metrics are observed)", observed),
        ("REC-11 freshness per group: partial max", freshness(t("events"), ["event_type"], "ts", "2024-01-31")),
        ("REC-4 reconciliation: reads only measured profile rows (LocalTableScan), joins broadcast by size",
         reconcile_counts(tp, rp, legacy, as_of="2024-01-31", extra=["lineitem"])),
        ("AUD-3 sequence ids: rows numbered per range partition plus a broadcast offset per partition",
         consecutive_ids(t("events").select("event_type", "event_id"), [F.col("event_type")], 0, "seq")),
    ]
    out = ["# Physical plans of the main operators", "",
           "Generated by `tools/plans_report.py` on the sf0.01 tables (`local[8]`, AQE on). Each query is",
           "run first, so the adaptive plans are the final ones (`isFinalPlan=true`).", ""]
    for title, df in cases:
        df.collect()  # run it, so the adaptive plan below is the final one
        out += [f"## {title}", "", "```", plan_text(df).strip(), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
