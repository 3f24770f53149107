"""Daily ingest audit (FIXTURES 3.5) and job-status ids."""

import datetime as dt

from pyspark.sql import functions as F

from tablewatch.operators import audit_all, daily_ingest_counts, to_job_status, with_job_ids
from tablewatch.plans import run_daily_audit
from tablewatch.schemas import JOB_STATUS_COLUMNS
from tablewatch.sources import read_delimited_config

from sf_paths import SF_MID, SF_SMALL

CONFIG = [("ORDERS", "o_orderdate"), ("LINEITEM", "l_shipdate"), ("EVENTS", "ts")]


def _tables(sf):
    return {n: f"{sf}/{n.lower()}.parquet" for n, _ in CONFIG}


def _counts(spark, sf, as_of):
    return {r.table_name: r.ingested_rows for r in audit_all(spark, CONFIG, _tables(sf), as_of).collect()}


def test_fixture_counts(spark):
    assert _counts(spark, SF_SMALL, "1998-06-02") == {"ORDERS": 3, "LINEITEM": 3}
    assert _counts(spark, SF_MID, "1998-06-02") == {"ORDERS": 8, "LINEITEM": 19}
    assert _counts(spark, SF_SMALL, "2024-01-30") == {"EVENTS": 23}
    assert _counts(spark, SF_MID, "2024-01-30") == {"EVENTS": 345}


def test_include_empty_gives_zero_row(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rows = daily_ingest_counts(ev, "EVENTS", "TS", "1998-06-02", include_empty=True).collect()
    assert [(r.ingest_date, r.ingested_rows) for r in rows] == [(dt.date(1998, 6, 1), 0)]


def test_date_filter_reaches_scan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = daily_ingest_counts(ev, "EVENTS", "ts", "2024-01-30")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_job_status_projection(spark):
    counts = spark.createDataFrame([("ORDERS", dt.date(1998, 6, 1), 8)], "table_name string, ingest_date date, ingested_rows long")
    r = to_job_status(counts, schema_name="S", job_type="AUDIT", dag_id="d", as_of="1998-06-02").first()
    assert (r.task_id, r.recs_inserted, r.recs_parsed, r.failure_reason) == ("task_ORDERS", 8, 0, "NULL")
    assert r.job_start_ts == r.job_end_ts == dt.datetime(1998, 6, 2)


def test_ids_continue_across_runs(spark, scratch):
    log = scratch("log")
    cfg_path = scratch("cfg")
    spark.createDataFrame(CONFIG, "OBJECT_NAME string, DATE_COLUMN string").coalesce(1).write.option(
        "header", True).option("sep", "|").csv(cfg_path)
    cfg = read_delimited_config(spark, cfg_path)
    for as_of in ("1998-06-02", "1998-06-03"):
        run_daily_audit(spark, cfg, _tables(SF_SMALL), as_of, log=log, schema_name="S", job_type="AUDIT", dag_id="d")
    rows = spark.read.parquet(log).orderBy("job_id").collect()
    assert [r.job_id for r in rows] == list(range(1, len(rows) + 1))
    assert spark.read.parquet(log).columns == JOB_STATUS_COLUMNS
    assert [r.dag_run_exec_date for r in rows] == sorted(r.dag_run_exec_date for r in rows)


def test_with_job_ids_start_after(spark):
    rows = spark.createDataFrame([("B",), ("A",)], "table_name string").select(
        *[F.lit(None).alias(c) for c in JOB_STATUS_COLUMNS if c != "table_name"], "table_name"
    ).withColumn("dag_run_exec_date", F.lit(dt.date(2024, 1, 1))).withColumn("task_id", F.col("table_name"))
    got = [(r.table_name, r.job_id) for r in with_job_ids(rows, 41).orderBy("job_id").collect()]
    assert got == [("A", 42), ("B", 43)]


def test_consecutive_ids_split_a_hot_key(spark):
    from tablewatch.operators.sequence import consecutive_ids

    df = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("hot"), F.col("id").alias("v"))
    df = df.withColumn("k", F.when(F.col("v") < 1000, F.lit("A")).otherwise(F.concat(F.lit("B"), F.col("v").cast("string"))))
    out = consecutive_ids(df, [F.col("k")], 10, "seq")
    rows = out.select("k", "seq").collect()
    assert sorted(r.seq for r in rows) == list(range(11, 3011))
    a_ids = sorted(r.seq for r in rows if r.k == "A")
    assert a_ids == list(range(11, 1011))  # the hot key comes first, numbered without gaps
    parts = out.rdd.getNumPartitions()
    assert parts >= 1


def test_text_dates_with_format(spark):
    df = spark.createDataFrame([("01/06/1998",), ("01/06/1998",), ("02/06/1998",)], "d string")
    rows = daily_ingest_counts(df, "T", "d", "1998-06-02", date_format="dd/MM/yyyy").collect()
    assert [(r.ingest_date, r.ingested_rows) for r in rows] == [(dt.date(1998, 6, 1), 2)]


def test_unreadable_table_gets_a_failure_row(spark, scratch):
    log = scratch("log")
    config = CONFIG + [("GONE", "d"), ("EVENTS2", "no_such_col")]
    tables = {**_tables(SF_SMALL), "GONE": f"{SF_SMALL}/gone.parquet", "EVENTS2": f"{SF_SMALL}/events.parquet"}
    run_daily_audit(spark, config, tables, "2024-01-30", log=log, schema_name="S", job_type="AUDIT", dag_id="d")
    rows = {r.table_name: r for r in spark.read.parquet(log).collect()}
    assert rows["EVENTS"].job_status == "SUCCESS" and rows["EVENTS"].recs_inserted == 23
    assert rows["GONE"].job_status == "FAILURE" and rows["GONE"].failure_reason
    assert rows["EVENTS2"].job_status == "FAILURE" and "no_such_col" in rows["EVENTS2"].failure_reason
    assert sorted(r.job_id for r in rows.values()) == [1, 2, 3]


def test_driver_held_records_are_numbered_on_the_driver(spark, monkeypatch):
    import tablewatch.operators.audit as audit
    from tablewatch.operators import JobMeta, job_status_row

    def fail(*a, **k):
        raise AssertionError("distributed numbering used for a local record")

    monkeypatch.setattr(audit, "consecutive_ids", fail)
    rec = job_status_row(spark, JobMeta("S", "T", "t"), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), "SUCCESS")
    assert [r.job_id for r in with_job_ids(rec, 9).collect()] == [10]
