"""Run registered queries in Spark and their oracle SQL in DuckDB and compare the results.

Usable from pytest (``compare``) and as a script::

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

# Physical operators that must not appear in any registered query: Python UDF evaluation,
# cartesian products and nested-loop joins.
FORBIDDEN_PLAN_NODES = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def normalise(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(canon(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    import __spark_entry__ as entry

    con = con or duck(sf_dir)
    t0 = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got_cols, got = normalise(df.columns, [tuple(r) for r in df.collect()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark_sec = time.time() - t0
    res = {"query": name, "spark_sec": round(spark_sec, 2), "rows": len(got)}
    res["plan_flags"] = [bad for bad in FORBIDDEN_PLAN_NODES if bad in plan]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    cur = con.execute(sql)
    exp_cols, exp = normalise([d[0] for d in cur.description], cur.fetchall())
    res.update(
        oracle_rows=len(exp),
        columns_match=got_cols == exp_cols,
        values_match=got == exp,
    )
    if got_cols != exp_cols:
        res["spark_columns"], res["oracle_columns"] = got_cols, exp_cols
    elif got != exp:
        res["only_spark"] = [r for r in got if r not in exp][:3]
        res["only_oracle"] = [r for r in exp if r not in got][:3]
    return res


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("ORACLE_TZ", "UTC"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as err:  # noqa: BLE001
            r = {"query": n, "error": str(err)[:600]}
        ok = r.get("values_match") and r.get("columns_match") and r.get("rows") == r.get("oracle_rows")
        bad += 0 if ok else 1
        print(("OK  " if ok else "FAIL"), r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
