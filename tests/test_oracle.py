"""Every registered query of the library's own operators equals its oracle SQL (DuckDB) on sf0.001."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle_check import compare, duck

from sf_paths import SF_SMALL
from tablewatch.plans import driver_queries


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, con)
    assert r["plan_flags"] == [], r
    assert r["columns_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 1 and rows[0].recs_inserted == 23 and rows[0].table_name == "EVENTS"


def test_every_query_has_oracle():
    assert set(driver_queries.QUERIES) <= set(entry.queries()) and set(driver_queries.QUERIES) <= set(entry.oracle_sql())


def test_column_queries_profile_every_row_and_table(spark, monkeypatch):
    late = dt.datetime(2001, 8, 1)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    changed = F.when(F.col("o_orderdate") < F.lit(late).cast("timestamp_ntz"), F.col("o_orderstatus")).otherwise("a longer status")
    read = driver_queries._t
    monkeypatch.setattr(
        driver_queries, "_t", lambda s, d, n: orders.withColumn("o_orderstatus", changed) if n == "orders" else read(s, d, n)
    )
    target, replica = driver_queries._column_inputs(driver_queries._measured(spark, SF_SMALL, "columns"))
    status = target.where("table_name = 'ORDERS' and column_name = 'o_orderstatus'").collect()
    assert [r.character_maximum_length for r in status] == [len("a longer status")]
    profiled = {r.column_name for r in replica.where("table_name = 'LINEITEM'").collect()}
    assert profiled == set(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").columns)
