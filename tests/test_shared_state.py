"""Profiles of one run from one scan a table; counts from footers; lists that prune; catalog views from folders."""

import re

import pytest
from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from tablewatch.operators import Variant, column_profiles, footer_row_counts, listed_source_rows, measure_profiles, table_profile
from tablewatch.operators.profile_state import state_plan
from tablewatch.plans import driver_queries
from tablewatch.sources import store
from tablewatch.sources.warehouse import warehouse_view


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_validation_run_scans_each_table_once(spark):
    bases, variants = driver_queries._state_inputs(spark, SF_SMALL, *driver_queries.REPORT_GROUPS)
    plan = executed(state_plan(bases, variants)).split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet.*?(\w+)\.parquet", plan)
    assert sorted(scans) == ["customer", "events", "lineitem", "nation", "orders", "part"]


def test_reports_read_the_measured_rows_only(spark):
    state = driver_queries._measured(spark, SF_SMALL, *driver_queries.REPORT_GROUPS)
    run = driver_queries._validate(state, driver_queries.LOAD_AS_OF)
    for df in run.reports().values():
        assert "FileScan" not in executed(df)


def test_variants_equal_separate_profiles(spark):
    base = spark.createDataFrame(
        [(1, "ab", "2024-01-01 00:00:00"), (2, None, None), (3, "abcd", "2024-01-03 00:00:00"), (None, "x" * 9, None)],
        "k int, s string, t string",
    ).withColumn("t", F.col("t").cast("timestamp"))
    key = ("C", "S", "T")
    some = F.col("k") < 3
    variants = {
        ("a", key): Variant("b", changed="t", observe=True),
        ("b", key): Variant("b", {"K2": F.col("k") * 2, "S2": F.nullif(F.col("s"), F.lit("ab"))}, some, "t", True),
        ("c", key): Variant("b", where=F.lit(False), changed="t", observe=True),
    }
    state = measure_profiles(spark, {"b": base}, variants)
    made = {
        "a": base,
        "b": base.where(some).select((F.col("k") * 2).alias("K2"), F.nullif(F.col("s"), F.lit("ab")).alias("S2")),
        "c": base.where("false"),
    }
    for group, df in made.items():
        assert state.column_profile(group).collect() == column_profiles(spark, {key: df}).collect()
        whole = {"a": base, "b": base.where(some), "c": base.where("false")}[group]
        want = table_profile(spark, {key: whole}, last_altered="t").first()
        got = state.table_profile(group).first()
        assert (got.row_count, got.last_altered) == (want.row_count, want.last_altered)
        assert got.column_count == len(df.columns)


def test_partition_counts_come_from_footers(spark, scratch):
    path = scratch("parted")
    rows = spark.range(60).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("x=/"), F.col("id") % 2)).alias("b"), "id")
    rows.repartition(3).write.partitionBy("a", "b").parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    df = footer_row_counts(spark, path, "T")
    plan = executed(df)
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [a, b]" in plan
    got = {r.partition: r.rows for r in df.collect()}
    want = {(r.a, r.b): r["count"] for r in rows.groupBy("a", "b").count().collect()}
    assert len(got) == len(want) == 9 and sum(got.values()) == 60
    assert got["a=1/b=__HIVE_DEFAULT_PARTITION__"] == want[1, None] and got["a=2/b=x=/1"] == want[2, "x=/1"]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_a_listed_source_is_pruned_by_the_join(spark, scratch):
    root, names = scratch("source"), scratch("names")
    spark.range(30).select("id", F.concat(F.lit("t"), F.col("id") % 5).alias("table_name")).write.partitionBy("table_name").parquet(root)
    spark.createDataFrame([(f"t{i}", "Y" if i < 2 else "N") for i in range(5)], "table_name string, wanted string").write.parquet(names)
    out = listed_source_rows(spark.read.parquet(root), spark.read.parquet(names).where("wanted = 'Y'"))
    plan = executed(out)
    assert "dynamicpruningexpression(table_name" in plan
    assert {(r.table_name, r.source_rows) for r in out.collect()} == {("T0", 6), ("T1", 6)}


@pytest.fixture()
def warehouse(spark, scratch):
    root = scratch("warehouse")
    spark.range(4).selectExpr("id", "cast(id as string) AS name").repartition(2).write.parquet(f"{root}/A/one")
    spark.range(5).write.parquet(f"{root}/A/two")
    spark.range(6).write.parquet(f"{root}/B/one")
    store.create_once(spark, f"{root}/BROKEN/t/part-0.parquet", "no Parquet at all")
    return root


def test_catalog_views_of_a_folder(spark, warehouse):
    tables = warehouse_view(spark, warehouse, "tables", "C").where("TABLE_SCHEMA IN ('A', 'B')")
    assert {(r.TABLE_SCHEMA, r.TABLE_NAME, r.ROW_COUNT) for r in tables.collect()} == {("A", "one", 4), ("A", "two", 5), ("B", "one", 6)}
    columns = warehouse_view(spark, warehouse, "columns").where("TABLE_SCHEMA = 'A' AND TABLE_NAME = 'one'").orderBy("ORDINAL_POSITION")
    assert [(r.COLUMN_NAME, r.DATA_TYPE) for r in columns.collect()] == [("id", "bigint"), ("name", "string")]


def test_a_listed_schema_alone_is_visited(spark, warehouse):
    """The folder BROKEN cannot be read: only a view that does not open it succeeds."""
    view = warehouse_view(spark, warehouse, "tables")
    assert view.where("TABLE_SCHEMA = 'A'").count() == 2
    assert view.where("TABLE_SCHEMA = 'B'").count() == 1
    assert view.where("TABLE_SCHEMA = 'GONE'").count() == 0
    assert view.where("TABLE_SCHEMA = 'A' AND TABLE_SCHEMA IN ('B', 'C')").count() == 0
    with pytest.raises(Exception):
        view.count()
