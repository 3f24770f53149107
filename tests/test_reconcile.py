"""Reconciliation operators on literal frames (FIXTURES 3.1) and properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewatch.operators import (
    column_drift,
    failed_rows,
    inventory,
    merge_sources,
    merged_report,
    missing_columns,
    reconcile_counts,
    table_profile,
    with_checks,
)
from tablewatch.schemas import COLUMN_PROFILE, TABLE_PROFILE

AS_OF = dt.datetime(2024, 1, 31)

SOURCE = [
    ("ORDERS", "O_KEY", "NO", "NUMBER", None),
    ("ORDERS", "O_NAME", "YES", "TEXT", 10),
    ("ORDERS", "O_WID", "YES", "NUMBER", None),
    ("ORDERS", "O_LEN", "YES", "TEXT", 10),
    ("ORDERS", "O_ONE", "NO", "TEXT", 1),
    ("ORDERS", "O_SRCONLY", "YES", "DATE", None),
    ("CUST", "C_OK", "NO", "TEXT", 5),
]
TARGET = [
    ("ORDERS", "O_KEY", "YES", "NUMBER", None),
    ("ORDERS", "O_NAME", "YES", "TEXT2", 10),
    ("ORDERS", "O_WID", "YES", "FLOAT", None),
    ("ORDERS", "O_LEN", "YES", "TEXT", 20),
    ("ORDERS", "O_ONE", "YES", "TEXT", None),
    ("ORDERS", "O_NEW", "YES", "TEXT", 3),
    ("CUST", "C_OK", "NO", "TEXT", 5),
    ("GHOST", "G_A", "YES", "TEXT", 1),
]


def _cols(spark, rows, schema):
    full = [("DB", schema, t, c, i, n, ty, ln) for i, (t, c, n, ty, ln) in enumerate(rows, start=1)]
    return spark.createDataFrame(full, COLUMN_PROFILE)


@pytest.fixture()
def cols(spark):
    return _cols(spark, SOURCE, "REPLICA"), _cols(spark, TARGET, "SALES")


def test_drift_rows(cols):
    src, tgt = cols
    got = {
        r.target_column_name: (r.data_type_length_check, r.is_nullable_check)
        for r in column_drift(src, tgt, as_of=AS_OF).collect()
    }
    assert got == {"O_KEY": ("Y", "N"), "O_NAME": ("N", "Y"), "O_ONE": ("Y", "N"), "O_WID": ("Y", "Y")}


def test_drift_length_only_is_opt_in(cols):
    src, tgt = cols
    got = {r.target_column_name for r in column_drift(src, tgt, as_of=AS_OF, include_length=True).collect()}
    assert "O_LEN" in got and "C_OK" not in got


def test_missing_columns_one_way(cols):
    src, tgt = cols
    got = [(r.target_table_name, r.target_column_name, r.column_name_check) for r in missing_columns(tgt, src, as_of=AS_OF).collect()]
    assert got == [("ORDERS", "O_NEW", "N")]


def test_missing_columns_of_itself_is_empty(cols):
    src, _ = cols
    assert missing_columns(src, src, as_of=AS_OF).count() == 0


def _profile(spark, rows, schema):
    return spark.createDataFrame(
        [("DB", schema, n, "BASE TABLE", r, c, la) for n, r, c, la in rows], TABLE_PROFILE
    )


def test_reconcile_counts_three_way(spark):
    fresh = AS_OF - dt.timedelta(hours=1)
    tgt = _profile(spark, [("ORDERS", 10, 7, fresh), ("CUSTOMER", 5, 5, None), ("EVENTS", 3, 6, None)], "SALES")
    rep = _profile(spark, [("orders", 12, 6, None), ("customer", 5, 5, None), ("SNAP", 9, 4, None)], "REPLICA")
    legacy = spark.createDataFrame([("ORDERS", 12, 6), ("CUSTOMER", 5, 5)], "tablename string, rowcount long, columncount long")
    rows = {r.table_view_name: r for r in reconcile_counts(tgt, rep, legacy, as_of=AS_OF, extra=["SNAP"]).collect()}
    assert set(rows) == {"ORDERS", "CUSTOMER", "SNAP"}  # EVENTS: target only, inner pairing
    assert (rows["ORDERS"].rows_match_check, rows["ORDERS"].columns_match_check, rows["ORDERS"].daily_refresh_check) == ("N", "N", "Y")
    assert (rows["CUSTOMER"].rows_match_check, rows["CUSTOMER"].columns_match_check, rows["CUSTOMER"].daily_refresh_check) == ("Y", "Y", "")
    assert rows["SNAP"].target_rows is None and rows["SNAP"].rows_match_check == "N"


def test_reconcile_of_itself_is_all_yes(spark):
    p = _profile(spark, [("A", 1, 2, AS_OF), ("B", 3, 4, AS_OF)], "S")
    legacy = p.select(F.col("table_name").alias("tablename"), F.col("row_count").alias("rowcount"), F.col("column_count").alias("columncount"))
    out = reconcile_counts(p, p, legacy, as_of=AS_OF).collect()
    assert {(r.rows_match_check, r.columns_match_check, r.daily_refresh_check) for r in out} == {("Y", "Y", "Y")}


def test_inventory_name_only_match_adds_up_same_named_tables(spark):
    prof = _profile(spark, [("T", 1, 0, None)], "S1").unionByName(_profile(spark, [("T", 2, 0, None)], "S2"))
    cols = spark.createDataFrame(
        [("DB", "S1", "T", "a", 1, "YES", "int", None), ("DB", "S2", "T", "a", 1, "YES", "int", None),
         ("DB", "S2", "T", "b", 2, "YES", "int", None)], COLUMN_PROFILE)
    full = {(r.schema_name, r.target_columns) for r in inventory(prof, cols, as_of=AS_OF).collect()}
    assert full == {("S1", 1), ("S2", 2)}
    by_name = {(r.schema_name, r.target_columns) for r in inventory(prof, cols, as_of=AS_OF, match_on=("table_name",)).collect()}
    assert by_name == {("S1", 3), ("S2", 3)}


def test_merged_report_and_failed_subset(spark):
    prof = _profile(spark, [("A", 5, 2, AS_OF), ("B", 5, 2, None)], "S1").unionByName(_profile(spark, [("C", 1, 1, None)], "S3"))
    cols = spark.createDataFrame(
        [("DB", "S1", "A", "x", 1, "YES", "int", None), ("DB", "S1", "A", "y", 2, "YES", "int", None),
         ("DB", "S1", "B", "x", 1, "YES", "int", None), ("DB", "S3", "C", "x", 1, "YES", "int", None)], COLUMN_PROFILE)
    src = spark.createDataFrame([("A", 5, 2), ("B", 4, 1)], "table_name string, source_rows long, source_columns long")
    inv = inventory(prof, cols, as_of=AS_OF)
    rep = merged_report(inv, {"S1": src, "S3": None}, AS_OF)
    rows = {r.table_name: r for r in rep.collect()}
    assert (rows["A"].rows_match_check, rows["A"].columns_match_check, rows["A"].daily_refresh_check) == ("Y", "Y", "Y")
    assert (rows["B"].rows_match_check, rows["B"].columns_match_check) == ("N", "Y")
    assert (rows["C"].rows_match_check, rows["C"].columns_match_check) == ("", "")
    failed = {r.table_name for r in failed_rows("merged", rep).collect()}
    assert failed == {"B", "C"} and failed <= set(rows)
    assert dict(zip(rep.columns, [f.dataType.simpleString() for f in rep.schema]))["source_rows"] == "bigint"


def test_table_profile_excludes_deny_list(spark):
    df = spark.range(3)
    prof = table_profile(spark, {"T": df, "DATABASECHANGELOG": df}).collect()
    assert [(r.table_name, r.row_count, r.column_count) for r in prof] == [("T", 3, 1)]


def test_validation_run_order_and_preview(spark, scratch):
    from tablewatch.plans import run_validation
    from tablewatch.operators import column_profiles

    a = spark.createDataFrame([(1, "x"), (2, None)], "k long, v string")
    b = spark.createDataFrame([(1, "x")], "k long, v string")
    tp = table_profile(spark, {"B": b, "A": a}, catalog="DB", schema="T")
    rp = table_profile(spark, {"a": a, "b": b}, catalog="DB", schema="R")
    tc = column_profiles(spark, {"A": a, "B": b}, catalog="DB", schema="T")
    rc = column_profiles(spark, {"A": b, "B": b}, catalog="DB", schema="R")
    sinks = {n: scratch(n) for n in ("counts", "drift", "missing", "merged")}
    run = run_validation(
        target_profile=tp, replica_profile=rp, target_columns=tc, replica_columns=rc,
        inventory_profiles=tp, inventory_columns=tc, sources={"T": None}, as_of=AS_OF, sinks=sinks,
    )
    assert [r.table_view_name for r in run.ordered()["counts"].collect()] == ["A", "B"]
    assert run.preview(1)["counts"].count() == 1
    drift = run.failed["drift"].collect()
    assert [(r.target_table_name, r.target_column_name, r.is_nullable_check) for r in drift] == [("A", "v", "N")]
    assert spark.read.parquet(sinks["merged"]).count() == 2


def test_d24_duplicate_legacy_rows_collapse_and_d26_left_keeps_target_only(spark):
    tgt = _profile(spark, [("ORDERS", 10, 7, None), ("EVENTS", 3, 6, None)], "SALES")
    rep = _profile(spark, [("orders", 10, 7, None)], "REPLICA")
    legacy = spark.createDataFrame([("ORDERS", 10, 7), ("ORDERS", 10, 7)], "tablename string, rowcount long, columncount long")
    inner = reconcile_counts(tgt, rep, legacy, as_of=AS_OF).collect()
    assert [(r.table_view_name, r.rows_match_check) for r in inner] == [("ORDERS", "Y")]
    left = {r.table_view_name: r for r in reconcile_counts(tgt, rep, legacy, as_of=AS_OF, how="left").collect()}
    assert set(left) == {"ORDERS", "EVENTS"}
    assert (left["EVENTS"].rows_match_check, left["EVENTS"].columns_match_check) == ("", "")


def test_merge_sources_and_checks(spark):
    inv = spark.createDataFrame(
        [("A", "S1", "DB", 5, 2, AS_OF), ("B", "S2", "DB", 1, 1, None), ("C", "S9", "DB", 1, 1, None)],
        "table_name string, schema_name string, database_name string, target_rows long, target_columns long, "
        "last_altered timestamp_ntz",
    )
    src = spark.createDataFrame([("A", 5, 3)], "table_name string, source_rows long, source_columns long")
    merged = merge_sources(inv, {"S1": src, "S2": None})
    assert sorted(r.table_name for r in merged.collect()) == ["A", "B"]  # S9 is not named
    flags = {r.table_name: (r.daily_refresh_check, r.columns_match_check, r.rows_match_check)
             for r in with_checks(merged, AS_OF).collect()}
    assert flags == {"A": ("Y", "N", "Y"), "B": ("", "", "")}


def test_reconcile_without_legacy_is_two_way(spark):
    tgt = _profile(spark, [("ORDERS", 10, 7, None), ("CUST", 5, 5, None)], "SALES")
    rep = _profile(spark, [("orders", 10, 6, None), ("cust", 4, 5, None)], "REPLICA")
    got = {r.table_view_name: (r.rows_match_check, r.columns_match_check) for r in reconcile_counts(tgt, rep, as_of=AS_OF).collect()}
    assert got == {"ORDERS": ("Y", "N"), "CUST": ("N", "Y")}


def test_validation_stores_lazy_profiles_when_asked(spark):
    from tablewatch.plans import run_validation
    from tablewatch.operators import column_profiles

    a = spark.createDataFrame([(1, "x")], "k long, v string")
    tp = table_profile(spark, {"A": a}, catalog="DB", schema="T", measure=False)
    rp = table_profile(spark, {"a": a}, catalog="DB", schema="R", measure=False)
    legacy = tp.select(F.col("table_name").alias("tablename"), F.col("row_count").alias("rowcount"),
                       F.col("column_count").alias("columncount"))
    cols = column_profiles(spark, {"A": a})
    run = run_validation(target_profile=tp, replica_profile=rp, target_columns=cols, replica_columns=cols,
                         inventory_profiles=tp, inventory_columns=cols, sources={"T": None}, as_of=AS_OF,
                         legacy=legacy, checkpoint=True)
    assert [(r.rows_match_check, r.columns_match_check) for r in run.counts.collect()] == [("Y", "Y")]
