"""Catalog tables as sinks and profile inputs, CSV stream pickup, JDBC option checks."""

import datetime as dt

import pytest

from tablewatch.operators import append_load, table_profile
from tablewatch.sources import TableRef, database_tables, read_table, table_exists
from tablewatch.sources.jdbc import read_jdbc
from tablewatch.streaming import ingest_new_csv_files


def test_catalog_append_creates_then_appends(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_reports")
    name = "tw_reports.counts_log"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not table_exists(spark, name)
    for _ in range(2):
        append_load(spark.range(3).toDF("n"), name)
    assert table_exists(spark, TableRef(name))
    assert read_table(spark, name).count() == 6
    spark.sql("CREATE OR REPLACE VIEW tw_reports.v AS SELECT * FROM tw_reports.counts_log")
    tables = database_tables(spark, "tw_reports")
    assert tables == {"counts_log": "tw_reports.counts_log"}
    prof = table_profile(spark, tables, schema="tw_reports").collect()
    assert [(r.table_name, r.row_count, r.column_count) for r in prof] == [("counts_log", 6, 1)]
    from tablewatch.sources import tables_in

    keyed = tables_in(spark, "tw_reports")
    assert list(keyed.values()) == ["tw_reports.counts_log"]
    prof2 = table_profile(spark, keyed).collect()
    assert [(r.table_catalog, r.table_schema, r.table_name, r.row_count) for r in prof2] == [
        ("spark_catalog", "tw_reports", "counts_log", 6)
    ]


def test_csv_stream_picks_up_new_files_once(spark, scratch):
    prefix, target, ck = scratch("csv-landing"), scratch("csv-t"), scratch("csv-ck")
    schema = "id int, name string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.option("header", True).csv(f"{prefix}/b1")
    r1 = ingest_new_csv_files(spark, f"{prefix}/*", target, ck, schema)
    spark.createDataFrame([(3, "c")], schema).write.option("header", True).csv(f"{prefix}/b2")
    r2 = ingest_new_csv_files(spark, f"{prefix}/*", target, ck, schema)
    r3 = ingest_new_csv_files(spark, f"{prefix}/*", target, ck, schema)
    assert (r1.rows, r2.rows, r3.rows) == (2, 1, 0)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_partitioned_jdbc_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://nowhere", "t", partition_column="id", num_partitions=8)


def test_partition_row_counts_from_catalog_views(spark):
    from tablewatch.sources.jdbc import partition_row_counts

    parts = spark.createDataFrame(
        [(1, 0, 10), (1, 0, 5), (1, 2, 15), (2, 1, 7), (2, 3, 7), (3, 1, 4)],
        "object_id int, index_id int, rows long",
    )
    tables = spark.createDataFrame([(1, "books", 1), (2, "MixedCase", 1), (3, "other", 2)], "object_id int, name string, schema_id int")
    got = {r.table_name: r.source_rows for r in partition_row_counts(parts, tables, restrict_to=["BOOKS", "mixedcase"]).collect()}
    assert got == {"BOOKS": 15, "MIXEDCASE": 7}


def test_jdbc_ref_is_not_a_path():
    ref = TableRef("ops.load_log", "jdbc", {"url": "jdbc:postgresql://db/x"})
    assert ref.is_jdbc and not ref.is_path
    assert TableRef("/data/t").is_path and not TableRef("db.t").is_path


def test_catalog_views_as_profiles(spark):
    from tablewatch.sources.jdbc import catalog_columns, catalog_tables

    tables = spark.createDataFrame(
        [("PROD", "SALES", "ORDERS", "BASE TABLE", 10, dt.datetime(2024, 1, 30, 8)),
         ("PROD", "SALES", "V_ORDERS", "VIEW", None, None),
         ("PROD", "SALES", "DATABASECHANGELOG", "BASE TABLE", 3, None),
         ("PROD", "OTHER", "X", "BASE TABLE", 1, None)],
        "TABLE_CATALOG string, TABLE_SCHEMA string, TABLE_NAME string, TABLE_TYPE string, ROW_COUNT long, LAST_ALTERED timestamp_ntz",
    )
    columns = spark.createDataFrame(
        [("PROD", "SALES", "ORDERS", "O_KEY", 1, "NO", "NUMBER", None),
         ("PROD", "SALES", "ORDERS", "O_NAME", 2, "YES", "TEXT", 10),
         ("PROD", "SALES", "V_ORDERS", "O_KEY", 1, "NO", "NUMBER", None)],
        "TABLE_CATALOG string, TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, "
        "IS_NULLABLE string, DATA_TYPE string, CHARACTER_MAXIMUM_LENGTH int",
    )
    prof = catalog_tables(tables, columns, schemas=["SALES"]).collect()
    assert [(r.table_name, r.row_count, r.column_count, r.last_altered) for r in prof] == [
        ("ORDERS", 10, 2, dt.datetime(2024, 1, 30, 8))
    ]
    cols = catalog_columns(columns, schemas=["SALES"]).where("table_name = 'ORDERS'").orderBy("ordinal_position").collect()
    assert [(c.column_name, c.is_nullable, c.character_maximum_length) for c in cols] == [("O_KEY", "NO", None), ("O_NAME", "YES", 10)]
