"""Profiles: observed nullability and length, declared lengths, per-file sums, skipped objects."""

from tablewatch.operators import column_counts, column_profile, object_profile, source_profile, table_profile

from sf_paths import SF_SMALL


def test_column_profile_observed(spark):
    df = spark.createDataFrame([(1, "ab", None), (None, "abcd", None)], "a int, b string, c string")
    got = {r.column_name: (r.ordinal_position, r.is_nullable, r.data_type, r.character_maximum_length)
           for r in column_profile(df, "T").collect()}
    assert got == {"a": (1, "YES", "int", None), "b": (2, "NO", "string", 4), "c": (3, "YES", "string", None)}


def test_column_profile_is_one_aggregate(spark):
    from tablewatch.operators.profile import column_stats_plan

    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = column_stats_plan(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1


def test_column_profile_declared_varchar(spark, scratch):
    name = "tw_varchar_probe"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (v VARCHAR(12), n INT) USING parquet LOCATION '{scratch('vc')}'")
    got = {r.column_name: (r.data_type, r.character_maximum_length)
           for r in column_profile(spark.table(name), name, observe=False).collect()}
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert got == {"v": ("varchar", 12), "n": ("int", None)}


def test_column_counts(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    prof = column_profile(df, "T", observe=False)
    assert column_counts(prof).first().column_count == 2


def test_table_profile_count_reads_no_columns(spark):
    lazy = table_profile(spark, {"orders": f"{SF_SMALL}/orders.parquet"}, measure=False)
    plan = lazy._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert lazy.first().row_count == 1500


def test_measured_profile_reads_no_table(spark):
    prof = table_profile(spark, {"orders": f"{SF_SMALL}/orders.parquet"})
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and prof.first().row_count == 1500
    assert prof.inputFiles() == []


def test_source_profile_sums_files(spark, scratch):
    path = scratch("multi")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").repartition(5).write.parquet(path)
    out = {r.table_name: (r.source_rows, r.source_columns) for r in source_profile(
        spark, {"lineitem": path, "orders": f"{SF_SMALL}/orders.parquet"},
        direct={"nation": f"{SF_SMALL}/nation.parquet"}, restrict_to=["LINEITEM"]).collect()}
    assert out == {"LINEITEM": (6000, 11), "NATION": (25, None)}


def test_object_profile_skips_missing(spark):
    prof, skipped = object_profile(spark, {"nation": f"{SF_SMALL}/nation.parquet", "gone": f"{SF_SMALL}/gone.parquet"})
    assert [(r.table_name, r.source_rows, r.source_columns) for r in prof.collect()] == [("NATION", 25, 3)]
    assert [n for n, _ in skipped] == ["gone"]


def test_last_altered_from_file_time(spark):
    from tablewatch.operators import FILE_MODIFIED

    r = table_profile(spark, {"nation": f"{SF_SMALL}/nation.parquet"}, last_altered=FILE_MODIFIED).first()
    assert r.last_altered is not None


def test_object_profile_isolates_a_failing_object(spark, scratch):
    bad = scratch("corrupt")
    spark.range(5).write.parquet(bad)
    spark.createDataFrame([("not parquet",)], "value string").coalesce(1).write.mode("append").text(bad)
    good = f"{SF_SMALL}/region.parquet"
    prof, skipped = object_profile(
        spark,
        {"region": good, "broken": lambda: spark.read.schema("id long").parquet(bad)},
    )
    assert [(r.table_name, r.source_rows) for r in prof.collect()] == [("REGION", 5)]
    assert [n for n, _ in skipped] == ["broken"]


def test_profile_counts_push_down_to_footers_when_enabled(spark):
    keys = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lazy = table_profile(spark, {"orders": f"{SF_SMALL}/orders.parquet"}, measure=False)
        plan = lazy._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan
        assert lazy.first().row_count == 1500
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
