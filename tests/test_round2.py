"""Times outside UTC, failures isolated at run time, whole error texts, exact gates, empty arrays."""

import datetime as dt

import pytest

from tablewatch.operators import freshness, load_raw_json, load_table, object_profile, table_profile
from tablewatch.plans import run_daily_audit
from tablewatch.session import error_text


@pytest.fixture(params=["UTC", "America/Los_Angeles"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_instants_are_compared_in_utc(spark, zone):
    df = spark.sql("SELECT 'a' AS g, TIMESTAMP '2024-03-10 10:30:00Z' AS ts UNION ALL SELECT 'b', TIMESTAMP '2024-03-09 12:30:00Z'")
    got = {r.g: (r.last_altered, r.daily_refresh_check) for r in freshness(df, ["g"], "ts", dt.datetime(2024, 3, 10, 12, 31)).collect()}
    assert got == {"a": (dt.datetime(2024, 3, 10, 10, 30), "Y"), "b": (dt.datetime(2024, 3, 9, 12, 30), "N")}
    prof = table_profile(spark, {("C", "S", "T"): _view(spark, df)}, last_altered="ts").first()
    assert prof.last_altered == dt.datetime(2024, 3, 10, 10, 30)


def _view(spark, df):
    df.createOrReplaceTempView("tw_instants")
    return "tw_instants"


def test_one_table_failing_at_run_time_leaves_the_others(spark, scratch):
    spark.range(3).selectExpr("TIMESTAMP_NTZ '2024-01-01 05:00:00' AS ts").createOrReplaceTempView("tw_good")
    spark.range(2).selectExpr("if(id = 1, 'not a date', '2024-01-01') AS ts").createOrReplaceTempView("tw_bad")
    log = scratch("log")
    tables = {"GOOD": "tw_good", "BAD": "tw_bad"}
    run_daily_audit(
        spark, [("GOOD", "ts"), ("BAD", "ts")], tables, dt.datetime(2024, 1, 2, 9), log=log, schema_name="s", job_type="j", dag_id="d"
    )
    rows = {r["table_name"]: r.asDict() for r in spark.read.parquet(log).collect()}
    assert rows["GOOD"]["recs_inserted"] == 3 and "FAILURE" in rows["BAD"].values()


def test_one_bad_object_is_skipped_and_named(spark):
    good = spark.range(4)
    bad = spark.range(1).selectExpr("raise_error('broken on purpose') AS x").where("x IS NOT NULL")
    rows, skipped = object_profile(spark, {"good": lambda: good, "bad": lambda: bad})
    assert {r.table_name: r.source_rows for r in rows.collect()} == {"GOOD": 4}
    assert [s[0] for s in skipped] == ["bad"] and "broken on purpose" in skipped[0][1]


def test_error_text_is_whole():
    text = "first line\n" + "x" * 5000
    assert error_text(ValueError(text)) == text and error_text(ValueError()) == "ValueError"


def test_only_the_exact_flag_reloads(spark, scratch):
    for flag in (" y ", "y", "N", None):
        assert load_table(spark, "t", lambda: spark.range(1), scratch("t"), flag) is None
    assert load_table(spark, "t", lambda: spark.range(1).toDF("n"), scratch("t"), "Y") is not None


def test_empty_arrays_give_no_row(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": 2}]\n[]\nnot json\n')
    rows = load_raw_json(spark, str(tmp_path), {"id": "$.id"}, dt.datetime(2024, 1, 1), strip_outer_array=True).collect()
    assert sorted(str(r.id) for r in rows) == ["1", "2", "None"]


def test_a_broken_cluster_is_not_a_failing_table(spark, scratch, monkeypatch):
    from pyspark.errors.exceptions.captured import UnknownException
    from tablewatch.plans import daily_audit
    from tablewatch.session import is_read_error

    lost = UnknownException("Job aborted due to stage failure: executor lost", "")
    assert not is_read_error(lost) and is_read_error(KeyError("x"))
    monkeypatch.setattr(daily_audit, "audit_all", lambda *a, **k: (_ for _ in ()).throw(lost))
    spark.range(1).selectExpr("TIMESTAMP_NTZ '2024-01-01 05:00:00' AS ts").createOrReplaceTempView("tw_good2")
    log = scratch("log")
    with pytest.raises(UnknownException):
        run_daily_audit(spark, [("G", "ts")], {"G": "tw_good2"}, dt.datetime(2024, 1, 2), log=log, schema_name="s", job_type="j", dag_id="d")
