"""Ingest operators on small files (FIXTURES 3.3, 3.4) and load properties."""

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tablewatch.operators import (
    JobMeta,
    append_load,
    load_csv_positional,
    load_raw_json,
    load_table,
    load_with_audit,
    replace_table,
)
from tablewatch.plans import run_gated_loads
from tablewatch.streaming import ingest_new_json_files

LINES = ['{"id":"b1","device":{"id":"d9"}}', '{"id":7,"device":3}', "{bad"]
AS_OF = dt.datetime(2024, 1, 31)


def _write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


@pytest.fixture()
def json_stage(spark, scratch):
    return _write_lines(spark, scratch("json"), LINES)


def test_raw_json_paths_and_corrupt_line(spark, json_stage):
    df = load_raw_json(spark, json_stage, {"id": "$.id", "device_id": "$.device.id"}, AS_OF)
    got = {(r.id, r.device_id, r._corrupt_record) for r in df.collect()}
    assert got == {("b1", "d9", None), ("7", None, None), (None, None, "{bad")}
    assert df.schema["raw"].dataType.simpleString() == "variant"
    assert df.select(F.countDistinct("loaded_at")).first()[0] == 1


def test_load_counts_and_rejects(spark, json_stage, scratch):
    target, rejects = scratch("target"), scratch("rejects")
    res = append_load(load_raw_json(spark, json_stage, {"id": "$.id"}, AS_OF), target, rejects=rejects)
    assert (res.parsed, res.rejected, res.inserted) == (3, 1, 2)
    assert spark.read.parquet(target).count() == 2
    assert "_corrupt_record" not in spark.read.parquet(target).columns
    assert [r._corrupt_record for r in spark.read.parquet(rejects).collect()] == ["{bad"]


def test_full_refresh_twice_equals_once(spark, json_stage, scratch):
    target = scratch("refresh")
    for _ in range(2):
        res = replace_table(load_raw_json(spark, json_stage, {"id": "$.id"}, AS_OF), target)
    assert res.deleted == 2 and res.inserted == 2
    assert spark.read.parquet(target).count() == 2


def test_short_csv_row_is_padded(spark, scratch):
    path = _write_lines(spark, scratch("csv"), ["1|x", "2|y|z|w|extra"])
    got = sorted(tuple(r)[:4] for r in load_csv_positional(spark, path, 4, AS_OF, sep="|").collect())
    assert got == [("1", "x", None, None), ("2", "y", "z", "w")]


def test_gate_no_op_unless_y(spark, scratch):
    target = scratch("gated")
    assert load_table(spark, "T", spark.range(3), target, "N") is None
    assert load_table(spark, "T", spark.range(3), target, None) is None
    assert load_table(spark, "T", spark.range(3), target, "Y").inserted == 3
    res = run_gated_loads(spark, {"A": "Y", "B": "N"}, {"A": spark.range(4), "B": spark.range(5)},
                          {"A": scratch("a"), "B": scratch("b")})
    assert res["A"].inserted == 4 and res["B"] is None


def test_load_with_audit_success_and_failure(spark, json_stage, scratch):
    log = scratch("log")
    meta = JobMeta("RAW", "DEVICE", "load_device", "LOAD", "loads")
    res, rec = load_with_audit(
        load_raw_json(spark, json_stage, {"id": "$.id"}, AS_OF), scratch("t"), meta,
        audit_log=log, clock=lambda: AS_OF,
    )
    r = rec.first()
    assert (r.job_status, r.recs_parsed, r.recs_staged, r.recs_inserted) == ("SUCCESS", 3, 2, 2)
    bad = spark.range(2).select(F.col("id"), F.col("id").alias("id"))  # duplicate column: write fails
    with pytest.raises(Exception):
        load_with_audit(bad, scratch("t2"), meta, audit_log=log, clock=lambda: AS_OF)
    rows = sorted(spark.read.parquet(log).collect(), key=lambda x: x.job_id)
    assert [(x.job_id, x.job_status) for x in rows] == [(1, "SUCCESS"), (2, "FAILURE")]
    assert rows[1].failure_reason


def test_incremental_second_run_adds_nothing(spark, scratch):
    prefix, target, ck = scratch("landing"), scratch("landing-t"), scratch("landing-ck")
    _write_lines(spark, f"{prefix}/b1", ['{"id":1}', '{"id":2}'])
    r1 = ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    _write_lines(spark, f"{prefix}/b2", ['{"id":3}'])
    r2 = ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    r3 = ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    assert (r1.rows, r2.rows, r3.rows) == (2, 1, 0)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["1", "2", "3"]


def test_incremental_run_counts_rejects_and_audits(spark, scratch):
    prefix, target, ck, log = scratch("landing"), scratch("landing-t"), scratch("landing-ck"), scratch("log")
    _write_lines(spark, f"{prefix}/b1", LINES)
    meta = JobMeta("RAW", "TRIPS", "load_trips", "LOAD", "loads")
    run = ingest_new_json_files(spark, f"{prefix}/*", target, ck, paths={"id": "$.id"}, as_of=AS_OF,
                                audit=(meta, log), clock=lambda: AS_OF)
    assert (run.rows, run.rejected) == (3, 1)
    rec = spark.read.parquet(log).first()
    assert (rec.job_status, rec.recs_parsed, rec.recs_staged, rec.job_id) == ("SUCCESS", 3, 2, 1)
    assert rec.recs_inserted == 2 and spark.read.parquet(target).count() == 2
    assert [r._corrupt_record for r in spark.read.parquet(f"{target}__rejects").collect()] == ["{bad"]


def test_incremental_archive_moves_processed_files(spark, scratch):
    landing, target, ck, archive = scratch("landing"), scratch("t"), scratch("ck"), scratch("archive")
    _write_lines(spark, f"{landing}/b1", ['{"id":1}'])
    ingest_new_json_files(spark, f"{landing}/*", target, ck, clean_source="archive", archive_dir=archive, as_of=AS_OF)
    _write_lines(spark, f"{landing}/b2", ['{"id":2}'])
    run = ingest_new_json_files(spark, f"{landing}/*", target, ck, clean_source="archive", archive_dir=archive, as_of=AS_OF)
    assert run.rows == 1
    assert spark.read.parquet(target).count() == 2


def test_rejects_default_next_to_target(spark, json_stage, scratch):
    from tablewatch.operators.ingest import rejects_of

    target = scratch("with-default-rejects")
    res = append_load(load_raw_json(spark, json_stage, {"id": "$.id"}, AS_OF), target)
    assert res.rejects_location == rejects_of(target).location
    assert [r._corrupt_record for r in spark.read.parquet(res.rejects_location).collect()] == ["{bad"]
    clean = scratch("clean")
    res2 = append_load(spark.range(2), clean)
    assert res2.rejects_location is None and res2.rejected == 0


def test_refresh_may_read_its_own_target(spark, scratch):
    target = scratch("self")
    spark.range(3).write.parquet(target)
    res = replace_table(spark.read.parquet(target).where("id > 0"), target)
    assert (res.deleted, res.inserted) == (3, 2)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2]


def test_strip_outer_array(spark, scratch):
    path = _write_lines(spark, scratch("arr"), ['[{"id": 1, "device": {"id": "x"}}, {"id": 2}]', '{"id": 3}', "{bad"])
    df = load_raw_json(spark, path, {"id": "$.id", "device_id": "$.device.id"}, AS_OF, strip_outer_array=True)
    got = {(r.id, r.device_id, r._corrupt_record) for r in df.collect()}
    assert got == {("1", "x", None), ("2", None, None), ("3", None, None), (None, None, "{bad")}


def test_incremental_counts_cover_many_batches(spark, scratch):
    prefix, target, ck = scratch("many"), scratch("many-t"), scratch("many-ck")
    for i in range(4):
        _write_lines(spark, f"{prefix}/b{i}", [f'{{"id":{i}}}', "{bad"])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        run = ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF, max_files_per_trigger=1)
        assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "2"
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (run.batches, run.rows, run.rejected, run.inserted) == (4, 8, 4, 4)


def test_incremental_failure_leaves_a_record(spark, scratch):
    prefix, target, ck, log = scratch("fails"), scratch("fails-t"), scratch("fails-ck"), scratch("fails-log")
    _write_lines(spark, f"{prefix}/b1", LINES)
    time.sleep(1.1)  # the stream takes the older file first
    folder = Path(prefix.removeprefix("file:")) / "b2"
    folder.mkdir()
    (folder / "broken.json.gz").write_bytes(b"not gzip at all")
    meta = JobMeta("RAW", "TRIPS", "load_trips", "LOAD", "loads")
    with pytest.raises(StreamingQueryException):
        ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF, max_files_per_trigger=1, audit=(meta, log), clock=lambda: AS_OF)
    rec = spark.read.parquet(log).collect()
    assert [(r.job_status, r.recs_parsed, r.recs_staged, r.recs_inserted) for r in rec] == [("FAILURE", 3, 2, 2)]
    assert spark.read.parquet(target).count() == 2
    assert rec[0].failure_reason


def test_audited_refresh_records_deleted_rows_and_partitioned_append(spark, scratch):
    target = scratch("refresh-audit")
    append_load(spark.range(5).toDF("id"), target)
    meta = JobMeta("RAW", "T", "refresh_t", "LOAD", "loads")
    res, rec = load_with_audit(spark.range(3).toDF("id"), target, meta, mode="overwrite", clock=lambda: AS_OF)
    r = rec.first()
    assert (res.deleted, r.recs_deleted, r.recs_inserted) == (5, 5, 3)
    parted = scratch("parted")
    append_load(spark.range(6).select((F.col("id") % 2).alias("p"), "id"), parted, partition_by=["p"])
    assert sorted(r.p for r in spark.read.parquet(parted).select("p").distinct().collect()) == [0, 1]


def test_typed_paths(spark, scratch):
    path = _write_lines(spark, scratch("typed"), ['{"id": 7, "t": "2024-01-02 03:04:05"}', '{"id": "x"}'])
    df = load_raw_json(spark, path, {"id": ("$.id", "bigint"), "t": ("$.t", "timestamp_ntz")}, AS_OF)
    got = {(r.id, r.t) for r in df.collect()}
    assert got == {(7, dt.datetime(2024, 1, 2, 3, 4, 5)), (None, None)}


def test_gated_loads_leave_records_and_isolate_failures(spark, scratch):
    log = scratch("gated-log")
    bad = spark.range(2).select(F.col("id"), F.col("id").alias("id"))  # duplicate column: the write fails
    with pytest.raises(Exception):
        run_gated_loads(
            spark, {"A": "Y", "B": "Y", "C": "N"}, {"A": spark.range(4), "B": bad, "C": spark.range(1)},
            {"A": scratch("a"), "B": scratch("b"), "C": scratch("c")}, audit_log=log, clock=lambda: AS_OF,
        )
    rows = {r.table_name: r for r in spark.read.parquet(log).collect()}
    assert set(rows) == {"A", "B"}  # C was not flagged: no record
    assert (rows["A"].job_status, rows["A"].recs_inserted, rows["A"].task_id) == ("SUCCESS", 4, "load_a_table")
    assert rows["B"].job_status == "FAILURE" and rows["B"].failure_reason
    assert sorted(r.job_id for r in rows.values()) == [1, 2]
