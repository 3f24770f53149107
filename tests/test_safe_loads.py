"""Loads that fail midway, repeated steps, appends beside streams, rejects, job logs and claimed ids."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tablewatch.operators import append_load, load_csv, load_raw_json, load_table, load_with_audit, replace_table
from tablewatch.operators.ingest import JobMeta, rejects_of
from tablewatch.sources import store
from tablewatch.sources.tables import LOAD_RUN, TableRef, write_runs
from tablewatch.streaming import incremental, ingest_new_csv_files, ingest_new_json_files

AS_OF = dt.datetime(2024, 1, 31)


def lines(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.text(path)
    return path


def failing(spark, n=20):
    """Rows of which one raises when it is computed."""
    return spark.range(n).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("cut off"))).otherwise(F.col("id")).cast("bigint").alias("id"))


@pytest.fixture()
def table(spark):
    name = f"tw_safe_{abs(hash(object()))}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}__rejects")


# ------------------------------------------------------------------------------------ refresh


def test_failed_refresh_leaves_the_rows_of_a_path(spark, scratch):
    target = scratch("keep")
    replace_table(spark.range(5), target)
    with pytest.raises(Exception, match="cut off"):
        replace_table(failing(spark), target)
    with pytest.raises(Exception, match="cut off"):
        load_table(spark, "T", lambda: failing(spark), target, "Y")
    assert spark.read.parquet(target).count() == 5
    parent, name = target.rsplit("/", 1)
    assert [n for n in store.children(spark, parent) if n.startswith(name)] == [name]


def test_failed_refresh_leaves_the_rows_of_a_table(spark, table):
    spark.range(5).write.saveAsTable(table)
    with pytest.raises(Exception, match="cut off"):
        replace_table(failing(spark), table)
    assert spark.table(table).count() == 5


def test_refresh_keeps_a_tables_definition(spark, table):
    spark.sql(
        f"CREATE TABLE {table} (id BIGINT COMMENT 'the key', p STRING) USING parquet PARTITIONED BY (p) "
        "COMMENT 'kept' TBLPROPERTIES ('team' = 'loads')"
    )
    before = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    spark.sql(f"INSERT INTO {table} VALUES (1, 'old')")
    res = replace_table(spark.range(4).select(F.lit("new").alias("p"), "id"), table)
    assert spark.sql(f"SHOW CREATE TABLE {table}").first()[0] == before
    assert (res.deleted, res.inserted) == (1, 4)
    assert {tuple(r) for r in spark.table(table).select("id", "p").collect()} == {(i, "new") for i in range(4)}


def test_swap_cut_off_between_renames_is_undone(spark, scratch):
    target = scratch("swap")
    spark.range(3).write.parquet(target)
    store.rename(spark, target, target + store.OLD_SUFFIX)
    append_load(spark.range(2), target)
    assert spark.read.parquet(target).count() == 5


def test_failed_second_rename_puts_the_old_version_back(spark, scratch):
    target = scratch("swap2")
    spark.range(3).write.parquet(target)
    with pytest.raises(Exception):
        store.publish_folder(spark, scratch("not-there"), target)
    assert spark.read.parquet(target).count() == 3


# ------------------------------------------------------------------------------------ rejects


def test_csv_rows_that_do_not_fit_are_rejected(spark, scratch):
    path = lines(spark, scratch("csv"), ["id,n", "1,10", "x,20", "3", "4,40,more", '5,"50"'])
    target = scratch("csv-target")
    res = append_load(load_csv(spark, path, "id int, n int"), target)
    assert (res.parsed, res.rejected, res.inserted) == (5, 3, 2)
    assert {tuple(r) for r in spark.read.parquet(target).collect()} == {(1, 10), (5, 50)}
    assert spark.read.parquet(target).columns == ["id", "n"]
    bad = spark.read.parquet(rejects_of(target).location)
    assert {r._corrupt_record for r in bad.collect()} == {"x,20", "3", "4,40,more"}


def test_failed_reject_write_leaves_the_target(spark, scratch):
    path = lines(spark, scratch("json"), ['{"id":1}', "{bad"])
    target, rejects = scratch("t"), scratch("r")
    append_load(spark.createDataFrame([("0",)], "id string"), target)
    spark.range(1).write.parquet(rejects)  # not partitioned by run: rejects cannot go there
    with pytest.raises(ValueError):
        append_load(load_raw_json(spark, path, {"id": "$.id"}, AS_OF).select("id", "_corrupt_record"), target, rejects=rejects)
    assert [r.id for r in spark.read.parquet(target).collect()] == ["0"]


def test_failed_target_write_takes_the_rejects_back(spark, scratch, table):
    path = lines(spark, scratch("json"), ['{"id":1}', "{bad"])
    spark.sql(f"CREATE TABLE {table} (other DATE, more INT) USING parquet")
    rejects = scratch("r")
    with pytest.raises(Exception):
        append_load(load_raw_json(spark, path, {"id": "$.id"}, AS_OF).select("id", "_corrupt_record"), table, rejects=rejects)
    assert not [n for n in store.children(spark, rejects) if n.startswith(LOAD_RUN)]
    assert spark.table(table).count() == 0


def test_a_load_scans_its_files_once(spark, scratch):
    """The good rows and the rejects come from the staged split, not from the source."""
    path = lines(spark, scratch("json"), ['{"id":1}', "{bad", '{"id":2}'])
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    src = load_raw_json(spark, path, {"id": "$.id"}, AS_OF).select("id", "_corrupt_record")
    res = append_load(src.mapInArrow(seen, src.schema), scratch("t"))
    assert (res.parsed, res.rejected) == (3, 1) and reads.value == 3


# -------------------------------------------------------------------------------- incremental


@pytest.mark.parametrize("kind", ["path", "table"])
def test_batch_appends_beside_incremental_loads(spark, scratch, table, kind):
    target = scratch("both") if kind == "path" else table
    read = lambda: spark.read.parquet(target) if kind == "path" else spark.table(target)
    prefix, ck = scratch("in"), scratch("ck")
    lines(spark, f"{prefix}/a", ['{"id":1}', '{"id":2}', "{bad"])
    one = ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    batch = load_raw_json(spark, lines(spark, scratch("old"), ['{"id":7}', '{"id":8}', "{worse"]), as_of=AS_OF)
    res = append_load(batch, target)
    lines(spark, f"{prefix}/b", ['{"id":3}'])
    two = ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    assert (one.rows, one.rejected, res.inserted, res.rejected, two.rows) == (3, 1, 2, 1, 1)
    assert sorted(r.id for r in read().collect()) == ["1", "2", "3", "7", "8"]
    assert read().select(LOAD_RUN).distinct().count() == 3
    rejects = rejects_of(target).location
    bad = spark.read.parquet(rejects) if kind == "path" else spark.table(rejects)
    assert sorted(r._corrupt_record for r in bad.collect()) == ["{bad", "{worse"]


def test_steps_repeated_after_a_failure_add_nothing(spark, scratch, monkeypatch):
    target, prefix, ck = scratch("again"), scratch("in"), scratch("ck")
    lines(spark, f"{prefix}/a", ['{"id":1}', "{bad"])
    commit = incremental._Folders.commit

    def die(*a):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(incremental._Folders, "commit", die)  # published, but not recorded
    with pytest.raises(RuntimeError):
        ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    monkeypatch.setattr(incremental, "write_runs", die)  # landed, but not published
    lines(spark, f"{prefix}/b", ['{"id":2}'])
    with pytest.raises(RuntimeError):
        ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    monkeypatch.setattr(incremental, "write_runs", write_runs)
    monkeypatch.setattr(incremental._Folders, "commit", commit)
    run = ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    assert (run.rows, run.rejected, len(run.runs)) == (3, 1, 3)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["1", "2"]
    last = ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    assert (last.rows, last.batches) == (0, 0) and spark.read.parquet(target).count() == 2


def test_incremental_csv_keeps_load_time_and_rejects(spark, scratch):
    target, prefix, ck = scratch("csv"), scratch("in"), scratch("ck")
    lines(spark, f"{prefix}/a", ["id,n", "1,10", "x,20"])
    run = ingest_new_csv_files(spark, f"{prefix}/*", target, ck, "id int, n int", as_of=AS_OF)
    assert (run.rows, run.rejected) == (2, 1)
    assert [tuple(r)[:3] for r in spark.read.parquet(target).collect()] == [(1, 10, AS_OF)]


def test_loads_refuse_what_would_lose_rows(spark, scratch):
    target, prefix, ck = scratch("plain"), scratch("in"), scratch("ck")
    append_load(spark.createDataFrame([("9",)], "id string"), target)
    lines(spark, f"{prefix}/a", ['{"id":1}'])
    with pytest.raises(ValueError, match="not partitioned"):
        ingest_new_json_files(spark, f"{prefix}/*", target, ck, as_of=AS_OF)
    assert spark.read.parquet(target).count() == 1
    store.create_once(spark, f"{target}/_spark_metadata/0", "v1")
    with pytest.raises(ValueError, match="stream"):
        append_load(spark.createDataFrame([("9",)], "id string"), target)


def test_a_named_load_replaces_itself(spark, scratch):
    target = scratch("named")
    for _ in range(2):
        append_load(spark.range(3), target, load_run="2024-01-31")
    append_load(spark.range(2), target, load_run="2024-02-01")
    assert spark.read.parquet(target).count() == 5


def test_a_file_is_created_by_one_writer(spark, scratch):
    path = f"{scratch('claims')}/0001"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: store.create_once(spark, path, str(i)), range(8)))
    assert sum(won) == 1 and store.read_text(spark, path) == str(won.index(True))


# ------------------------------------------------------------------------- job log, ids, reports


class DriverLost(BaseException):
    """Ends a load as a killed driver would: nothing after it runs."""


def test_a_load_cut_off_between_its_records_is_found_lost(spark, scratch, monkeypatch):
    from tablewatch.operators import ingest, job_runs

    events = scratch("events")
    meta = JobMeta("S", "T", "load_t")
    load_with_audit(spark.range(3), scratch("a"), meta, event_log=events, clock=lambda: AS_OF)

    def cut(*a, **k):
        raise DriverLost

    monkeypatch.setattr(ingest, "write_load", cut)
    with pytest.raises(DriverLost):
        load_with_audit(spark.range(3), scratch("b"), meta, event_log=events, clock=lambda: AS_OF)
    log = spark.read.parquet(events)
    assert log.count() == 3
    later = {r.job_status: r.recs_inserted for r in job_runs(log, AS_OF + dt.timedelta(hours=25)).collect()}
    assert later == {"SUCCESS": 3, "LOST": 0}
    assert {r.job_status for r in job_runs(log, AS_OF + dt.timedelta(hours=2)).collect()} == {"SUCCESS", "RUNNING"}


def test_writers_at_once_never_share_an_id(spark, scratch):
    from tablewatch.operators import append_job_status, job_status_row
    from tablewatch.schemas import JOB_STATUS
    from tablewatch.session import local_frame

    log, meta = scratch("log"), JobMeta("S", "T", "t")
    one = job_status_row(spark, meta, AS_OF, AS_OF, "SUCCESS").first()

    def append(i):
        append_job_status(local_frame(spark, [tuple(one)] * (i % 3 + 1), JOB_STATUS), log)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(append, range(12)))
    ids = sorted(r.job_id for r in spark.read.parquet(log).collect())
    assert ids == list(range(1, 25))


def test_both_ways_of_numbering_agree(spark):
    from tablewatch.operators import job_status_row, with_job_ids

    rows = [job_status_row(spark, JobMeta("S", f"T{(i * 7) % 20:02d}", "t"), AS_OF, AS_OF, "SUCCESS").first() for i in range(20)]
    from tablewatch.schemas import JOB_STATUS
    from tablewatch.session import local_frame

    local = local_frame(spark, [tuple(r) for r in rows], JOB_STATUS)
    spread = spark.createDataFrame(rows, JOB_STATUS).repartition(5)
    assert local.isLocal() and not spread.isLocal()
    got = [{(r.table_name, r.job_id) for r in with_job_ids(x, lambda n: 100 + n).collect()} for x in (local, spread)]
    assert got[0] == got[1] and min(i for _, i in got[0]) == 121


def test_claims_go_on_above_an_older_log(spark, scratch):
    from tablewatch.operators.sequence import claim_ids

    folder = scratch("seq")
    assert [claim_ids(spark, folder, 5, 40), claim_ids(spark, folder, 0), claim_ids(spark, folder, 2)] == [40, 45, 45]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_reports_appended_again_replace_their_run(spark, scratch, table, kind):
    from tablewatch.plans import append_reports

    sink = scratch("report") if kind == "path" else table
    df = spark.range(3).selectExpr("id", "'x' AS flag")
    for key, n in (("d1", 3), ("d1", 2), ("d2", 3)):
        append_reports({"counts": df.limit(n)}, {"counts": TableRef(sink)}, key)
    read = spark.read.parquet(sink) if kind == "path" else spark.table(sink)
    assert sorted((r.report_run, r["count"]) for r in read.groupBy("report_run").count().collect()) == [("d1", 2), ("d2", 3)]
    append_reports({"counts": df.limit(0)}, {"counts": TableRef(sink)}, "d1")
    read = spark.read.parquet(sink) if kind == "path" else spark.table(sink)
    assert [r.report_run for r in read.select("report_run").distinct().collect()] == ["d2"]
