"""File-to-table loads (raw JSON, positional CSV, whole CSV), append / full refresh, gated reloads and
loads that leave a job-status record.

The files of a load are scanned once. A load that can hold bad records writes what it reads into a
staged folder, split into good and rejected; its counts are observed on the way. From there the rejects are
published first and the good rows last, so a load that fails at any point has not changed its target.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewatch.functions.columns import extract_paths
from tablewatch.functions.time import AsOf, load_time, to_datetime
from tablewatch.operators.audit import append_job_status
from tablewatch.operators.job_log import close_job, open_job
from tablewatch.schemas import JOB_STATUS
from tablewatch.session import error_text, local_frame, scratch_path
from tablewatch.sources import store
from tablewatch.sources.files import (
    CORRUPT_COLUMN,
    RAW_COLUMN,
    positional_schema,
    read_csv,
    read_raw_json,
)
from tablewatch.sources.tables import (
    LOAD_RUN,
    TableLike,
    TableRef,
    as_ref,
    drop_run,
    has_runs,
    read_table,
    table_exists,
    write_runs,
    write_table,
)

LOADED_AT = "loaded_at"


# ---------------------------------------------------------------------------------------------
# Readers that shape a load (ING-1, ING-2, ING-4, ING-5)
# ---------------------------------------------------------------------------------------------


def load_raw_json(
    spark: SparkSession,
    path: str | list[str],
    paths: Mapping[str, str] | None = None,
    as_of: AsOf = None,
    *,
    raw_column: str = RAW_COLUMN,
    corrupt_column: str | None = CORRUPT_COLUMN,
    loaded_at: str = LOADED_AT,
    streaming: bool = False,
    strip_outer_array: bool = False,
    **options,
) -> DataFrame:
    """Raw JSON records plus load time plus keys extracted as strings.

    ``paths`` maps output names to JSON paths, e.g. ``{"id": "$.id", "device_id": "$.device.id"}``.
    A key that is absent, sits under a non-object or cannot be read as a string gives null.
    Columns: ``raw`` (VARIANT), ``loaded_at``, one per path, and ``corrupt_column`` (the text of a
    line that did not parse; null otherwise).

    ``strip_outer_array=True`` turns a record that is a JSON array into one record per element
    (files holding one array need ``multiLine=True``; such a file is one record, read by one
    task, so line-delimited JSON is the better layout for large drops).
    """
    paths = {"id": "$.id"} if paths is None else paths
    df = read_raw_json(
        spark, path, raw_column=raw_column, corrupt_column=corrupt_column, streaming=streaming, **options
    )
    if strip_outer_array:
        raw = F.col(raw_column)
        elements = F.coalesce(F.try_variant_get(raw, "$", "array<variant>"), F.array(raw))
        keep = [F.col(c) for c in df.columns if c != raw_column]
        df = df.select(F.explode(elements).alias(raw_column), *keep)
    cols = [F.col(raw_column), load_time(as_of).alias(loaded_at), *extract_paths(raw_column, paths)]
    if corrupt_column:
        cols.append(F.col(corrupt_column))
    return df.select(*cols)


def load_csv_positional(
    spark: SparkSession,
    path: str | list[str],
    n_columns: int = 4,
    as_of: AsOf = None,
    *,
    loaded_at: str = LOADED_AT,
    header: bool = False,
    sep: str = ",",
    **options,
) -> DataFrame:
    """The first ``n_columns`` fields of each CSV row by position (``c1..cN`` strings) plus load time.

    A short row gives nulls for the missing fields; fields beyond ``n_columns`` are ignored.
    """
    df = read_csv(spark, path, positional_schema(n_columns), header=header, sep=sep, **options)
    return df.select("*", load_time(as_of).alias(loaded_at))


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    *,
    header: bool = True,
    sep: str = ",",
    corrupt_column: str | None = CORRUPT_COLUMN,
    as_of: AsOf = None,
    loaded_at: str | None = None,
    streaming: bool = False,
    **options,
) -> DataFrame:
    """A CSV file (or folder) as it is, typed by ``schema``.

    ``corrupt_column`` holds the text of a row that does not fit the schema (null for the others); loads
    write such rows to the target's rejects. ``loaded_at`` names a load-time column to add.
    """
    df = read_csv(
        spark, path, schema, header=header, sep=sep, corrupt_column=corrupt_column, streaming=streaming, **options
    )
    return df.select("*", load_time(as_of).alias(loaded_at)) if loaded_at else df


# ---------------------------------------------------------------------------------------------
# Writes (append, full refresh) with parse counts (ING-1..5, ING-8)
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LoadResult:
    target: TableRef
    parsed: int  # records read
    rejected: int  # records that did not parse
    inserted: int  # rows written to the target
    deleted: int  # rows the load replaced (full refresh)
    rejects_location: str | None = None


REJECTS_SUFFIX = "__rejects"


def rejects_of(target: TableRef | str) -> TableRef:
    """Default home of a target's rejected records: a sibling table named ``<target>__rejects``."""
    t = as_ref(target)
    return TableRef(t.location.rstrip("/") + REJECTS_SUFFIX, "parquet" if t.is_path else t.format)


_REJECTED = "_tablewatch_rejected"


def _stage_split(df: DataFrame, corrupt_column: str, obs: Observation) -> tuple[str, DataFrame]:
    """Write ``df`` once, good and rejected rows in partitions of their own; returns the folder and what
    it holds."""
    spark = df.sparkSession
    staged = scratch_path(spark, "staged-load")
    metrics = [F.count(F.lit(1)).alias("parsed"), F.count_if(F.col(corrupt_column).isNotNull()).alias("rejected")]
    split = df.observe(obs, *metrics).withColumn(_REJECTED, F.col(corrupt_column).isNotNull())
    try:
        split.write.partitionBy(_REJECTED).parquet(staged)
    except Exception:
        store.delete(spark, staged)
        raise
    return staged, spark.read.schema(split.schema).parquet(staged)


def write_load(
    df: DataFrame,
    target: TableRef | str,
    *,
    mode: str = "append",
    corrupt_column: str = CORRUPT_COLUMN,
    rejects: TableRef | str | bool | None = True,
    partition_by: list[str] | None = None,
    count_replaced: bool = True,
    load_run: str | None = None,
) -> LoadResult:
    """Write ``df`` to ``target``; rows whose ``corrupt_column`` is set go to ``rejects`` instead.

    The source is scanned once: a load with a ``corrupt_column`` is staged, good and rejected rows apart,
    and published from there -- rejects first, into a ``load_run`` partition of their own, then the good
    rows. If the rejects cannot be written, the target is untouched; if the target cannot, the rejects
    of this load are taken back. ``rejects=True`` (default) is ``rejects_of(target)``; ``False`` / ``None`` keeps
    only the count. On an overwrite, ``count_replaced`` counts the rows being replaced (a footer-only
    count; turn it off for targets with very many files, ``deleted`` is then 0).

    A target that is partitioned by ``load_run`` (incremental loads make such tables) gets the rows in a
    partition of this load; ``load_run`` names it, and a load repeated under one name replaces itself.
    """
    target = as_ref(target)
    if rejects is True:
        rejects = rejects_of(target)
    elif rejects is False:
        rejects = None
    spark = df.sparkSession
    if target.is_path and store.exists(spark, f"{target.location.rstrip('/')}/_spark_metadata"):
        # Readers of such a folder see only what the stream's own log lists.
        raise ValueError(f"{target.location} is a stream's output folder: rows appended to it would not be seen")
    run = load_run or f"load-{uuid.uuid4().hex[:16]}"
    deleted = 0
    if mode == "overwrite" and count_replaced and table_exists(spark, target):
        deleted = read_table(spark, target).count()

    obs = Observation("load")
    staged = rejects_location = None
    try:
        if corrupt_column in df.columns:
            staged, split = _stage_split(df, corrupt_column, obs)
            good = split.where(~F.col(_REJECTED)).drop(_REJECTED, corrupt_column)
            bad = split.where(F.col(_REJECTED)).drop(_REJECTED)
        else:
            good, bad = df.observe(obs, F.count(F.lit(1)).alias("parsed")), None
        if bad is not None and rejects is not None and int(obs.get["rejected"]):
            write_runs(bad.withColumn(LOAD_RUN, F.lit(run)), rejects, [run])
            rejects_location = as_ref(rejects).location
        try:
            _write_good(good, target, mode, partition_by, run, named=load_run is not None)
        except Exception:
            if rejects_location is not None:
                drop_run(spark, rejects, run)
            raise
    finally:
        if staged is not None:
            store.delete(spark, staged)
    m = obs.get
    parsed, rejected = int(m["parsed"]), int(m.get("rejected", 0))
    return LoadResult(target, parsed, rejected, parsed - rejected, deleted, rejects_location)


def _write_good(good: DataFrame, target: TableRef, mode: str, partition_by: list[str] | None, run: str, named: bool) -> None:
    spark = good.sparkSession
    if LOAD_RUN in good.columns or not (named or has_runs(spark, target)):
        write_table(good, target, mode=mode, partition_by=partition_by)
    elif mode == "overwrite":
        write_table(good.withColumn(LOAD_RUN, F.lit(run)), target, mode=mode, partition_by=[LOAD_RUN])
    else:
        write_runs(good.withColumn(LOAD_RUN, F.lit(run)), target, [run])


def append_load(df: DataFrame, target: TableRef | str, **kw) -> LoadResult:
    """Append a load to ``target`` (created when absent)."""
    return write_load(df, target, mode="append", **kw)


def replace_table(df: DataFrame, target: TableRef | str, **kw) -> LoadResult:
    """Full refresh: the target afterwards holds exactly ``df``. The new rows are complete before the old
    ones go (see ``write_table``), so a refresh that fails leaves the target as it was, and ``df`` may
    read the target."""
    return write_load(df, target, mode="overwrite", **kw)


# ---------------------------------------------------------------------------------------------
# Gated reload (ING-6)
# ---------------------------------------------------------------------------------------------


def load_table(
    spark: SparkSession,
    name: str,
    source: TableLike | Callable[[], DataFrame],
    target: TableRef | str,
    run_flag: str | None,
    **kw,
) -> LoadResult | None:
    """Empty ``target`` and reload it from ``source``, only when ``run_flag`` is ``'Y'``.

    Any other flag is a no-op that returns ``None`` and leaves the target as it was.
    """
    if run_flag != "Y":
        return None
    df = source() if callable(source) else read_table(spark, source)
    return replace_table(df, target, **kw)


# ---------------------------------------------------------------------------------------------
# Load with a job-status record (ING-8)
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class JobMeta:
    schema_name: str
    table_name: str
    task_id: str
    job_type: str = "LOAD"
    dag_id: str = ""
    run_date: dt.date | None = None


def job_status_values(
    meta: JobMeta,
    start: dt.datetime,
    end: dt.datetime,
    status: str,
    *,
    parsed: int = 0,
    staged: int = 0,
    inserted: int = 0,
    updated: int = 0,
    deleted: int = 0,
    failure_reason: str | None = None,
) -> tuple:
    """One job-status record as a tuple in ``JOB_STATUS`` order (``job_id`` left null)."""
    return (
        None,
        start,
        end,
        meta.schema_name,
        meta.table_name,
        meta.task_id,
        meta.job_type,
        meta.dag_id,
        meta.run_date or start.date(),
        status,
        parsed,
        staged,
        inserted,
        updated,
        deleted,
        failure_reason,
    )


def job_status_row(spark: SparkSession, meta: JobMeta, start: dt.datetime, end: dt.datetime, status: str, **counts) -> DataFrame:
    """One job-status record (``job_id`` left null; ``append_job_status`` assigns it)."""
    return local_frame(spark, [job_status_values(meta, start, end, status, **counts)], JOB_STATUS)


def success_values(meta: JobMeta, start: dt.datetime, end: dt.datetime, res: LoadResult) -> tuple:
    """The ``SUCCESS`` record of a load: records read, parsed, written and replaced."""
    return job_status_values(
        meta, start, end, "SUCCESS",
        parsed=res.parsed, staged=res.parsed - res.rejected, inserted=res.inserted, deleted=res.deleted,
    )


def load_with_audit(
    df: DataFrame,
    target: TableRef | str,
    meta: JobMeta,
    *,
    mode: str = "append",
    audit_log: TableRef | str | None = None,
    event_log: TableRef | str | None = None,
    clock: Callable[[], dt.datetime] | None = None,
    **kw,
) -> tuple[LoadResult | None, DataFrame]:
    """Run a load and leave one job-status record for it.

    Success: ``SUCCESS`` with ``recs_parsed`` (records read), ``recs_staged`` (records that parsed),
    ``recs_inserted`` (rows written), ``recs_deleted`` (rows replaced by a full refresh). Failure:
    ``FAILURE`` with the error text, the record is still written, then the error is raised again.
    ``event_log`` also gets a row before the load starts and one at its end (see ``job_log``), so that
    a load whose driver is lost is on record. Returns the load result and the record (already
    appended when ``audit_log`` is given).
    """
    spark = df.sparkSession
    clock = clock or (lambda: to_datetime(None))
    start = clock()
    run_key = None
    if event_log is not None:
        run_key = open_job(spark, opening_values(meta, start), event_log, lambda: start)

    def leave(values: tuple) -> DataFrame:
        rec = local_frame(spark, [values], JOB_STATUS)
        if audit_log is not None:
            append_job_status(rec, audit_log)
        if run_key is not None:
            close_job(spark, run_key, values, event_log, clock)
        return rec

    try:
        res = write_load(df, target, mode=mode, **kw)
    except Exception as err:  # noqa: BLE001 - recorded, then re-raised
        leave(job_status_values(meta, start, clock(), "FAILURE", failure_reason=error_text(err)))
        raise
    return res, leave(success_values(meta, start, clock(), res))


def opening_values(meta: JobMeta, start: dt.datetime) -> tuple:
    """A job's record as far as it is known at its start."""
    values = job_status_values(meta, start, start, "RUNNING")
    return values[:2] + (None,) + values[3:]
