"""Incremental file-prefix load: each file that lands under a prefix is loaded exactly once.

A daily job that re-reads a whole prefix into an append-only table would load every old file
again. Instead the prefix is a Structured Streaming file source run with
``trigger(availableNow=True)``: each run processes exactly the files that arrived since the last
run, in bounded micro-batches, then stops. A run has two steps:

1. The stream writes what it reads into a private landing folder under the checkpoint. The file
   sink's log there and the stream's checkpoint make that exactly once. Every row carries the name of
   the run that read it (``load_run``).
2. The rows of all runs that are not yet committed go from the landing folder into the target, each run
   into its own ``load_run`` partition in place of what that partition held; bad records go
   the same way to the rejects table. Then a commit record names the run as done and its landing files go.

A run that dies before its commit record is finished by the next one: the step is repeated, and replacing
a partition by the same rows adds nothing. The target itself is an ordinary table, by path or in the
catalog, without a stream's log: batch loads may append to it at any time (they get a
``load_run`` partition of their own).

One checkpoint belongs to one (prefix, target) pair; point a new prefix or target at a new
checkpoint. On a landing prefix that keeps growing, ``clean_source="archive"`` (or ``"delete"``)
moves processed files away, so each run lists only what is new.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tablewatch.functions.time import AsOf, to_datetime
from tablewatch.operators.audit import append_job_status
from tablewatch.operators.ingest import LOADED_AT, JobMeta, job_status_row, load_csv, load_raw_json, rejects_of
from tablewatch.session import error_text
from tablewatch.sources import store
from tablewatch.sources.files import CORRUPT_COLUMN, RAW_COLUMN
from tablewatch.sources.tables import LOAD_RUN, TableRef, as_ref, read_table, table_exists, write_runs

STARTED, COMMITTED = ".started", ".committed"


@dataclass(frozen=True)
class IncrementalRun:
    batches: int  # micro-batches the stream committed
    rows: int  # records published: those of this run and of runs before it that had died
    rejected: int = 0  # of those, records that did not parse (in the rejects table)
    runs: tuple[str, ...] = ()  # the runs published

    @property
    def inserted(self) -> int:
        return self.rows - self.rejected


@dataclass(frozen=True)
class _Folders:
    """What a checkpoint holds: the stream's own state, the landed rows, the records of the runs."""

    spark: SparkSession
    root: str

    @property
    def stream(self) -> str:
        return f"{self.root}/stream"

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    def last_batch(self) -> int:
        """The last micro-batch the stream has committed; -1 before the first."""
        return max((int(n) for n in store.children(self.spark, f"{self.stream}/commits") if n.isdigit()), default=-1)

    def start_run(self) -> str:
        """Name a new run. The name holds the checkpoint, as several may load one target."""
        prefix = f"run-{hashlib.sha256(self.root.encode()).hexdigest()[:8]}"
        n = sum(x.endswith(STARTED) for x in store.children(self.spark, self.runs)) + 1
        while not store.create_once(self.spark, f"{self.runs}/{prefix}-{n:08d}{STARTED}"):
            n += 1
        return f"{prefix}-{n:08d}"

    def pending(self) -> list[str]:
        """Runs that started and have no commit record."""
        names = store.children(self.spark, self.runs)
        done = {n.removesuffix(COMMITTED) for n in names if n.endswith(COMMITTED)}
        return [r for n in names if n.endswith(STARTED) and (r := n.removesuffix(STARTED)) not in done]

    def commit(self, run: str, counts: dict) -> None:
        store.create_once(self.spark, f"{self.runs}/{run}{COMMITTED}", json.dumps(counts))
        store.delete(self.spark, f"{self.landing}/{LOAD_RUN}={run}")


def _per_run(t: TableRef, spark: SparkSession, runs: list[str]) -> dict[str, int]:
    """Rows of each run in a table (a count of its partitions)."""
    if not table_exists(spark, t):
        return {}
    df = read_table(spark, t)
    if LOAD_RUN not in df.columns:
        return {}
    got = df.where(F.col(LOAD_RUN).isin(runs)).groupBy(LOAD_RUN).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[0]: r["n"] for r in got}


def publish_landed(
    folders: _Folders, schema: StructType, target: TableRef, corrupt_column: str | None, rejects: TableRef | None
) -> tuple[list[str], int, int]:
    """Step 2: the landed rows of all runs without a commit record, into target and rejects.

    Returns (runs, records, rejected), counted in the tables themselves."""
    spark, runs = folders.spark, folders.pending()
    if not runs:
        return [], 0, 0
    good: dict[str, int] = {}
    bad: dict[str, int] = {}
    if store.exists(spark, f"{folders.landing}/_spark_metadata"):
        landed = spark.read.schema(schema).parquet(folders.landing)
        split = corrupt_column if corrupt_column in landed.columns else None
        if split is not None and rejects is not None:
            write_runs(landed.where(F.col(split).isNotNull()), rejects, runs)
            bad = _per_run(rejects, spark, runs)
        rows = landed if split is None else landed.where(F.col(split).isNull()).drop(split)
        write_runs(rows, target, runs)
        good = _per_run(target, spark, runs)
    for run in runs:
        folders.commit(run, {"inserted": good.get(run, 0), "rejected": bad.get(run, 0)})
    rejected = sum(bad.values())
    return runs, sum(good.values()) + rejected, rejected


def _source_options(options: dict, max_files: int | None, clean_source: str | None, archive_dir: str | None) -> dict:
    out = dict(options)
    if max_files:
        out["maxFilesPerTrigger"] = str(max_files)
    if clean_source:
        out["cleanSource"] = clean_source
        if archive_dir:
            out["sourceArchiveDir"] = archive_dir
    return out


def _run(
    stream: DataFrame,
    target: TableRef | str,
    checkpoint: str,
    corrupt_column: str | None,
    rejects: TableRef | str | None,
    audit: tuple[JobMeta, TableRef | str] | None,
    clock: Callable[[], dt.datetime] | None,
) -> IncrementalRun:
    spark, target = stream.sparkSession, as_ref(target)
    rejects = rejects_of(target) if rejects is None else as_ref(rejects)
    clock = clock or (lambda: to_datetime(None))
    start = clock()
    folders = _Folders(spark, checkpoint.rstrip("/"))
    published: tuple[list[str], int, int] = ([], 0, 0)

    def record(status: str, **reason) -> None:
        if audit is not None:
            meta, log = audit
            _, rows, rejected = published
            append_job_status(
                job_status_row(
                    spark, meta, start, clock(), status,
                    parsed=rows, staged=rows - rejected, inserted=rows - rejected, **reason,
                ),
                log,
            )

    try:
        before = folders.last_batch()
        run = folders.start_run()
        tagged = stream.withColumn(LOAD_RUN, F.lit(run))
        schema = StructType(list(stream.schema.fields)).add(LOAD_RUN, StringType(), True)
        try:
            (
                tagged.writeStream.format("parquet")
                .partitionBy(LOAD_RUN)
                .option("checkpointLocation", folders.stream)
                .outputMode("append")
                .trigger(availableNow=True)
                .start(folders.landing)
                .awaitTermination()
            )
        finally:
            # Also when the stream failed: the batches it had committed are complete and count once.
            published = publish_landed(folders, schema, target, corrupt_column, rejects)
    except Exception as err:  # noqa: BLE001 - recorded, then re-raised
        record("FAILURE", failure_reason=error_text(err))
        raise
    record("SUCCESS")
    runs, rows, rejected = published
    return IncrementalRun(folders.last_batch() - before, rows, rejected, tuple(runs))


def ingest_new_json_files(
    spark: SparkSession,
    source: str,
    target: TableRef | str,
    checkpoint: str,
    *,
    paths: Mapping[str, str] | None = None,
    as_of: AsOf = None,
    raw_column: str = RAW_COLUMN,
    corrupt_column: str | None = CORRUPT_COLUMN,
    loaded_at: str = LOADED_AT,
    rejects: TableRef | str | None = None,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    audit: tuple[JobMeta, TableRef | str] | None = None,
    clock: Callable[[], dt.datetime] | None = None,
    **options,
) -> IncrementalRun:
    """Load the JSON files new under ``source`` into ``target`` (raw VARIANT + load time + keys).

    A line that does not parse goes to ``rejects`` (default: beside the target) with its text, as in
    a batch load. ``audit=(JobMeta, log)`` appends a job-status record for the run.
    """
    options = _source_options(options, max_files_per_trigger, clean_source, archive_dir)
    stream = load_raw_json(
        spark,
        source,
        paths,
        as_of,
        raw_column=raw_column,
        corrupt_column=corrupt_column,
        loaded_at=loaded_at,
        streaming=True,
        **options,
    )
    return _run(stream, target, checkpoint, corrupt_column, rejects, audit, clock)


def ingest_new_csv_files(
    spark: SparkSession,
    source: str,
    target: TableRef | str,
    checkpoint: str,
    schema: StructType | str,
    *,
    header: bool = True,
    sep: str = ",",
    as_of: AsOf = None,
    corrupt_column: str | None = CORRUPT_COLUMN,
    loaded_at: str | None = LOADED_AT,
    rejects: TableRef | str | None = None,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    audit: tuple[JobMeta, TableRef | str] | None = None,
    clock: Callable[[], dt.datetime] | None = None,
    **options,
) -> IncrementalRun:
    """Load the CSV files new under ``source`` into ``target``, typed by ``schema``, with their load time.

    A row that does not fit the schema goes to ``rejects`` (default: beside the target) with its text.
    """
    options = _source_options(options, max_files_per_trigger, clean_source, archive_dir)
    stream = load_csv(
        spark, source, schema, header=header, sep=sep, corrupt_column=corrupt_column, as_of=as_of, loaded_at=loaded_at,
        streaming=True, **options,
    )
    return _run(stream, target, checkpoint, corrupt_column, rejects, audit, clock)
