"""An event log of jobs: a row when a job opens, a row when it closes, folded to each job's state.

A job-status record written only at the end leaves no trace of a job whose driver is lost. Here the
opening is on record before the work starts; both rows are appended, none is changed. A job's state is
its latest event (``max_by``): one with an opening alone is still running, or lost.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from tablewatch.functions.time import AsOf, hours_before, to_datetime
from tablewatch.schemas import JOB_STATUS
from tablewatch.session import local_frame
from tablewatch.sources.tables import TableRef, append_rows

OPEN, CLOSE = "OPEN", "CLOSE"
RUNNING, LOST = "RUNNING", "LOST"

_STATUS_FIELDS = [f for f in JOB_STATUS.fields if f.name != "job_id"]
JOB_EVENTS = StructType(
    [StructField("run_key", StringType(), True), StructField("event", StringType(), True), StructField("event_ts", TimestampNTZType(), True), *_STATUS_FIELDS]
)


def _append(spark: SparkSession, log: TableRef | str, run_key: str, event: str, when: dt.datetime, status: tuple) -> None:
    append_rows(local_frame(spark, [(run_key, event, when, *status[1:])], JOB_EVENTS), log)


def open_job(
    spark: SparkSession, values: tuple, log: TableRef | str, clock: Callable[[], dt.datetime] | None = None
) -> str:
    """Record that a job starts. ``values``: a ``JOB_STATUS`` tuple as far as it is known. Returns the run's key."""
    when = (clock or (lambda: to_datetime(None)))()
    run_key = uuid.uuid4().hex
    _append(spark, log, run_key, OPEN, when, values)
    return run_key


def close_job(
    spark: SparkSession, run_key: str, values: tuple, log: TableRef | str, clock: Callable[[], dt.datetime] | None = None
) -> None:
    """Record a job's end; ``values`` is its final ``JOB_STATUS`` tuple."""
    _append(spark, log, run_key, CLOSE, (clock or (lambda: to_datetime(None)))(), values)


def job_runs(events: DataFrame, as_of: AsOf = None, lost_after_hours: float = 24) -> DataFrame:
    """One row per run: its ``JOB_STATUS`` columns (without id) as of its latest event.

    A run that has only opened is ``RUNNING``, or ``LOST`` once ``lost_after_hours`` have passed at ``as_of``. One
    partial aggregate; a closing row wins over an opening row of the same instant.
    """
    latest = F.struct("event_ts", (F.col("event") == CLOSE).cast("int"))
    names = [f.name for f in _STATUS_FIELDS]
    state = events.groupBy("run_key").agg(F.max_by(F.struct("event", *names), latest).alias("s"))
    opened = F.when(F.col("s.job_start_ts") <= hours_before(as_of, lost_after_hours), LOST).otherwise(RUNNING)
    return state.select(
        "run_key",
        *[(F.when(F.col("s.event") == OPEN, opened).otherwise(F.col("s.job_status")) if n == "job_status" else F.col(f"s.{n}")).alias(n) for n in names],
    )
