"""The daily ingest audit end to end: config -> per-table day counts -> job-status log (AUD-1..4)."""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tablewatch.functions.time import AsOf
from tablewatch.functions.time import as_of_date, to_datetime
from tablewatch.operators.audit import (
    DEFAULT_TASK_PREFIX,
    append_job_status,
    audit_all,
    config_pairs,
    table_resolver,
    to_job_status,
)
from tablewatch.session import error_text, is_read_error, local_frame
from tablewatch.sources.tables import TableLike, TableRef


def run_daily_audit(
    spark: SparkSession,
    config: DataFrame | list[tuple[str, str]],
    tables: Mapping[str, TableLike] | Callable[[str], TableLike],
    as_of: AsOf,
    *,
    log: TableRef | str,
    schema_name: str,
    job_type: str,
    dag_id: str,
    include_empty: bool = False,
) -> DataFrame:
    """Count yesterday's rows of every configured table and append one job-status row per table
    that had any (all tables in one Spark job, one append). Returns the rows appended.

    A configured table that cannot be read (missing, or without the date column) does not stop
    the others: it gets a ``FAILURE`` row carrying the error, as a failed per-table task would.
    The batch has at most one row per configured table: it is measured once (one job) and kept
    as local rows, so numbering and appending do not count the tables again.
    """
    resolve = table_resolver(spark, tables)
    readable, failures = [], []
    for name, date_col in config_pairs(config):
        try:
            df = resolve(name)
            if not any(c.lower() == date_col.lower() for c in df.columns):
                raise ValueError(f"column {date_col!r} not in {name}")
            readable.append((name, date_col))
        except Exception as err:  # noqa: BLE001 - recorded as that table's FAILURE row
            if not is_read_error(err):
                raise
            failures.append((name, error_text(err)))

    def rows_of(pairs: list[tuple[str, str]]) -> DataFrame:
        counts = audit_all(spark, pairs, tables, as_of, include_empty=include_empty)
        return to_job_status(counts, schema_name=schema_name, job_type=job_type, dag_id=dag_id, as_of=as_of)

    def alone(pair: tuple[str, str]) -> tuple[list, tuple[str, str] | None]:
        try:
            return [tuple(r) for r in rows_of([pair]).collect()], None
        except Exception as err:  # noqa: BLE001 - recorded as that table's FAILURE row
            if not is_read_error(err):
                raise
            return [], (pair[0], error_text(err))

    rows = rows_of(readable)
    try:
        measured = [tuple(r) for r in rows.collect()]
    except Exception as err:  # noqa: BLE001 - a table failed while running: each is counted in a job of its own
        if not is_read_error(err):
            raise
        measured = []
        with ThreadPoolExecutor(max_workers=min(16, len(readable))) as pool:
            for got, failed in pool.map(alone, readable):
                measured.extend(got)
                failures.extend([failed] if failed else [])
    when, day = to_datetime(as_of), as_of_date(as_of) - dt.timedelta(days=1)
    for name, reason in failures:
        measured.append(
            (when, when, schema_name, name, DEFAULT_TASK_PREFIX + name, job_type, dag_id, day, "FAILURE",
             0, 0, 0, 0, 0, reason)
        )
    return append_job_status(local_frame(spark, measured, rows.schema), log)
