"""Gated reloads of many tables (ING-6 fanned out, with ING-8 records).

Each table whose run flag is ``'Y'`` is fully reloaded. The loads are independent Spark jobs, so
they are submitted from a small thread pool and run side by side on the cluster (the scheduler
interleaves their tasks), instead of one after another. With an audit log, every reload leaves a
job-status record, and one failed reload does not stop the others.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tablewatch.functions.time import to_datetime
from tablewatch.operators.audit import append_job_status
from tablewatch.operators.ingest import JobMeta, LoadResult, job_status_values, load_table, success_values
from tablewatch.schemas import JOB_STATUS
from tablewatch.session import error_text, local_frame
from tablewatch.sources.tables import TableLike, TableRef

DEFAULT_CONCURRENCY = 20
# Fixed value: task id of a gated reload, from the lower-cased table name.
GATED_TASK_ID = "load_{name}_table"


def gated_meta(name: str) -> JobMeta:
    """Default job-status fields of a gated reload."""
    return JobMeta(schema_name="", table_name=name, task_id=GATED_TASK_ID.format(name=name.lower()))


def run_flags(control: DataFrame | Mapping[str, str], name_col: str = "table_name", flag_col: str = "run_flag") -> dict[str, str]:
    """``{table: flag}`` from a control table (one row per table; collected, it drives the plan)."""
    if isinstance(control, DataFrame):
        return {r[0]: r[1] for r in control.select(name_col, flag_col).collect()}
    return dict(control)


def run_gated_loads(
    spark: SparkSession,
    control: DataFrame | Mapping[str, str],
    sources: Mapping[str, TableLike | Callable[[], DataFrame]],
    targets: Mapping[str, TableRef | str] | Callable[[str], TableRef | str],
    *,
    concurrency: int = DEFAULT_CONCURRENCY,
    audit_log: TableRef | str | None = None,
    meta: Callable[[str], JobMeta] = gated_meta,
    clock: Callable[[], dt.datetime] | None = None,
) -> dict[str, LoadResult | None]:
    """Reload every table flagged ``'Y'``; ``None`` for a table that was skipped.

    With ``audit_log``, each reload leaves a job-status record (``SUCCESS`` with its counts, or
    ``FAILURE`` with the error); the records of the run are appended together. A failed reload
    does not stop the others; once all have finished (and been recorded) its error is raised.
    """
    flags = run_flags(control)
    clock = clock or (lambda: to_datetime(None))

    def one(name: str):
        target = targets(name) if callable(targets) else targets[name]
        start = clock()
        try:
            res = load_table(spark, name, sources[name], target, flags.get(name))
        except Exception as err:  # noqa: BLE001 - recorded, raised after the others
            return None, job_status_values(meta(name), start, clock(), "FAILURE", failure_reason=error_text(err)), err
        rec = None if res is None else success_values(meta(name), start, clock(), res)
        return res, rec, None

    names = list(flags)
    with ThreadPoolExecutor(max_workers=max(1, min(concurrency, len(names) or 1))) as pool:
        outcomes = list(pool.map(one, names))
    records = [rec for _, rec, _ in outcomes if rec is not None]
    if audit_log is not None and records:
        append_job_status(local_frame(spark, records, JOB_STATUS), audit_log)
    errors = [err for _, _, err in outcomes if err is not None]
    if errors:
        raise errors[0]
    return {name: res for name, (res, _, _) in zip(names, outcomes)}
