"""The validation run (REC-14, REC-15): four reports, their appends and their failed rows.

The profiles that several reports share are measured once: those built by ``table_profile`` /
``column_profiles`` / ``source_profile`` are already local rows, so the tables behind them are
scanned once per run, and the reports, their appends and the failed-row filters all read the
measured rows. Profile frames that are still lazy plans over tables (e.g. read from a database
view) should be passed with ``checkpoint=True``: they are then stored once in the session's
checkpoint folder before the reports use them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.time import AsOf
from tablewatch.operators.reconcile import (
    DEFAULT_EXEMPT_SUFFIX,
    column_drift,
    failed_rows,
    inventory,
    merged_report,
    missing_columns,
    reconcile_counts,
)
from tablewatch.session import materialize
from tablewatch.sources.tables import TableRef, drop_run, has_runs, write_runs, write_table

REPORTS = ("counts", "drift", "missing", "merged")

# Presentation order of each report.
REPORT_ORDER = {
    "counts": ["database_name", "schema_name", "table_view_name"],
    "drift": ["target_table_catalog", "target_table_schema", "target_table_name", "target_column_name"],
    "missing": ["target_table_catalog", "target_table_schema", "target_table_name", "target_column_name"],
    "merged": ["database_name", "schema_name", "table_name"],
}


@dataclass
class ValidationRun:
    counts: DataFrame
    drift: DataFrame
    missing: DataFrame
    merged: DataFrame
    failed: dict[str, DataFrame] = field(default_factory=dict)

    def reports(self) -> dict[str, DataFrame]:
        return {"counts": self.counts, "drift": self.drift, "missing": self.missing, "merged": self.merged}

    def ordered(self, failed: bool = False) -> dict[str, DataFrame]:
        """Reports (or their failed rows) sorted for display -- a sort of a few metadata rows,
        applied only at the presentation edge."""
        frames = self.failed if failed else self.reports()
        return {name: df.orderBy(*REPORT_ORDER[name]) for name, df in frames.items()}

    def preview(self, n: int = 5, failed: bool = False) -> dict[str, DataFrame]:
        """The first ``n`` rows of each ordered report, for a log or a message."""
        return {name: df.limit(n) for name, df in self.ordered(failed).items()}


# Partition column of the report tables.
REPORT_RUN = "report_run"


def append_reports(
    reports: Mapping[str, DataFrame], sinks: Mapping[str, TableRef | str], run_key: str | None = None
) -> None:
    """REC-14: append each complete report to its table (created when absent).

    With ``run_key`` the rows go into the run's own partition in place of what it held, so a run that is
    repeated, whole or after a failure, is in the tables once. The appends are independent jobs,
    submitted together so they run side by side.
    """
    todo = [(df, sinks[name]) for name, df in reports.items() if name in sinks]
    if not todo:
        return

    def append(df: DataFrame, sink: TableRef | str) -> None:
        if run_key is None:
            write_table(df, sink, "append")
            return
        write_runs(df.withColumn(REPORT_RUN, F.lit(run_key)), sink, [run_key], REPORT_RUN)
        if df.isEmpty() and has_runs(df.sparkSession, sink, REPORT_RUN):
            drop_run(df.sparkSession, sink, run_key, REPORT_RUN)  # the run reports nothing any more

    with ThreadPoolExecutor(max_workers=len(todo)) as pool:
        for f in [pool.submit(append, df, sink) for df, sink in todo]:
            f.result()


def _stored(df: DataFrame, checkpoint: bool) -> DataFrame:
    return materialize(df) if checkpoint else df


def run_validation(
    *,
    target_profile: DataFrame,
    replica_profile: DataFrame,
    target_columns: DataFrame,
    replica_columns: DataFrame,
    inventory_profiles: DataFrame | Iterable[DataFrame],
    inventory_columns: DataFrame | Iterable[DataFrame],
    sources: Mapping[str, DataFrame | None],
    as_of: AsOf,
    legacy: DataFrame | None = None,
    extra: Iterable[str] = (),
    exempt_suffix: str | None = DEFAULT_EXEMPT_SUFFIX,
    match_on: Iterable[str] = ("table_catalog", "table_schema", "table_name"),
    sinks: Mapping[str, TableRef | str] | None = None,
    checkpoint: bool = False,
    run_key: str | None = None,
) -> ValidationRun:
    """REC-15: build the counts, drift, missing-column and merged reports, append the complete
    reports to ``sinks`` (when given) and return them with their failed rows. ``run_key`` makes the append
    one that can be repeated (see ``append_reports``).

    Errors are raised, not swallowed: a step that fails stops the run.
    """
    target_profile = _stored(target_profile, checkpoint)
    replica_profile = _stored(replica_profile, checkpoint)
    target_columns = _stored(target_columns, checkpoint)
    replica_columns = _stored(replica_columns, checkpoint)
    legacy = _stored(legacy, checkpoint) if legacy is not None else None

    counts = reconcile_counts(target_profile, replica_profile, legacy, as_of=as_of, extra=extra)
    drift = column_drift(replica_columns, target_columns, as_of=as_of, exempt_suffix=exempt_suffix)
    missing = missing_columns(
        target_columns, replica_columns, replica_profile.select("table_name"), as_of=as_of
    )
    inv = inventory(inventory_profiles, inventory_columns, as_of=as_of, match_on=match_on)
    merged = merged_report(inv, sources, as_of)

    run = ValidationRun(counts, drift, missing, merged)
    if sinks:
        append_reports(run.reports(), sinks, run_key)
    run.failed = {name: failed_rows(name, df) for name, df in run.reports().items()}
    return run
