"""tablewatch: land, audit and reconcile tables with Spark DataFrames.

The main entry points are re-exported here; the sub-packages hold the rest:
``sources`` (readers, table refs, JDBC), ``functions`` (column expressions), ``operators``
(ingest, audit, profiles, reconciliation), ``plans`` (multi-step runs), ``streaming``
(incremental file loads).
"""

from tablewatch.operators import (
    JobMeta,
    append_job_status,
    append_load,
    audit_all,
    column_drift,
    column_profile,
    column_profiles,
    daily_ingest_counts,
    failed_rows,
    freshness,
    inventory,
    load_csv,
    load_csv_positional,
    load_raw_json,
    load_table,
    load_with_audit,
    merged_report,
    missing_columns,
    object_profile,
    reconcile_counts,
    replace_table,
    source_profile,
    table_profile,
    to_job_status,
)
from tablewatch.plans import run_daily_audit, run_gated_loads, run_validation
from tablewatch.session import build_session, scratch_path, shared_dir
from tablewatch.sources import TableRef, read_delimited_config
from tablewatch.streaming import ingest_new_csv_files, ingest_new_json_files

__all__ = [
    "JobMeta",
    "TableRef",
    "append_job_status",
    "append_load",
    "audit_all",
    "build_session",
    "column_drift",
    "column_profile",
    "column_profiles",
    "daily_ingest_counts",
    "failed_rows",
    "freshness",
    "ingest_new_csv_files",
    "ingest_new_json_files",
    "inventory",
    "load_csv",
    "load_csv_positional",
    "load_raw_json",
    "load_table",
    "load_with_audit",
    "merged_report",
    "missing_columns",
    "object_profile",
    "read_delimited_config",
    "reconcile_counts",
    "replace_table",
    "run_daily_audit",
    "run_gated_loads",
    "run_validation",
    "scratch_path",
    "shared_dir",
    "source_profile",
    "table_profile",
    "to_job_status",
]
