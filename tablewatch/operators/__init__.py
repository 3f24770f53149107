"""User-level operators: ingest, ingest audit, profiles, reconciliation."""

from tablewatch.operators.audit import (
    append_job_status,
    audit_all,
    daily_ingest_counts,
    to_job_status,
    with_job_ids,
)
from tablewatch.operators.ingest import (
    JobMeta,
    LoadResult,
    append_load,
    job_status_row,
    load_csv,
    load_csv_positional,
    load_raw_json,
    load_table,
    load_with_audit,
    replace_table,
    write_load,
)
from tablewatch.operators.job_log import close_job, job_runs, open_job
from tablewatch.operators.profile import (
    FILE_MODIFIED,
    column_counts,
    column_profile,
    column_profiles,
    footer_row_counts,
    listed_source_rows,
    object_profile,
    source_profile,
    table_profile,
)
from tablewatch.operators.profile_state import ProfileState, Variant, measure_profiles
from tablewatch.operators.reconcile import (
    column_drift,
    failed_checks,
    failed_rows,
    freshness,
    inventory,
    merge_sources,
    merged_report,
    missing_columns,
    normalize_counts,
    reconcile_counts,
    with_checks,
)

__all__ = [
    "FILE_MODIFIED",
    "JobMeta",
    "LoadResult",
    "ProfileState",
    "Variant",
    "append_job_status",
    "append_load",
    "audit_all",
    "close_job",
    "column_counts",
    "column_drift",
    "column_profile",
    "column_profiles",
    "daily_ingest_counts",
    "failed_checks",
    "failed_rows",
    "footer_row_counts",
    "listed_source_rows",
    "freshness",
    "inventory",
    "job_runs",
    "job_status_row",
    "load_csv",
    "load_csv_positional",
    "load_raw_json",
    "load_table",
    "load_with_audit",
    "measure_profiles",
    "merge_sources",
    "merged_report",
    "missing_columns",
    "normalize_counts",
    "object_profile",
    "open_job",
    "reconcile_counts",
    "replace_table",
    "source_profile",
    "table_profile",
    "to_job_status",
    "with_checks",
    "with_job_ids",
    "write_load",
]
