"""Fixed output schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "string": StringType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
}


def schema_of(ddl: str) -> StructType:
    """``"a bigint, b string"`` -> ``StructType`` without needing a session (flat schemas only)."""
    fields = []
    for part in ddl.split(","):
        name, type_name = part.split()
        fields.append(StructField(name, _TYPES[type_name], True))
    return StructType(fields)


# The job-status log: 16 columns, in this order.
JOB_STATUS = schema_of(
    "job_id bigint, job_start_ts timestamp_ntz, job_end_ts timestamp_ntz, schema_name string, "
    "table_name string, task_id string, job_type string, dag_id string, dag_run_exec_date date, "
    "job_status string, recs_parsed bigint, recs_staged bigint, recs_inserted bigint, "
    "recs_updated bigint, recs_deleted bigint, failure_reason string"
)

JOB_STATUS_COLUMNS = [f.name for f in JOB_STATUS.fields]

# Per-table profile (one row per table).
TABLE_PROFILE = schema_of(
    "table_catalog string, table_schema string, table_name string, table_type string, "
    "row_count bigint, column_count bigint, last_altered timestamp_ntz"
)

# Per-column profile (one row per column).
COLUMN_PROFILE = schema_of(
    "table_catalog string, table_schema string, table_name string, column_name string, "
    "ordinal_position int, is_nullable string, data_type string, character_maximum_length int"
)

# A source-side profile, one row per table.
SOURCE_PROFILE = schema_of("table_name string, source_rows bigint, source_columns bigint")

# Legacy statistics, one row per table.
LEGACY_STATS = schema_of("tablename string, rowcount bigint, columncount bigint")
