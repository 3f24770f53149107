"""Sources and sinks: table references, raw file readers."""

from tablewatch.sources.files import (
    CORRUPT_COLUMN,
    RAW_COLUMN,
    positional_schema,
    read_csv,
    read_delimited_config,
    read_raw_json,
)
from tablewatch.sources.tables import (
    TableLike,
    TableRef,
    as_ref,
    database_tables,
    read_table,
    table_exists,
    tables_in,
    try_read_table,
    write_table,
)

__all__ = [
    "CORRUPT_COLUMN",
    "RAW_COLUMN",
    "TableLike",
    "TableRef",
    "as_ref",
    "database_tables",
    "positional_schema",
    "read_csv",
    "read_delimited_config",
    "read_raw_json",
    "read_table",
    "table_exists",
    "tables_in",
    "try_read_table",
    "write_table",
]
