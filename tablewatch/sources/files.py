"""File readers: raw JSON records as VARIANT, CSV by position or by schema, the audit config.

All are ordinary ``spark.read`` / ``spark.readStream`` sources, so file splitting, parallel parsing
and column pruning are Spark's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

RAW_COLUMN = "raw"
CORRUPT_COLUMN = "_corrupt_record"


def _json_reader(reader, raw_column: str, corrupt_column: str | None, options: dict):
    # The corrupt-record option must be set before singleVariantColumn / schema: the schema is
    # validated as soon as both are present.
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    reader = reader.option("singleVariantColumn", raw_column).options(**options)
    ddl = f"`{raw_column}` variant" + (f", `{corrupt_column}` string" if corrupt_column else "")
    return reader.format("json").schema(ddl)


def read_raw_json(
    spark: SparkSession,
    path: str | list[str],
    *,
    raw_column: str = RAW_COLUMN,
    corrupt_column: str | None = CORRUPT_COLUMN,
    streaming: bool = False,
    **options,
) -> DataFrame:
    """Every JSON record under ``path`` as one VARIANT column, schema-on-read.

    A line that does not parse gives a row with a null ``raw`` and its text in ``corrupt_column``
    (PERMISSIVE mode), so malformed input stays visible and countable.
    """
    reader = spark.readStream if streaming else spark.read
    r = _json_reader(reader, raw_column, corrupt_column, options)
    if streaming:
        return r.load(path)
    return r.load(path if isinstance(path, str) else list(path))


def positional_schema(n_columns: int, prefix: str = "c") -> StructType:
    """``c1 string, ..., cN string``: columns taken by position, untyped."""
    return StructType([StructField(f"{prefix}{i}", StringType(), True) for i in range(1, n_columns + 1)])


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    *,
    header: bool = False,
    sep: str = ",",
    corrupt_column: str | None = None,
    streaming: bool = False,
    **options,
) -> DataFrame:
    """CSV with an explicit schema (never inferred: inference is a full extra pass over the data).

    In the default PERMISSIVE mode a short row is padded with nulls and extra fields are dropped. With
    ``corrupt_column`` the text of a row that does not fit the schema (a value of another type, more or
    fewer fields) is kept in that column; it is null for the others.
    """
    reader = spark.readStream if streaming else spark.read
    if corrupt_column:
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
        schema = schema.add(corrupt_column, StringType(), True)
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    r = reader.schema(schema).option("header", header).option("sep", sep).options(**options).format("csv")
    return r.load(path)


def read_delimited_config(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """A small header-first delimited config file, all columns as strings."""
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
