"""Database sources over JDBC: partitioned table reads and a warehouse's catalog views.

A large table is read by ``numPartitions`` parallel range queries on ``partition_column`` -- the
way to pull a big source table into Spark without funnelling it through one connection. The
catalog views become the same profile frames the reconciliation operators take, so a warehouse
can be compared with files or with another warehouse. Filters are DataFrame ``where`` clauses,
which Spark pushes into the JDBC query; no SQL text is assembled here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.functions.time import utc_ntz
from tablewatch.operators.profile import BASE_TABLE, DEFAULT_EXCLUDE
from tablewatch.schemas import schema_of
from tablewatch.session import local_frame


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **properties: str,
) -> DataFrame:
    """``spark.read.format("jdbc")`` of ``table``; partitioned when ``partition_column`` is given
    (then ``lower_bound``, ``upper_bound`` and ``num_partitions`` are required: they only shape
    the split, every row is read)."""
    r = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", str(fetch_size))
        .options(**properties)
    )
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return r.load()


def catalog_columns(columns_view: DataFrame, *, schemas: Iterable[str] | None = None) -> DataFrame:
    """An information-schema column view as a column profile (declared nullability, lengths).

    Column names of the view are matched case-insensitively (``TABLE_NAME`` or ``table_name``).
    """
    cols = columns_view
    if schemas is not None:
        cols = cols.where(F.col("table_schema").isin(list(schemas)))
    return cols.select(
        F.col("table_catalog").cast("string").alias("table_catalog"),
        F.col("table_schema").cast("string").alias("table_schema"),
        F.col("table_name").cast("string").alias("table_name"),
        F.col("column_name").cast("string").alias("column_name"),
        F.col("ordinal_position").cast("int").alias("ordinal_position"),
        F.col("is_nullable").cast("string").alias("is_nullable"),
        F.col("data_type").cast("string").alias("data_type"),
        F.col("character_maximum_length").cast("int").alias("character_maximum_length"),
    )


def catalog_tables(
    tables_view: DataFrame,
    columns_view: DataFrame,
    *,
    schemas: Iterable[str] | None = None,
    exclude: Iterable[str] = DEFAULT_EXCLUDE,
    table_type: str | None = BASE_TABLE,
    row_count: str = "row_count",
    last_altered: str | None = "last_altered",
) -> DataFrame:
    """An information-schema table view as a table profile; ``column_count`` from the column view.

    ``row_count`` / ``last_altered`` name the view's columns holding them (they differ between
    databases; ``last_altered=None`` leaves it null). Views are left out unless ``table_type`` is
    ``None``; names in ``exclude`` are left out (case-insensitive).
    """
    t = tables_view
    if schemas is not None:
        t = t.where(F.col("table_schema").isin(list(schemas)))
    if table_type:
        t = t.where(F.col("table_type") == table_type)
    exclude = [e.upper() for e in exclude]
    if exclude:
        t = t.where(~F.upper(F.col("table_name")).isin(exclude))
    keys = ["table_catalog", "table_schema", "table_name"]
    counts = (
        catalog_columns(columns_view, schemas=schemas)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).cast("bigint").alias("column_count"))
    )
    changed = utc_ntz(t, last_altered) if last_altered else F.lit(None).cast("timestamp_ntz")
    prof = t.select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.col("table_type").cast("string").alias("table_type"),
        F.col(row_count).cast("bigint").alias("row_count"),
        changed.alias("last_altered"),
    )
    return prof.join(counts, keys, "left").select(*keys, "table_type", "row_count", "column_count", "last_altered")


def warehouse_columns(
    spark: SparkSession,
    url: str,
    *,
    schemas: Iterable[str] | None = None,
    view: str = "INFORMATION_SCHEMA.COLUMNS",
    **properties: str,
) -> DataFrame:
    """``catalog_columns`` of a warehouse read over JDBC (the schema filter reaches the database)."""
    return catalog_columns(read_jdbc(spark, url, view, **properties), schemas=schemas)


def warehouse_tables(
    spark: SparkSession,
    url: str,
    *,
    schemas: Iterable[str] | None = None,
    exclude: Iterable[str] = DEFAULT_EXCLUDE,
    table_type: str | None = BASE_TABLE,
    row_count: str = "row_count",
    last_altered: str | None = "last_altered",
    view: str = "INFORMATION_SCHEMA.TABLES",
    columns_view: str = "INFORMATION_SCHEMA.COLUMNS",
    **properties: str,
) -> DataFrame:
    """``catalog_tables`` of a warehouse read over JDBC. Both views are small; run the result
    through ``run_validation(checkpoint=True)`` (or collect it once) when several reports use it."""
    return catalog_tables(
        read_jdbc(spark, url, view, **properties),
        read_jdbc(spark, url, columns_view, **properties),
        schemas=schemas,
        exclude=exclude,
        table_type=table_type,
        row_count=row_count,
        last_altered=last_altered,
    )


def partition_row_counts(
    partitions: DataFrame,
    tables: DataFrame,
    *,
    restrict_to: Iterable[str] | None = None,
    name_column: str = "name",
) -> DataFrame:
    """Rows per table from a database's partition statistics, without scanning any table.

    ``partitions`` has ``object_id, index_id, rows`` (one row per partition of each index);
    ``tables`` has ``object_id`` and the table name. Only the base data is counted (``index_id``
    0 for a heap, 1 for a clustered index; other indexes repeat the rows). Names are upper-cased
    and the sum is per name. ``restrict_to`` keeps listed names only (a semi-join, never a list
    spliced into SQL text). Returns ``table_name, source_rows``.
    """
    base = partitions.where(F.col("index_id") < 2).select("object_id", F.col("rows").cast("bigint").alias("rows"))
    named = tables.select("object_id", F.upper(F.col(name_column)).alias("table_name"))
    counts = base.join(named, "object_id").groupBy("table_name").agg(F.sum("rows").cast("bigint").alias("source_rows"))
    if restrict_to is not None:
        spark = partitions.sparkSession
        wanted = local_frame(spark, [(n.upper(),) for n in restrict_to], schema_of("table_name string"))
        counts = counts.join(wanted, "table_name", "left_semi")
    return counts


def read_partition_row_counts(
    spark: SparkSession,
    url: str,
    *,
    restrict_to: Iterable[str] | None = None,
    partitions_view: str = "sys.partitions",
    tables_view: str = "sys.tables",
    **properties: str,
) -> DataFrame:
    """``partition_row_counts`` over a database's catalog views read through JDBC (the
    ``index_id`` filter is pushed into the query sent to the database)."""
    return partition_row_counts(
        read_jdbc(spark, url, partitions_view, **properties),
        read_jdbc(spark, url, tables_view, **properties),
        restrict_to=restrict_to,
    )
