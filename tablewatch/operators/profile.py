"""Table and column profiles: the catalog metadata a reconciliation compares.

Spark has no information schema for files, and Parquet stores every column as nullable, so the
profiles are *measured*: row counts, observed nullability and observed maximum text length, all
computed by Spark jobs that scale with the tables.

- ``table_profile``: one ``count(*)`` per table (Parquet answers it from footers and row-group
  sizes; the plan's ``ReadSchema`` is empty) plus an optional last-change time.
- ``column_profile(s)``: every column of a table in **one** aggregate (a null count and, for text,
  a max length per column); never a job per column.
- ``source_profile``: row counts summed from partition counts that come from file footers, as a
  partition-statistics view reports them.
- ``object_profile``: row and column counts per object; an object that cannot be read is skipped
  and reported, not fatal.

Each profile measures all its tables in **one** job -- a union of per-table partial/final
aggregates, so the scans run side by side -- and returns the result, a few rows per table, as a
local frame: metadata the size of a catalog view. Every report built on a profile reads those
rows and never the tables again, and no executor loss can send Spark back to the scans.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField

from tablewatch.functions.time import utc_ntz
from tablewatch.schemas import COLUMN_PROFILE, SOURCE_PROFILE, TABLE_PROFILE, schema_of
from tablewatch.session import error_text, is_read_error, local_frame
from tablewatch.sources import store
from tablewatch.sources.tables import TableLike, as_ref, read_table

# Fixed values (as in the reconciled systems' catalogs): the tables left out of every profile by
# default (schema-migration bookkeeping) and the table type of a base table.
DEFAULT_EXCLUDE = ("DATABASECHANGELOG", "DATABASECHANGELOGLOCK")
BASE_TABLE = "BASE TABLE"
# Column path of a file's modification time, usable as a last-change time of file tables.
FILE_MODIFIED = "_metadata.file_modification_time"

RESOLVE_CONCURRENCY = 16

_VARCHAR = re.compile(r"^\s*(var)?char\((\d+)\)\s*$", re.IGNORECASE)


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _excluded(name: str, exclude: Iterable[str]) -> bool:
    return name.upper() in {e.upper() for e in exclude}


TableKey = str | tuple[str, str, str]


def _key(key: TableKey, catalog: str, schema: str) -> tuple[str, str, str]:
    """A table key is its name (catalog and schema from the arguments) or ``(catalog, schema, name)``."""
    return tuple(key) if isinstance(key, tuple) else (catalog, schema, key)


def _union(parts: list[DataFrame], spark: SparkSession, schema) -> DataFrame:
    if not parts:
        return local_frame(spark, [], schema)
    return reduce(DataFrame.unionByName, parts)


def _measure(spark: SparkSession, parts: list[DataFrame]) -> list:
    """Run the per-table aggregates as one job (a union) and return their few rows."""
    return reduce(DataFrame.unionByName, parts).collect() if parts else []


# REC-1
def table_profile(
    spark: SparkSession,
    tables: Mapping[TableKey, TableLike],
    *,
    catalog: str = "",
    schema: str = "",
    table_type: str = BASE_TABLE,
    exclude: Iterable[str] = DEFAULT_EXCLUDE,
    last_altered: str | Mapping[str, str | None] | None = None,
    measure: bool = True,
) -> DataFrame:
    """One row per table: ``table_catalog, table_schema, table_name, table_type, row_count,
    column_count, last_altered``.

    ``tables`` is keyed by table name, or by ``(catalog, schema, name)`` to measure tables of
    several schemas or systems in the same job. ``last_altered`` is a column (or column path such
    as ``FILE_MODIFIED``) whose maximum is the table's last change, given once for all tables or
    per table key or name; ``None`` leaves it null.

    All tables are measured in one job (a union of one partial/final aggregate per table) and the
    result -- one row per table -- comes back as a local frame, so the reports built on it never
    scan the tables again. ``measure=False`` returns the unevaluated plan instead.
    """
    keys, parts = [], []
    for key, t in tables.items():
        cat, sch, name = _key(key, catalog, schema)
        if _excluded(name, exclude):
            continue
        df = read_table(spark, t)
        if isinstance(last_altered, Mapping):
            la = last_altered.get(key, last_altered.get(name))
        else:
            la = last_altered
        changed = F.max(utc_ntz(df, la)) if la else F.lit(None).cast("timestamp_ntz")
        i = len(keys)
        keys.append((cat, sch, name, len(df.columns)))
        parts.append(
            df.agg(
                F.lit(i).alias("_i"),
                F.count(F.lit(1)).alias("row_count"),
                changed.alias("last_altered"),
            )
        )
    if not measure:
        plan = [
            p.select(
                F.lit(keys[i][0]).alias("table_catalog"),
                F.lit(keys[i][1]).alias("table_schema"),
                F.lit(keys[i][2]).alias("table_name"),
                F.lit(table_type).alias("table_type"),
                F.col("row_count").cast("bigint"),
                F.lit(keys[i][3]).cast("bigint").alias("column_count"),
                "last_altered",
            )
            for i, p in enumerate(parts)
        ]
        return _union(plan, spark, TABLE_PROFILE)
    rows = [
        (*keys[r["_i"]][:3], table_type, r["row_count"], keys[r["_i"]][3], r["last_altered"])
        for r in _measure(spark, parts)
    ]
    return local_frame(spark, rows, TABLE_PROFILE)


def _declared(field: StructField) -> tuple[str, int | None]:
    """Declared type text and char/varchar length (kept in the field metadata by Spark)."""
    raw = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING") if field.metadata else None
    if raw:
        m = _VARCHAR.match(raw)
        if m:
            return ("varchar" if m.group(1) else "char"), int(m.group(2))
    return field.dataType.simpleString(), None


def _is_text(f: StructField) -> bool:
    return isinstance(f.dataType, (StringType, BinaryType))


def column_stats_plan(df: DataFrame, index: int = 0) -> DataFrame:
    """One aggregate over ``df``: per column a null count (``n<i>``) and, for text, the longest
    value (``l<i>``), packed as one JSON object so tables of any shape union into one job."""
    aggs = []
    for i, f in enumerate(df.schema.fields):
        c = _q(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"n{i}"))
        if _is_text(f):
            aggs.append(F.max(F.length(c)).alias(f"l{i}"))
    return df.agg(F.lit(index).alias("_i"), F.to_json(F.struct(*aggs)).alias("_stats"))


def _column_rows(fields, stats: dict | None, catalog: str, schema: str, table_name: str) -> list[tuple]:
    rows = []
    for i, f in enumerate(fields):
        dtype, length = _declared(f)
        if stats is None:
            nullable = "YES" if f.nullable else "NO"
        else:
            nullable = "YES" if stats.get(f"n{i}", 0) > 0 else "NO"
            if length is None and _is_text(f):
                length = stats.get(f"l{i}")
        rows.append((catalog, schema, table_name, f.name, i + 1, nullable, dtype, length))
    return rows


# REC-2
def column_profile(
    df: DataFrame,
    table_name: str,
    *,
    catalog: str = "",
    schema: str = "",
    observe: bool = True,
) -> DataFrame:
    """One row per column: ``table_catalog, table_schema, table_name, column_name,
    ordinal_position, is_nullable, data_type, character_maximum_length``.

    ``observe=True`` (default) measures in one pass: ``is_nullable`` is ``'YES'`` when the column
    holds a null, and the length of a text column is its longest value (a declared
    ``char``/``varchar`` length wins). ``observe=False`` reads only the schema (no job): the
    declared nullable flag and declared lengths.
    """
    return column_profiles(
        df.sparkSession, {(catalog, schema, table_name): df}, exclude=(), observe=observe
    )


def column_profiles(
    spark: SparkSession,
    tables: Mapping[TableKey, TableLike],
    *,
    catalog: str = "",
    schema: str = "",
    exclude: Iterable[str] = DEFAULT_EXCLUDE,
    observe: bool = True,
) -> DataFrame:
    """``column_profile`` of several tables (keyed like ``table_profile``) as one local frame.

    Observed profiles of all tables are measured in one job (one aggregate per table, a union);
    its result is one row per table, turned into one row per column on the driver.
    """
    entries = []
    for key, t in tables.items():
        cat, sch, name = _key(key, catalog, schema)
        if not _excluded(name, exclude):
            entries.append((cat, sch, name, read_table(spark, t)))
    stats: dict[int, dict] = {}
    if observe:
        measured = _measure(spark, [column_stats_plan(df, i) for i, (_, _, _, df) in enumerate(entries)])
        stats = {r["_i"]: json.loads(r["_stats"]) for r in measured}
    rows = []
    for i, (cat, sch, name, df) in enumerate(entries):
        rows += _column_rows(df.schema.fields, stats.get(i) if observe else None, cat, sch, name)
    return local_frame(spark, rows, COLUMN_PROFILE)


# REC-3
def column_counts(
    columns: DataFrame,
    keys: Iterable[str] = ("table_catalog", "table_schema", "table_name"),
) -> DataFrame:
    """Columns per table from a column profile: ``keys + column_count``."""
    return columns.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("column_count"))


# REC-7
def partition_columns(spark: SparkSession, folder: str) -> list[str]:
    """Partition columns of a table's folder, from the names of its first partition."""
    found: list[str] = []
    while inner := [n for n in store.children(spark, folder) if "=" in n and not n.startswith((".", "_"))]:
        found.append(inner[0].split("=", 1)[0])
        folder = f"{folder.rstrip('/')}/{inner[0]}"
    return found


# Settings of the session that reads row counts from file footers: Parquet through the source that
# takes aggregates, and partition values as the text they are in the folder's name.
FOOTER_CONF = {
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def footer_row_counts(spark: SparkSession, folder: str, table_name: str) -> DataFrame:
    """Rows per partition of a Parquet folder from its files' footers: ``table_name, partition, rows``
    (``partition``: the folder's name below the table, empty if the table has none).

    The count is pushed into the scan, grouped by the partition columns, so no row is read and nothing is
    computed for each row. It runs in a session of its own; the caller's settings stay."""
    reader = spark.newSession()
    for k, v in FOOTER_CONF.items():
        reader.conf.set(k, v)
    keys = partition_columns(spark, folder)
    df = reader.read.parquet(folder)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")) if keys else df.agg(F.count(F.lit(1)).alias("rows"))
    path = F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.coalesce(_q(k), F.lit(NULL_PARTITION))) for k in keys])
    return counted.select(F.lit(table_name).alias("table_name"), path.alias("partition"), "rows")


# Fixed value: the folder name Spark and Hive give a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def listed_source_rows(source: DataFrame, listed: DataFrame, table_column: str = "table_name") -> DataFrame:
    """Rows of each listed table of a source that keeps all its tables in one folder, partitioned by table:
    ``table_name, source_rows`` (names upper-cased).

    ``listed`` (``table_name``) is a frame, e.g. a filtered catalog table. It meets the source in a semi-join
    whose keys prune the source's partitions while the query runs (dynamic partition pruning): unlisted
    tables are not read, and the list never passes through the driver."""
    wanted = listed.select(F.col("table_name").alias("_listed"))
    kept = source.join(wanted, F.col(table_column) == F.col("_listed"), "left_semi")
    return kept.groupBy(F.upper(F.col(table_column)).alias("table_name")).agg(F.count(F.lit(1)).alias("source_rows"))


def source_profile(
    spark: SparkSession,
    partitioned: Mapping[str, TableLike],
    *,
    direct: Mapping[str, TableLike] | None = None,
    restrict_to: DataFrame | Iterable[str] | None = None,
    columns: DataFrame | None = None,
) -> DataFrame:
    """Source-side profile ``table_name, source_rows, source_columns`` (names upper-cased).

    Rows of a ``partitioned`` table are the sum of its partitions' counts, taken from file footers where
    the table is a Parquet folder (``footer_row_counts``); ``direct`` tables are
    counted whole. ``restrict_to`` (names, or a frame with ``table_name``) keeps only the listed
    partitioned tables; unlisted ones are not read. ``source_columns`` comes from ``columns``
    (``table_name, column_count``) or, by default, from the schemas of the listed tables; a table
    outside the list gets null.
    """
    direct = direct or {}
    allowed: set[str] | None = None
    if restrict_to is not None:
        if isinstance(restrict_to, DataFrame):
            # Table names only: metadata-sized, and it decides which tables are opened at all. (A list that
            # is joined to one table's partitions needs no collect: ``listed_source_rows``.)
            restrict_to = [r[0] for r in restrict_to.select("table_name").distinct().collect()]
        allowed = {str(n).upper() for n in restrict_to}

    def listed(name: str) -> bool:
        return allowed is None or name.upper() in allowed

    def whole(name: str, t: TableLike) -> DataFrame:
        counted = read_table(spark, t).agg(F.count(F.lit(1)).cast("bigint").alias("source_rows"))
        return counted.select(F.lit(name.upper()).alias("table_name"), "source_rows")

    opened = {n: t for n, t in partitioned.items() if listed(n)}
    rows, parts = [], []
    for name, t in opened.items():
        ref = None if isinstance(t, DataFrame) else as_ref(t)
        if ref is not None and ref.is_path and ref.format == "parquet":
            by_partition = footer_row_counts(spark, ref.location, name.upper())
            rows += [tuple(r) for r in by_partition.groupBy("table_name").agg(F.sum("rows").alias("n")).collect()]
        else:
            parts.append(whole(name, t))
    parts += [whole(name, t) for name, t in direct.items()]
    # One job counts the others; the result, one row a table, is kept as a local frame.
    rows += [tuple(r) for r in _measure(spark, parts)]
    if not rows:
        return local_frame(spark, [], SOURCE_PROFILE)
    measured = local_frame(spark, sorted(set(rows)), schema_of("table_name string, source_rows bigint"))

    if columns is None:
        counted = [(name.upper(), len(read_table(spark, t).columns)) for name, t in {**opened, **direct}.items() if listed(name)]
        columns = local_frame(spark, counted, schema_of("table_name string, column_count bigint"))
    else:
        columns = columns.select(F.upper("table_name").alias("table_name"), "column_count")
        if allowed is not None:
            columns = columns.where(F.col("table_name").isin(sorted(allowed)))
        columns = columns.groupBy("table_name").agg(F.sum("column_count").alias("column_count"))
    return measured.join(columns, "table_name", "left").select(
        "table_name", "source_rows", F.col("column_count").cast("bigint").alias("source_columns")
    )


# REC-8
def object_profile(
    spark: SparkSession,
    objects: Mapping[str, TableLike | Callable[[], DataFrame]],
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Row and column count per object, names upper-cased; unreadable objects are skipped.

    Returns ``(profile, skipped)`` where ``skipped`` lists ``(name, error)``. All readable objects
    are counted in one job; if that job fails, each object is counted on its own so that only the
    failing ones are skipped. The result has one row per object.
    """
    def resolve(item):
        name, src = item
        try:
            df = src() if callable(src) else read_table(spark, src)
            df.schema  # resolves the relation: a missing object fails here, without a data job
            return name, df, None
        except Exception as err:  # noqa: BLE001 - an unreadable object is reported, not fatal
            if not is_read_error(err):
                raise
            return name, None, error_text(err)

    # Objects resolve independently (each may list files or ask a database): side by side.
    with ThreadPoolExecutor(max_workers=max(1, min(RESOLVE_CONCURRENCY, len(objects)))) as pool:
        outcomes = list(pool.map(resolve, objects.items()))
    resolved = {name: df for name, df, err in outcomes if err is None}
    skipped: list[tuple[str, str]] = [(name, err) for name, _, err in outcomes if err is not None]

    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).cast("bigint").alias("source_rows")).select(
            F.lit(name.upper()).alias("table_name"),
            "source_rows",
            F.lit(len(df.columns)).cast("bigint").alias("source_columns"),
        )

    rows: list = []
    if resolved:
        try:
            rows = reduce(DataFrame.unionByName, [counted(n, d) for n, d in resolved.items()]).collect()
        except Exception as err:  # noqa: BLE001 - one object's rows cannot be read: each is counted by itself
            if not is_read_error(err):
                raise

            def alone(item):
                try:
                    return counted(*item).collect(), None
                except Exception as err:  # noqa: BLE001 - reported for this object
                    if not is_read_error(err):
                        raise
                    return [], (item[0], error_text(err))

            with ThreadPoolExecutor(max_workers=min(RESOLVE_CONCURRENCY, len(resolved))) as pool:
                for got, failed in pool.map(alone, resolved.items()):
                    rows.extend(got)
                    skipped.extend([failed] if failed else [])
    return local_frame(spark, [tuple(r) for r in rows], SOURCE_PROFILE), skipped
