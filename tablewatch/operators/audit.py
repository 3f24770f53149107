"""Daily ingest audit: how many rows each table received the day before ``as_of``, as job-status rows.

All audited tables become one plan (a union of per-table aggregates), so the whole audit is one
Spark job. Each branch filters on the date column -- the filter reaches the scan as a range on the
raw column, so Parquet row groups and date partitions outside the day are skipped -- and counts with
a partial (map-side) aggregate, so a table of any size ships a handful of rows to the final count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablewatch.functions.time import AsOf, as_of_ts, previous_day
from tablewatch.operators.sequence import claim_ids, consecutive_ids
from tablewatch.schemas import JOB_STATUS, JOB_STATUS_COLUMNS, schema_of
from tablewatch.session import local_frame
from tablewatch.sources import store
from tablewatch.sources.tables import TableLike, TableRef, append_rows, as_ref, read_table, try_read_table

# Fixed values of the job-status rows written by the audit.
DEFAULT_STATUS = "SUCCESS"
DEFAULT_TASK_PREFIX = "task_"
DEFAULT_FAILURE_REASON = "NULL"  # the word, not a null


def _resolve_column(df: DataFrame, name: str) -> str:
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise ValueError(f"column {name!r} not in {df.columns}")


# AUD-1
def daily_ingest_counts(
    df: DataFrame,
    table_name: str,
    date_column: str,
    as_of: AsOf,
    *,
    include_empty: bool = False,
    date_format: str | None = None,
) -> DataFrame:
    """Rows of ``df`` whose ``date_column`` falls on the day before ``as_of``.

    Columns ``table_name, ingest_date, ingested_rows``. A table with no such rows yields **no row**
    (a grouped count); ``include_empty=True`` yields a row with 0 instead. A text date column is
    parsed with ``date_format`` (Spark datetime pattern) when given; a ``timestamp`` column is
    cut to its date in the session time zone.
    """
    col = _resolve_column(df, date_column)
    day = previous_day(as_of)
    d = F.to_date(F.col(col), date_format) if date_format else F.to_date(F.col(col))
    hits = df.where(d == day)
    if include_empty:
        counted = hits.agg(F.count(F.lit(1)).alias("ingested_rows")).select(day.alias("ingest_date"), "*")
    else:
        counted = hits.groupBy(d.alias("ingest_date")).agg(F.count(F.lit(1)).alias("ingested_rows"))
    return counted.select(F.lit(table_name).alias("table_name"), "ingest_date", "ingested_rows")


# AUD-2
def to_job_status(
    counts: DataFrame,
    *,
    schema_name: str,
    job_type: str,
    dag_id: str,
    as_of: AsOf,
    status: str = DEFAULT_STATUS,
    task_prefix: str = DEFAULT_TASK_PREFIX,
    failure_reason: str | None = DEFAULT_FAILURE_REASON,
) -> DataFrame:
    """Job-status rows (without ``job_id``) from ``daily_ingest_counts`` output.

    Start and end time are both ``as_of``; ``recs_inserted`` is the day's count, the other counters
    are 0; ``task_id`` is ``task_prefix + table_name``; ``dag_run_exec_date`` is the counted day.
    """
    ts = as_of_ts(as_of)
    zero = F.lit(0).cast("bigint")
    return counts.select(
        ts.alias("job_start_ts"),
        ts.alias("job_end_ts"),
        F.lit(schema_name).alias("schema_name"),
        F.col("table_name"),
        F.concat(F.lit(task_prefix), F.col("table_name")).alias("task_id"),
        F.lit(job_type).alias("job_type"),
        F.lit(dag_id).alias("dag_id"),
        F.col("ingest_date").alias("dag_run_exec_date"),
        F.lit(status).alias("job_status"),
        zero.alias("recs_parsed"),
        zero.alias("recs_staged"),
        F.col("ingested_rows").cast("bigint").alias("recs_inserted"),
        zero.alias("recs_updated"),
        zero.alias("recs_deleted"),
        F.lit(failure_reason).cast("string").alias("failure_reason"),
    )


# AUD-3
def with_job_ids(rows: DataFrame, start_after: int | DataFrame | Callable[[int], int] = 0) -> DataFrame:
    """Give each row the next id: ``start_after + 1, +2, ...`` in (run date, table, task) order.

    ``start_after`` is a number, the existing log (its ``max(job_id)`` is used) or a function of the
    number of rows that claims as many ids (``claim_ids``, safe with several writers). Rows that
    the driver holds are numbered where they are, others with ``consecutive_ids``, which gathers
    no batch in one task; both give the same ids.
    """
    if isinstance(start_after, DataFrame):
        start_after = highest_id(start_after)
    keys = ["dag_run_exec_date", "table_name", "task_id"]
    on_driver = rows.isLocal()  # asked before any projection, which would hide the local rows
    rows = rows.drop("job_id") if "job_id" in rows.columns else rows
    if on_driver:
        # Rows already held by the driver (e.g. one record of a load): number them where they are.
        local = sorted(rows.collect(), key=lambda r: tuple((r[k] is not None, r[k]) for k in keys))
        first = start_after(len(local)) if callable(start_after) else int(start_after)
        spark = rows.sparkSession
        schema = StructType([StructField("job_id", LongType(), True), *rows.schema.fields])
        numbered = local_frame(spark, [(first + i, *r) for i, r in enumerate(local, start=1)], schema)
        return numbered.select(*JOB_STATUS_COLUMNS)
    order = [F.col(k).asc_nulls_first() for k in keys]
    numbered = consecutive_ids(rows, order, start_after, "job_id")
    return numbered.select(*JOB_STATUS_COLUMNS)


def highest_id(log: DataFrame) -> int:
    """The log's highest id (one scalar; reads only the job_id column)."""
    return int(log.agg(F.coalesce(F.max("job_id"), F.lit(0))).first()[0])


def ids_folder(spark: SparkSession, log: TableRef | str) -> str:
    """Where the id claims of a log are kept: beside a path, in the warehouse folder for a table."""
    ref = as_ref(log)
    base = ref.location.rstrip("/") if ref.is_path else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{ref.location}"
    return f"{base}__ids"


def append_job_status(rows: DataFrame, log: TableRef | str) -> DataFrame:
    """Append job-status rows to ``log`` with fresh ids, in one write; returns the rows written.

    The ids are a block claimed for this batch, so batches that several writers append at once never share
    one; a log that had rows before its ids were claimed goes on above its highest.
    """
    spark = rows.sparkSession
    log = as_ref(log)
    folder = ids_folder(spark, log)
    above = 0
    if not store.children(spark, folder):
        existing = try_read_table(spark, log, JOB_STATUS)  # fixed schema: no inference job
        above = highest_id(existing) if existing is not None else 0
    batch = with_job_ids(rows, lambda n: claim_ids(spark, folder, n, above))
    append_rows(batch, log)
    return batch


# AUD-4
def config_pairs(config: DataFrame | list[tuple[str, str]]) -> list[tuple[str, str]]:
    """``(OBJECT_NAME, DATE_COLUMN)`` pairs of the audit config (a few rows, collected: they shape
    the plan)."""
    if isinstance(config, DataFrame):
        name_col = _resolve_column(config, "OBJECT_NAME")
        date_col = _resolve_column(config, "DATE_COLUMN")
        return [(r[0], r[1]) for r in config.select(name_col, date_col).collect()]
    return list(config)


def table_resolver(
    spark: SparkSession, tables: Mapping[str, TableLike] | Callable[[str], TableLike]
) -> Callable[[str], DataFrame]:
    """Object name -> DataFrame: a mapping (exact name, then case-insensitive) or a function."""

    def resolve(name: str) -> DataFrame:
        if callable(tables):
            return read_table(spark, tables(name))
        if name in tables:
            return read_table(spark, tables[name])
        for k, v in tables.items():
            if k.lower() == name.lower():
                return read_table(spark, v)
        raise KeyError(f"no table for audit object {name!r}")

    return resolve


def audit_all(
    spark: SparkSession,
    config: DataFrame | list[tuple[str, str]],
    tables: Mapping[str, TableLike] | Callable[[str], TableLike],
    as_of: AsOf,
    *,
    include_empty: bool = False,
) -> DataFrame:
    """``daily_ingest_counts`` for every ``(OBJECT_NAME, DATE_COLUMN)`` of ``config``, as one frame.

    ``config`` is the pipe-separated config read with ``read_delimited_config`` or a list of pairs.
    ``tables`` resolves an object name to a table (see ``table_resolver``). All tables are counted
    in one job; an unreadable table fails it (``plans.run_daily_audit`` isolates such tables).
    """
    resolve = table_resolver(spark, tables)
    parts = [
        daily_ingest_counts(resolve(n), n, c, as_of, include_empty=include_empty)
        for n, c in config_pairs(config)
    ]
    if not parts:
        return local_frame(spark, [], schema_of("table_name string, ingest_date date, ingested_rows bigint"))
    return reduce(DataFrame.unionByName, parts)
