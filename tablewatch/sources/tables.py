"""Table references: a catalog table name or a storage path, read and written the same way."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewatch.session import scratch_path
from tablewatch.sources import store

# Partition column of tables that are loaded run by run.
LOAD_RUN = "load_run"


@dataclass(frozen=True)
class TableRef:
    """Where a table lives. ``location`` is a catalog name (``db.table``) or a path (has ``/`` or ``:``).

    ``format`` is any Spark data source. With
    ``format="jdbc"`` the location is the database table (``dbtable``) and ``options`` carry the
    ``url`` and credentials: reads and appends go through Spark's JDBC source (appends in batches
    of ``batchsize`` rows per task, not row by row).
    """

    location: str
    format: str = "parquet"
    options: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def is_jdbc(self) -> bool:
        return self.format == "jdbc"

    @property
    def is_path(self) -> bool:
        return not self.is_jdbc and ("/" in self.location or ":" in self.location)


TableLike = TableRef | str | DataFrame


def as_ref(t: TableRef | str) -> TableRef:
    return t if isinstance(t, TableRef) else TableRef(t)


def read_table(spark: SparkSession, t: TableLike, schema: StructType | None = None) -> DataFrame:
    """The table as a DataFrame. A known ``schema`` spares a file table the schema-inference job."""
    if isinstance(t, DataFrame):
        return t
    ref = as_ref(t)
    if ref.is_jdbc:
        return spark.read.format("jdbc").options(**ref.options).option("dbtable", ref.location).load()
    if ref.is_path:
        reader = spark.read.format(ref.format).options(**ref.options)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(ref.location)
    return spark.read.table(ref.location)


def table_exists(spark: SparkSession, t: TableRef | str) -> bool:
    ref = as_ref(t)
    if not ref.is_path and not ref.is_jdbc:
        return spark.catalog.tableExists(ref.location)
    try:
        # Resolving the relation lists the files (or asks the database for the columns); no
        # data is read.
        read_table(spark, ref).schema
        return True
    except AnalysisException:
        return False
    except Exception as err:  # noqa: BLE001 - a JDBC table that is not there
        if ref.is_jdbc:
            return False
        raise err


def try_read_table(spark: SparkSession, t: TableRef | str, schema: StructType | None = None) -> DataFrame | None:
    """``read_table``, or ``None`` when the table does not exist (one lookup instead of two)."""
    ref = as_ref(t)
    if not ref.is_path and not ref.is_jdbc:
        return spark.read.table(ref.location) if spark.catalog.tableExists(ref.location) else None
    try:
        df = read_table(spark, ref, schema)
        df.schema
        return df
    except AnalysisException:
        return None
    except Exception:  # noqa: BLE001 - a JDBC table that is not there
        if ref.is_jdbc:
            return None
        raise


def write_table(
    df: DataFrame,
    t: TableRef | str,
    mode: str = "append",
    partition_by: list[str] | None = None,
) -> None:
    """Append ``df`` to a table or make it the table's content.

    An overwrite is staged: the rows are written in full beside the target first, so a job that
    fails leaves the rows that were there. A path target then gets the new version by rename. An
    existing catalog table gets it by ``INSERT OVERWRITE`` (columns by name), which keeps its
    definition: partitioning, comments, properties. ``df`` may read the target.
    """
    ref = as_ref(t)
    spark = df.sparkSession
    w = df.write.mode(mode).format(ref.format).options(**ref.options)
    if ref.is_jdbc:
        if mode == "overwrite" and "truncate" not in ref.options:
            # Truncate-then-load: keep the table's definition, indexes and grants.
            w = w.option("truncate", "true")
        w.option("dbtable", ref.location).save()
        return
    if partition_by:
        w = w.partitionBy(*partition_by)
    if ref.is_path:
        store.restore_folder(spark, ref.location)
        if mode != "overwrite":
            w.save(ref.location)
            return
        staged = store.staging_name(ref.location)
        try:
            w.save(staged)
            store.publish_folder(spark, staged, ref.location)
        finally:
            store.delete(spark, staged)  # there only if a step failed
    elif mode == "overwrite" and spark.catalog.tableExists(ref.location):
        staged = scratch_path(spark, "staged-overwrite")
        try:
            df.write.parquet(staged)
            _insert_overwrite(spark.read.schema(df.schema).parquet(staged), ref.location)
        finally:
            store.delete(spark, staged)
    else:
        w.saveAsTable(ref.location)


def append_rows(df: DataFrame, t: TableRef | str) -> None:
    """Append a small batch to a log that several writers append to at once.

    Spark jobs that append to one folder at the same time share its temporary folder, which the first to
    finish removes. So a path gets its files from a private folder, by rename."""
    ref = as_ref(t)
    if not ref.is_path:
        write_table(df, ref, "append")
        return
    staged = store.staging_name(ref.location)
    try:
        df.write.format(ref.format).options(**ref.options).save(staged)
        store.move_files(df.sparkSession, staged, ref.location)
    finally:
        store.delete(df.sparkSession, staged)


def quoted(name: str) -> str:
    """A qualified table name with each part quoted."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))


def _insert_overwrite(df: DataFrame, table: str, partition: tuple[str, str] | None = None) -> None:
    """Replace a catalog table's rows, or those of one partition, by ``df`` (columns by name)."""
    view = f"tablewatch_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    value = "" if partition is None else partition[1].replace("\\", "\\\\").replace("'", "\\'")
    where = "" if partition is None else f" PARTITION (`{partition[0]}` = '{value}')"
    try:
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {quoted(table)}{where} BY NAME SELECT * FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def write_runs(df: DataFrame, t: TableRef | str, runs: list[str], run_column: str = LOAD_RUN) -> None:
    """Write the rows of the named runs, each into its own partition of the target, in place of what that
    partition held: a step that is repeated after a failure adds nothing.

    ``df`` has ``run_column`` (string); a run without rows leaves its partition alone. The target
    is created when absent; one that exists must be partitioned by ``run_column``."""
    ref = as_ref(t)
    spark = df.sparkSession
    if ref.is_jdbc:
        raise ValueError("a database table has no run partitions: append to it instead")
    columns = [c for c in df.columns if c != run_column]
    df = df.where(F.col(run_column).isin(runs)).select(*columns, run_column)
    if ref.is_path:
        store.restore_folder(spark, ref.location)
        if store.exists(spark, ref.location) and not has_runs(spark, ref, run_column) and _holds_rows(spark, ref.location):
            raise ValueError(f"{ref.location} is not partitioned by {run_column}")
        w = df.write.mode("overwrite").format(ref.format).options(**ref.options)
        w.option("partitionOverwriteMode", "dynamic").partitionBy(run_column).save(ref.location)
    elif not spark.catalog.tableExists(ref.location):
        df.write.format(ref.format).options(**ref.options).partitionBy(run_column).saveAsTable(ref.location)
    elif not has_runs(spark, ref, run_column):
        raise ValueError(f"{ref.location} is not partitioned by {run_column}")
    else:
        for run in runs:
            _insert_overwrite(df.where(F.col(run_column) == run).drop(run_column), ref.location, (run_column, run))


def drop_run(spark: SparkSession, t: TableRef | str, run: str, run_column: str = LOAD_RUN) -> None:
    """Take a run's partition back."""
    ref = as_ref(t)
    if ref.is_path:
        store.delete(spark, f"{ref.location.rstrip('/')}/{run_column}={run}")
    else:
        spark.sql(f"ALTER TABLE {quoted(ref.location)} DROP IF EXISTS PARTITION (`{run_column}` = '{run}')")


def _holds_rows(spark: SparkSession, folder: str) -> bool:
    return any(not n.startswith(("_", ".")) for n in store.children(spark, folder))


def has_runs(spark: SparkSession, t: TableRef | str, run_column: str = LOAD_RUN) -> bool:
    """Whether a table is partitioned by its load run."""
    ref = as_ref(t)
    if ref.is_jdbc:
        return False
    if ref.is_path:
        return any(n.startswith(f"{run_column}=") for n in store.children(spark, ref.location))
    if not spark.catalog.tableExists(ref.location):
        return False
    return any(c.name == run_column and c.isPartition for c in spark.catalog.listColumns(ref.location))


def database_tables(
    spark: SparkSession,
    database: str,
    *,
    include_views: bool = False,
) -> dict[str, str]:
    """``{table name: qualified name}`` of a catalog database, the Spark counterpart of listing a
    schema's base tables (views left out unless ``include_views``)."""
    out = {}
    for t in spark.catalog.listTables(database):
        if t.isTemporary or (t.tableType == "VIEW" and not include_views):
            continue
        out[t.name] = f"{database}.{t.name}"
    return out


def tables_in(spark: SparkSession, *databases: str, include_views: bool = False) -> dict[tuple[str, str, str], str]:
    """Base tables of several catalog databases keyed ``(catalog, database, table)`` -- the input
    of one ``table_profile`` / ``column_profiles`` call that measures them all in one job."""
    catalog = spark.catalog.currentCatalog()
    return {
        (catalog, db, name): qualified
        for db in databases
        for name, qualified in database_tables(spark, db, include_views=include_views).items()
    }
