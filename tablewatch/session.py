"""Session settings and the shared working folder.

Staged files, rejected records and checkpoints go under the folder the cluster names in
``spark.checkpoint.dir`` (a shared file system on a cluster). Only when it is unset -- a local test
session -- is a fresh local folder made and registered.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException, UnknownException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings a job here relies on; all are standard Spark knobs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # A long-lived driver running many small jobs keeps only recent status history.
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "20000",
}


def build_session(app: str = "tablewatch", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local-mode session (tests) with none set gets a
    fresh local folder; a cluster session without one is an error."""
    sc = getattr(spark, "sparkContext", None)
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir().rstrip("/")
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
    if not master.startswith("local"):
        # A machine-local folder is invisible to executors on other hosts.
        raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared file system")
    local = tempfile.mkdtemp(prefix="tablewatch-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir().rstrip("/")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the shared folder (not created until written)."""
    return f"{shared_dir(spark)}/tablewatch/{name}-{uuid.uuid4().hex[:12]}"


def error_text(err: BaseException) -> str:
    """An error's whole text for a record; its type if it has none."""
    return str(err) or type(err).__name__


def is_read_error(err: BaseException) -> bool:
    """Whether an error lies in one table (missing, unreadable, a bad value), so that other tables may go on
    without it. Spark names such errors by a condition; a job that the cluster broke off has none."""
    if isinstance(err, Py4JJavaError):
        condition = getattr(err.java_exception, "getCondition", None)
        return bool(condition and condition())
    if isinstance(err, PySparkException):
        return not isinstance(err, UnknownException) and bool(err.getCondition())
    return isinstance(err, (KeyError, ValueError, OSError))


_STORED: weakref.WeakSet = weakref.WeakSet()  # DataFrames this library has already checkpointed


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` (eagerly, to the shared checkpoint folder) unless this library already did.

    Used where rows must be computed once and then stay fixed -- rows numbered after a
    nondeterministic partitioning, or small expensive results several steps read -- so that a
    lost executor does not make Spark recompute them differently or rescan their sources.
    """
    if df in _STORED:
        return df
    shared_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    _STORED.add(stored)
    return stored


def local_frame(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """Driver-held rows (profile results, job-status records, offsets) as a local relation.

    Built through an Arrow table, so the plan holds the rows themselves (``LocalRelation``):
    the planner knows their size (a join with them is broadcast from the start), ``isLocal()``
    is true, and no RDD has to be shipped. Falls back to the row-by-row path if Arrow is
    unavailable.
    """
    try:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow_schema = to_arrow_schema(schema)
        columns = list(zip(*rows)) if rows else [() for _ in schema.fields]
        table = pa.Table.from_arrays(
            [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow_schema)], schema=arrow_schema
        )
        return spark.createDataFrame(table, schema)
    except Exception:  # noqa: BLE001 - same rows, ordinary path
        return spark.createDataFrame(rows, schema)
