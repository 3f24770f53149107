"""Consecutive ids in a given order, computed without gathering the rows in one task.

The rows are range-partitioned on the order keys plus a tiebreaker (so even a key shared by a
third of all rows is split across partitions), stored, and counted per partition; the counts --
one number per partition -- give each partition its starting offset, and ``row_number`` inside a
partition gives the rest. This is how a sequence (``nextval``) is assigned to a batch of any size.

``claim_ids`` hands out the ranges: a writer claims the next block of ids by creating a file that must not
exist yet, so that two writers, on one driver or on several, never share an id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tablewatch.session import local_frame, materialize
from tablewatch.sources import store

_PART, _TIE, _LOCAL, _OFFSET = "_tw_part", "_tw_tie", "_tw_local", "_tw_offset"
_OFFSETS = StructType([StructField(_PART, IntegerType(), True), StructField(_OFFSET, LongType(), True)])


def claim_ids(spark: SparkSession, folder: str, count: int, above: int = 0) -> int:
    """Claim ``count`` consecutive ids in the sequence kept in ``folder``; returns the id before the first.

    Claim k is a file named k that holds the block's last id. Whoever creates it owns the block; a
    writer that comes second sees it and tries k + 1. ``above``: an id the first block must pass (ids
    given before the sequence was kept). A claim that is never used leaves a gap, as a sequence does.
    """
    while True:
        claims = [n for n in store.children(spark, folder) if n.isdigit()]
        last = max(int(store.read_text(spark, f"{folder}/{claims[-1]}")) if claims else 0, above)
        if count <= 0:
            return last
        if store.create_once(spark, f"{folder}/{int(claims[-1]) + 1 if claims else 1:020d}", str(last + count)):
            return last


def consecutive_ids(
    df: DataFrame, order_by: list[Column], start_after: int | Callable[[int], int] = 0, id_column: str = "id"
) -> DataFrame:
    """``df`` plus ``id_column`` = ``start_after + 1, + 2, ...`` following ``order_by``.

    ``start_after`` may be a function of the number of rows, e.g. a claim of that many ids.
    Rows equal on ``order_by`` are numbered in an arbitrary but fixed order: the partitioned rows
    are checkpointed before counting, so the ids do not change if a task is re-run.
    """
    spark = df.sparkSession
    ranged = materialize(
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*order_by, F.col(_TIE))
        .withColumn(_PART, F.spark_partition_id())
    )
    sizes = sorted((r[0], r[1]) for r in ranged.groupBy(_PART).count().collect())  # one row per partition
    if callable(start_after):
        start_after = start_after(sum(n for _, n in sizes))
    offsets, running = [], int(start_after)
    for part, n in sizes:
        offsets.append((part, running))
        running += n
    if not offsets:
        return ranged.drop(_TIE, _PART).withColumn(id_column, F.lit(None).cast("bigint"))
    # Bounded by the number of partitions, not by the data: safe to broadcast.
    offset_df = F.broadcast(local_frame(spark, offsets, _OFFSETS))
    local = F.row_number().over(Window.partitionBy(_PART).orderBy(*order_by, F.col(_TIE)))
    numbered = ranged.withColumn(_LOCAL, local).join(offset_df, _PART)
    return numbered.withColumn(id_column, (F.col(_OFFSET) + F.col(_LOCAL)).cast("bigint")).drop(
        _TIE, _PART, _LOCAL, _OFFSET
    )
