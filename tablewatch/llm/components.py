"""Connected components of a graph given as an edge table, by alternating star contractions.

Each round rewires every vertex to the smallest neighbour it knows (first among its larger, then
among its smaller neighbours) with joins and minimum aggregates; a round's edges are written to the
shared folder, so the lineage stays short and nothing is gathered on the driver but one checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import stored


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component): for every vertex of ``edges`` (a, b: long) the smallest vertex it reaches."""
    now = stored(_ordered(edges), "cc-edges")
    mark = _mark(now)
    for _ in range(max_rounds):
        now = stored(_small_star(_large_star(now)), "cc-edges")
        after = _mark(now)
        if after == mark:
            break
        mark = after
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots).distinct()


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges with a > b."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex hands its larger neighbours on to the smallest of itself and its neighbours."""
    smallest = edges.groupBy(F.col("a").alias("_v")).agg(F.min("b").alias("_m"))
    # A vertex with larger neighbours only is their smallest already: those edges stay.
    return (
        edges.join(smallest, edges["b"] == smallest["_v"], "left")
        .select("a", F.coalesce("_m", "b").alias("b"))
        .unionByName(smallest.select(F.col("_v").alias("a"), F.col("_m").alias("b")))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex and its smaller neighbours are tied to the smallest of those."""
    smallest = edges.groupBy(F.col("a").alias("_v")).agg(F.min("b").alias("_m"))
    moved = edges.join(smallest, edges["a"] == smallest["_v"]).where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    kept = smallest.select(F.col("_v").alias("a"), F.col("_m").alias("b"))
    return moved.unionByName(kept).distinct()
