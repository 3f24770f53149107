"""Exact top-k by inner product with two cover trees, one over queries and one over candidates.

Queries and candidates are dealt into blocks; a task takes a pair of blocks, builds a cover tree over
each (``CoverTree``) and walks the trees together. A pair of nodes is dropped when the largest inner
product its members can have -- by the product of the centres, their norms and the nodes' covering
radii -- lies below the worst kth score that any query of the query node has so far. What is left at
the leaves is multiplied out. A first pass over the candidates with the largest norms gives each query
k real scores to start from. Each task returns k rows per query; the best k of these are the result.

Vectors are integers, so scores are exact. Queries and candidates grow together, so neither is
broadcast: blocks of ``BLOCK_ROWS`` meet pairwise, as rows of a shuffle.

Defined results: vectors that are null, empty, of another length than the query's, or hold null or
non-finite components take no part. A null id takes no part. Ids that repeat are candidates of their
own (a query's own row is left out by id, so all rows with its id are); equal query rows are asked
once, other vectors with the same id are queries of their own. Ties go to the smaller id. Queries with fewer than k candidates return all of them, with none no row.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import stored

BLOCK_ROWS = 8192
LEAF = 64
EXPANSION = 1.25  # a child covers with the radius of its parent divided by this
SLICE = 512  # query rows multiplied with a node's members at a time
_NONE = -(1 << 62)  # below every score


class CoverTree:
    """Nested covers: a node's centre is a member; its children's centres are members more than
    ``radius / EXPANSION`` apart, and each member lies within that of its child's centre. ``radius`` is
    then shrunk to the largest distance that occurs. Where members lie so evenly that a cover would be
    an eighth of them or more (random directions in many dimensions), the node stays a leaf."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.root = self._node(np.arange(len(points)), 0) if len(points) else None

    def _node(self, members: np.ndarray, centre: int) -> tuple:
        """(centre, radius, members, children); ``centre`` is a place in ``members``."""
        at = self.points[members[centre]]
        apart = np.sqrt(((self.points[members] - at) ** 2).sum(axis=1))
        radius = float(apart.max())
        if len(members) <= LEAF or radius == 0.0:
            return members[centre], radius, members, ()
        nearest, owner, centres = apart, np.zeros(len(members), np.int64), [centre]
        while nearest.max() > radius / EXPANSION and len(centres) <= len(members) // 8:
            far = int(nearest.argmax())  # the member no centre covers that is farthest off
            distance = np.sqrt(((self.points[members] - self.points[members[far]]) ** 2).sum(axis=1))
            closer = distance < nearest
            nearest, owner = np.where(closer, distance, nearest), np.where(closer, len(centres), owner)
            centres.append(far)
        if len(centres) > len(members) // 8:
            return members[centre], radius, members, ()
        children = []
        for k, c in enumerate(centres):
            own = np.flatnonzero(owner == k)
            children.append(self._node(members[own], int(np.searchsorted(own, c))))
        return members[centre], radius, members, tuple(children)


class DualTreeSearch:
    """Best k candidates of each query, with ``worst`` the kth score so far."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int):
        self.q, self.c, self.qid, self.cid, self.k = queries, points, query_ids, ids, k
        self.qn, self.cn = (np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) for x in (queries, points))
        self.score = np.full((len(queries), k), _NONE)
        self.floor = np.full(len(queries), _NONE)  # scores that k candidates are known to reach
        self.best = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.pairs = self.pruned = 0

    def run(self) -> None:
        q, c = CoverTree(self.q), CoverTree(self.c)
        if q.root is None or c.root is None:
            return
        strong = np.argsort(-self.cn, kind="stable")[: max(LEAF, 4 * self.k)]
        if len(strong) >= self.k:
            for i in range(0, len(self.q), SLICE):
                rows = np.arange(i, min(i + SLICE, len(self.q)))
                self.floor[rows] = np.sort(self._scores(rows, strong), axis=1)[:, -self.k]
        self._walk(q.root, c.root)

    def _worst(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[rows, -1], self.floor[rows])

    def _scores(self, rows: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Products of whole numbers are exact as floats, where they are fast, while sums stay below 2**53."""
        q, c = self.q[rows], self.c[members]
        exact = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2**53
        scores = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64) if exact else q @ c.T
        return np.where(self.qid[rows][:, None] == self.cid[members][None, :], _NONE, scores)

    def _bound(self, a: tuple, b: tuple) -> float:
        inner = float(self.q[a[0]].astype(np.float64) @ self.c[b[0]].astype(np.float64))
        return inner + a[1] * self.cn[b[0]] + b[1] * self.qn[a[0]] + a[1] * b[1]

    def _walk(self, a: tuple, b: tuple) -> None:
        # Bounds are floats: a margin keeps rounding from dropping a tie.
        bound = self._bound(a, b)
        if bound + 1e-9 * (abs(bound) + 1) + 1e-6 < self._worst(a[2]).min():
            self.pruned += 1
            return
        if not a[3] and not b[3]:
            return self._multiply(a[2], b[2])
        if a[3] and (not b[3] or a[1] >= b[1]):
            for child in a[3]:
                self._walk(child, b)
        else:
            for child in sorted(b[3], key=lambda x: -self._bound(a, x)):  # likely winners first
                self._walk(a, child)

    def _multiply(self, rows: np.ndarray, members: np.ndarray) -> None:
        self.pairs += 1
        for start in range(0, len(rows), SLICE):
            part = rows[start : start + SLICE]
            scores = self._scores(part, members)
            good = (scores >= self._worst(part)[:, None]) & (scores != _NONE)
            for i in np.flatnonzero(good.any(axis=1)):
                r, keep = part[i], np.flatnonzero(good[i])
                s = np.concatenate([self.score[r], scores[i][keep]])
                v = np.concatenate([self.best[r], self.cid[members[keep]]])
                order = np.lexsort((v, -s))[: self.k]
                self.score[r], self.best[r] = s[order], v[order]


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as long; null where one is null or not finite."""
    x = vector.cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & (F.size(x) > 0)
    return F.when(usable, F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v).cast("long")))


def top_k(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of every row for which ``is_query`` holds, against all rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col), scale).alias("v"), is_query.alias("q"))
    rows = stored(rows.where("id is not null and v is not null"), "vectors")
    counts = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1))).first()
    blocks, query_blocks = (max(1, -(-n // BLOCK_ROWS)) for n in counts)
    # Small inputs still get enough pairs of blocks to keep the cluster busy.
    blocks = max(blocks, min(rows.sparkSession.sparkContext.defaultParallelism, counts[0] // 1024 + 1))
    place = F.xxhash64("id", "v")
    queries = rows.where("q").select("id", "v").distinct().select(
        F.lit(0).alias("side"), "id", "v", F.pmod(place, F.lit(query_blocks)).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb")
    )
    points = rows.select(
        F.lit(1).alias("side"), "id", "v", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), F.pmod(place, F.lit(blocks)).cast("int").alias("cb")
    )
    met = queries.unionByName(points).repartition(blocks * query_blocks, "qb", "cb").sortWithinPartitions("qb", "cb", "side")
    found = met.select("qb", "cb", "side", "id", "v").mapInArrow(_search(k), "query_id long, query_key long, vec_id long, score long")
    ranked = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (p for b in batches for p in _runs(b))
        for _, group in itertools.groupby(pieces, key=lambda p: p[0]):
            sides: tuple[list, list] = ([], [])
            for _, b in group:
                side = b.column(2).to_numpy()
                for which in (0, 1):
                    part = b.filter(pa.array(side == which))
                    if part.num_rows:
                        sides[which].append((part.column(3).to_numpy(), part.column(4)))
            yield from _best(sides, k)

    return run


def _runs(b: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """A batch cut where (qb, cb) changes."""
    qb, cb = b.column(0).to_numpy(), b.column(1).to_numpy()
    cuts = np.flatnonzero((np.diff(qb) != 0) | (np.diff(cb) != 0)) + 1
    for lo, hi in itertools.pairwise([0, *cuts.tolist(), b.num_rows]):
        if hi > lo:
            yield (int(qb[lo]), int(cb[lo])), b.slice(lo, hi - lo)


def _best(sides: tuple[list, list], k: int) -> Iterator[pa.RecordBatch]:
    by_length: list[dict[int, list]] = [{}, {}]
    for which in (0, 1):
        for ids, lists in sides[which]:
            sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                by_length[which].setdefault(int(n), []).append((ids[at], flat[starts[at][:, None] + np.arange(n)]))
    for n, queries in by_length[0].items():
        if n in by_length[1]:
            qid, q = (np.concatenate(x) for x in zip(*queries))
            cid, c = (np.concatenate(x) for x in zip(*by_length[1][n]))
            search = DualTreeSearch(q, qid, c, cid, k)
            search.run()
            real = search.best != np.iinfo(np.int64).max
            row, _ = np.nonzero(real)
            key = np.array([zlib.crc32(x.tobytes()) for x in q], np.int64)  # tells vectors that share an id apart
            yield pa.record_batch({"query_id": qid[row], "query_key": key[row], "vec_id": search.best[real], "score": search.score[real]})
