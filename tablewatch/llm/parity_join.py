"""N-gram Jaccard self-join by parity sketches: exact links, and the groups they form.

A document's set is its distinct word shingles as 64-bit hashes. A sketch of k words is
made by XOR: each shingle flips one bit, whose word and place its hash names. Two sketches differ in
at most as many bits as the sets differ in shingles, so a limit ``d`` on the symmetric difference is
a limit on the Hamming distance, and of ``d + 1`` words one must be equal (pigeonhole).

A word that few shingles fall into has few values if it is 64 bits wide, and unrelated documents would
meet in it by chance, in numbers that grow with their square. So the words that candidates are joined
on are 2**32 bits wide. They are nearly empty; a word is held as the XOR of a hash of each set
bit, which is equal where the words are. Verification compares 64-bit words bit by bit.

- **Size bands.** Two sets at the threshold differ little in size, so sizes are cut into bands
  (ratio ``BAND``); a band's largest pair gives its ``d`` and so its k. A document joins in its own
  band and in a lower one that a smaller partner could have.
- **Spare words.** A band has ``spare`` words more than ``d + 1``, so a linked pair has at least
  ``spare + 1`` equal words. That makes words safe to leave out: a document leaves out its *light*
  words (few shingles fell into them; empty ones would make one huge bucket) and its words in
  *crowded* buckets (a passage that many documents share), unless these together are more than
  ``spare``. If a pair's equal words are all left out, both sides have more than ``spare`` of them,
  so both keep them: no pair is lost.
- **Candidates.** In buckets of up to ``CROWD`` members pairs are counted; a pair stays if it meets in
  more buckets than the larger of its two rooms (``spare`` less the words left out), which every
  linked pair does. Crowded buckets link each remaining member with the smallest, a star. Either way
  the rows are linear in the members. The components of these links are the *clusters*: every
  link of the join lies within one.
- **Verification.** A cluster is cut into blocks, block pairs go to tasks, and a task compares the
  sketches of its block pair (Hamming limit), then the shingle sets of pairs that pass and are not
  yet joined. It returns a spanning forest of the true links, never all pairs of a group.
- Equal sets are one vertex from the start; groups of copies cost one vertex.

Defined results: words are taken from the text with A-Z lower-cased. Fewer words than ``n``: the
whole sequence is one shingle. Null, empty or blank texts have an empty set, link with nothing and
are their own component. Rows that repeat an id each follow their own text. A null id takes part with
its text but never names a component: its component is the smallest id it reaches (null if none).
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import ASCII_BLANKS, discard, free_name, slices, stored
from tablewatch.llm.components import components

BAND = 1.25  # ratio of a band's end to its start
BLOCK_DOCS, BLOCK_SHINGLES = 8192, 4_000_000  # a block holds at most about so many documents, shingles
CROWD = 6  # buckets with more members are crowded
CACHED_WORDS = 400_000
_BLANKS = str.maketrans(ASCII_BLANKS + "ABCDEFGHIJKLMNOPQRSTUVWXYZ", " " * 6 + "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Band:
    start: int
    end: int  # sizes start <= n < end for the smaller set of a pair
    partner: int  # largest size of the other one
    words: int  # k
    spare: int
    light: int  # a word with at most so many shingles is light


def limit(a: int, b: int, percent: int) -> int:
    """Largest symmetric difference of two linked sets of these sizes."""
    return (a + b) * (100 - percent) // (100 + percent)


@functools.cache
def bands(percent: int, longest: int = 1 << 31) -> list[Band]:
    found, start = [], 1
    while start < longest:
        end = max(start + 1, int(start * BAND))
        partner = (end - 1) * 100 // percent
        need = limit(end - 1, partner, percent) + 1
        light, spare = _spare(start, need)
        found.append(Band(start, end, partner, need + spare if need > 1 else 1, spare, light))
        start = end
    return found


def _spare(start: int, need: int) -> tuple[int, int]:
    """How many shingles a light word has at most -- none: a wide word with one is rare enough -- and how many
    words a band spares: a tenth of the others for counting, and the light words to expect (two
    deviations more) in sets at its start. Any choice is exact."""
    most = 1 + need // 3
    spare, wanted = 0, 1
    while spare < wanted <= most:
        spare = wanted
        words = need + spare
        p = math.exp(-start / words)
        wanted = 1 + math.ceil(need / 10 + words * p + 2 * math.sqrt(words * p * (1 - p)))
    return 0, spare if wanted <= spare else most


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text."""

    def __init__(self, n: int, seed: int):
        self.n, self.seed, self.known = n, seed, {}
        self.factors = np.array([xxhash.xxh3_64_intdigest(f"place {i}", seed) | 1 for i in range(n)], np.uint64)

    def _word(self, w: str) -> int:
        h = self.known.get(w)
        if h is None:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            h = self.known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), self.seed)
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        words = [w for w in (text or "").translate(_BLANKS).split(" ") if w]
        if not words:
            return np.empty(0, np.uint64)
        h = np.array([self._word(w) for w in words], np.uint64)
        n = min(self.n, len(h))
        z = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            z = z * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i] * self.factors[i]
        return np.unique(_mix(z))


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def sketch(shingles: np.ndarray, words: int, wide: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(the sketch's words, how many shingles each got). Sorted hashes fall into words in order. ``wide``: words
    of 2**32 bits, each as the XOR of its set bits' hashes; else of 64 bits."""
    word = ((shingles >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    bit = _mix((shingles & np.uint64(0xFFFFFFFF)) + np.uint64(1)) if wide else np.uint64(1) << (shingles & np.uint64(63))
    count = np.bincount(word.astype(np.int64), minlength=words)
    out = np.zeros(words, np.uint64)
    full = np.flatnonzero(count)
    out[full] = np.bitwise_xor.reduceat(bit, np.concatenate([[0], np.cumsum(count)[:-1]])[full])
    return out, count


def bucket_keys(shingles: np.ndarray, plan: list[Band], starts: list[int]) -> list[tuple[int, int, np.ndarray]]:
    """The buckets of a document, for each band it joins in: (band, room, keys). Room: how many
    more words it may leave out (below 0: it left out none)."""
    n, found = len(shingles), []
    at = bisect.bisect_right(starts, n) - 1
    while at >= 0 and (plan[at].start <= n < plan[at].end or plan[at].partner >= n):
        band = plan[at]
        if band.words > 1:  # else linked sets of the band are equal, and one vertex
            parity, count = sketch(shingles, band.words, wide=True)
            heavy = count > band.light
            room = band.spare - int((~heavy).sum())
            shown = np.flatnonzero(heavy) if room >= 0 else np.arange(band.words)
            place = np.uint64(at << 32) + shown.astype(np.uint64)
            found.append((at, room, _mix(_mix(place + np.uint64(1)) + parity[shown])))
        at -= 1
    return found


def set_name(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed integers."""
    return struct.unpack("<qq", hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())


def shingle_table(docs: DataFrame, n: int, percent: int, seed: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_hi, set_lo, shown), stored. ``shown``: band, room and bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, plan = Shingler(n, seed), bands(percent)
        starts = [b.start for b in plan]
        for b in slices(batches):
            sizes, names, shown = [], [], []
            for text in b.column(1).to_pylist():
                s = shingler(text)
                sizes.append(len(s))
                names.append(set_name(s))
                shown.append(bucket_keys(s, plan, starts))
            name = np.array(names, np.int64).reshape(-1, 2)
            flat = [x for row in shown for x in row]
            keys = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *(len(x[2]) for x in flat)]), pa.int32()),
                pa.array(np.concatenate([np.empty(0, np.uint64), *(x[2] for x in flat)]).view(np.int64)),
            )
            entries = pa.StructArray.from_arrays(
                [pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], pa.int32()), keys], ["band", "room", "keys"]
            )
            yield pa.record_batch({
                "doc_id": b.column(0), "text_key": b.column(2), "n_shingles": pa.array(sizes, pa.int64()), "set_hi": name[:, 0], "set_lo": name[:, 1],
                "shown": pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, shown)]), pa.int32()), entries),
            })

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.xxhash64("text"))
    kind = "doc_id long, text_key long, n_shingles long, set_hi long, set_lo long, shown array<struct<band:int,room:int,keys:array<long>>>"
    return stored(rows.mapInArrow(run, kind), "shingles")


def shared_buckets(sets: DataFrame) -> DataFrame:
    """(key, a, band, room, size, followers), stored: the members of buckets with more than one, and in
    buckets that are not crowded the members after each. ``sets`` is discarded: it is large."""
    members = sets.select(F.col("set_hi").alias("a"), F.explode("shown").alias("s")).select(
        "a", "s.band", "s.room", F.explode("s.keys").alias("key")
    )
    in_order = Window.partitionBy("key").orderBy("a")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    once = members.withColumn("_before", F.lag("a").over(in_order)).where(~F.col("a").eqNullSafe(F.col("_before"))).drop("_before")
    followers = F.array(*[F.lead(F.struct("a", "room"), i).over(in_order) for i in range(1, CROWD)])
    size = F.count(F.lit(1)).over(whole)
    shared = once.withColumns({"size": size, "followers": followers}).where("size > 1")
    shared = shared.withColumn("followers", F.when(F.col("size") <= CROWD, F.filter("followers", lambda x: x.isNotNull())))
    shared = stored(shared, "buckets")
    discard(sets)
    return shared


def candidate_links(shared: DataFrame) -> DataFrame:
    """(band, a, b): links whose components, band by band, hold every linked pair; a, b: ``set_hi``."""
    in_order = Window.partitionBy("key").orderBy("a")
    crowded = shared.where(F.col("size") > CROWD).select("key", "a", "band", "room")
    left_out = crowded.groupBy("a", "band").agg(F.count(F.lit(1)).alias("_n"), F.first("room").alias("_room"))
    left_out = stored(left_out, "crowded")
    star = F.first("a").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stays = left_out.where("_n > _room").select("a", "band")
    stars = crowded.join(stays, ["a", "band"]).withColumn("b", star).where("a <> b").select("band", "a", "b")

    met = (
        shared.where(F.col("size") <= CROWD)
        .select("band", "a", "room", F.explode("followers").alias("f"))
        .groupBy("band", "a", F.col("f.a").alias("b"))
        .agg(F.count(F.lit(1)).alias("_met"), F.max("room").alias("_room_a"), F.max("f.room").alias("_room_b"))
    )

    def of(side: str) -> DataFrame:
        return left_out.select(F.col("a").alias(side), "band", F.col("_n").alias(f"_n_{side}"))

    room = [F.col(f"_room_{x}") - F.coalesce(F.col(f"_n_{x}"), F.lit(0)) for x in "ab"]
    pairs = met.join(of("a"), ["a", "band"], "left").join(of("b"), ["b", "band"], "left").where(F.col("_met") > F.greatest(*room))
    return stars.unionByName(pairs.select("band", "a", "b")).distinct()


def _verify(n: int, percent: int, seed: int):
    """mapInArrow function over rows (cluster, left, right, side, vertex, text), sorted by these:
    edges (a, b) of a spanning forest of the links in each block pair."""

    def links(rows: list[tuple], shingler: Shingler) -> Iterator[tuple[int, int]]:
        # Rows that repeat an id may bring a text that is another vertex's: the set's name tells.
        named = [(r[4], r[3], shingler(r[5])) for r in rows]
        kept = {v: (v, side, s) for v, side, s in named if set_name(s)[0] == v}
        if len(kept) < 2:
            return
        vertex, side, sets = zip(*sorted(kept.values(), key=lambda k: (len(k[2]), k[0])))
        side, sizes = np.array(side), np.array([len(s) for s in sets])
        words = max(8, limit(int(sizes[-1]), int(sizes[-1]), percent) + 1)
        parity = np.stack([sketch(s, words)[0] for s in sets])
        first = words // 4  # the distance of a part of the sketch is a bound too
        parent = list(range(len(sets)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        ends = np.searchsorted(sizes, sizes * 100 // percent, side="right")
        for i in range(len(sets)):
            others = np.arange(i + 1, ends[i])
            if rows[0][1] != rows[0][2]:
                others = others[side[others] != side[i]]
            for part in (slice(0, first), slice(0, words)):
                bound = (sizes[i] + sizes[others]) * (100 - percent) // (100 + percent)
                others = others[np.bitwise_count(parity[others, part] ^ parity[i, part]).sum(axis=1, dtype=np.int32) <= bound]
            for j in others.tolist():
                p, q = root(i), root(j)
                if p == q:
                    continue
                same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * same >= percent * (sizes[i] + sizes[j] - same):
                    parent[p] = q
                    yield vertex[i], vertex[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n, seed)
        rows = (r for b in slices(batches) for r in zip(*(c.to_pylist() for c in b.columns)))
        for _, group in itertools.groupby(rows, key=lambda r: r[:3]):
            found = list(links(list(group), shingler))
            if found:
                a, b = zip(*found)
                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def block_pairs(clusters: DataFrame) -> DataFrame:
    """(vertex, _id, cluster, left, right, side) of (vertex, _id, cluster, n_shingles): the block pairs
    each vertex belongs to. Clusters up to a block's size have the one pair (0, 0)."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"), F.max("n_shingles").alias("_longest"))
    room = F.greatest(F.lit(16), F.least(F.lit(BLOCK_DOCS), F.floor(F.lit(BLOCK_SHINGLES) / F.greatest(F.lit(1), "_longest"))))
    placed = (
        clusters.join(sizes.withColumn("_blocks", F.ceil(F.col("_n") / room).cast("int")), "cluster")
        .withColumn("_block", F.pmod(F.xxhash64("vertex"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    )
    return placed.select(
        "vertex", "_id", "cluster", F.least("_block", "_other").alias("left"), F.greatest("_block", "_other").alias("right"),
        (F.col("_block") > F.col("_other")).cast("int").alias("side"),
    )


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, seed: int = 0) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text). Two documents link
    when 100 * |A and B| >= percent * |A or B|."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    full = shingle_table(docs, n, percent, seed)
    sets = stored(full.drop("shown"), "set-names")
    # To fetch texts by: an id may be null, or many rows' own.
    row_key = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "text_key")
    # A vertex is the first half of a set's name. Should two sets ever share it, other hashes decide.
    names = sets.where("n_shingles > 0").groupBy("set_hi").agg(
        F.min("doc_id").alias("first_id"), F.min(row_key).alias("_id"), F.max("n_shingles").alias("n_shingles"),
        F.min("set_lo").alias("_lo"), F.max("set_lo").alias("_hi"),
    )
    names = stored(names, "sets")
    if not names.where("_lo <> _hi").isEmpty():
        return jaccard_components(docs, n, percent, seed + 1)

    shared = shared_buckets(full)
    links = stored(candidate_links(shared), "links")
    discard(shared)
    ends = [F.xxhash64("band", x).alias(y) for x, y in (("a", "a"), ("b", "b"))]
    ids = links.select("band", F.explode(F.array("a", "b")).alias("vertex")).distinct().withColumn("id", F.xxhash64("band", "vertex"))
    clusters = ids.join(components(links.select(*ends)), "id").select("vertex", F.col("component").alias("cluster"))
    inside = names.withColumnRenamed("set_hi", "vertex").join(clusters, "vertex")
    # Of each vertex in a cluster, one document's text is fetched.
    wanted = block_pairs(inside.select("vertex", "cluster", "n_shingles", "_id"))
    # Rows that share id and text are fetched once.
    texts = docs.select(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), F.xxhash64("text")).alias("_id"), "text")
    texts = texts.join(inside.select("_id").distinct(), "_id", "left_semi").groupBy("_id").agg(F.first("text").alias("text"))
    rows = wanted.join(texts, "_id").select("cluster", "left", "right", "side", "vertex", "text")
    links = (
        rows.repartition("cluster", "left", "right")
        .sortWithinPartitions("cluster", "left", "right", "side", "vertex")
        .mapInArrow(_verify(n, percent, seed), "a long, b long")
    )
    groups = components(links).withColumnsRenamed({"id": "set_hi", "component": "_group"})
    least = (
        names.join(groups, "set_hi", "left")
        .select("set_hi", "first_id", F.coalesce("_group", "set_hi").alias("_group"))
    )
    ids = least.groupBy("_group").agg(F.min("first_id").alias("component_id"))
    labelled = least.join(ids, "_group").select("set_hi", "component_id")
    return (
        sets.join(labelled, "set_hi", "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    )


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id; all columns are kept.
    Where ids repeat or are null, rows go by a hash of id and text instead, and equal rows are one."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or doc_id is null")
    key, rows = "doc_id", docs
    if not ids.isEmpty():
        key = free_name(docs, "_row_key")
        rows = docs.withColumn(key, F.xxhash64("doc_id", "text")).dropDuplicates([key])
    kept = jaccard_components(rows.select(F.col(key).alias("doc_id"), "text"), n, percent).select(F.col("component_id").alias("_kept")).distinct()
    return rows.join(kept, rows[key] == kept["_kept"], "left_semi").select(*docs.columns)
