"""Removal of repeated byte strings by a column-wise multi-document Burrows-Wheeler construction.

Every byte covered by a ``LENGTH``-byte string that starts anywhere else too (any document, the same one
included) is removed. Texts are UTF-8 bytes; matches never cross documents, overlaps count.

1. **Dealing by content.** For each start the ``KMER``-byte string with the smallest hash within the
   next ``LENGTH`` bytes is its anchor: a function of those bytes alone, so equal strings have equal anchors at
   equal places. Starts with the same anchor are neighbours; they and the bytes after them are a
   *window*. Windows are paired by their anchor's hash: only those of one hash can share a string.
   What is shuffled is a few numbers per window (one for about 85 bytes).
2. **Equal windows** (same anchor, same bytes) repeat as a whole. Windows alone with their anchor
   repeat nothing. Both are settled without their bytes.
3. **The rest** -- of each kind of window one -- goes, with its bytes, to a task by anchor. There windows are
   first trimmed: a string reaches some bytes to the left and to the right of its anchor, and if no other window of
   the anchor has as many in common there, it is not repeated. Every string that is left holds its anchor
   whole, so the anchor's ``KMER`` bytes become ``CODE`` symbols that name them. The trimmed windows
   are the documents of a collection whose BWT and common prefixes are built column by column:
   round j inserts the j-th symbol from the end of each window, its place found by counting symbols in
   the BWT so far, its common prefixes by the smallest entries between neighbours. Both columns are
   read from and written to a sequential file each round (in memory below ``SPOOL_BYTES``). A start
   whose suffix has ``LENGTH`` bytes in common with a neighbour is repeated.
4. The removed intervals go to their documents, which are cut.

An anchor with more than ``CROWD`` kinds of windows would make a collection too large for a task; its
windows are cut into single starts, dealt by the hash of their whole string: equal strings then are
equal windows (2). This is exact as well, and rows grow by the number of starts of those windows only.

Defined results: null and empty texts have 0 bytes and lose none (the digest is that of no bytes). Shorter
texts than ``LENGTH`` lose nothing. Equal rows repeat each other's every string. Null and repeated
ids are told apart by their text. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import stored

LENGTH, KMER = 200, 32
PIECE = (1 << 24) - 1  # longer texts are worked through in pieces; a place must fit into 24 bits
CROWD = 8192
GROUP_WINDOWS = 512  # small anchors' windows share a collection up to about this many
TRIM = 14  # bytes by which contexts are compared when windows are trimmed
SPOOL_BYTES = 32 << 20
CODE, CODE_SYMBOLS = 4, bytes(range(0xF8, 0xFF))  # an anchor's name: bytes that no UTF-8 text has
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.uint64(PIECE)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return z ^ (z >> np.uint64(33))


class Hashes:
    """Hashes of substrings from running sums: the same bytes have the same hash at any place."""

    def __init__(self, data: np.ndarray, powers: np.ndarray, inverse: np.ndarray):
        self.inverse = inverse
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_mix(data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, both modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def windows(data: np.ndarray, hashes: Hashes) -> tuple[np.ndarray, ...]:
    """(anchor hash, first start, number of starts, hash of the window's bytes, first start's distance
    to the anchor) of each window."""
    n = len(data)
    if n < LENGTH:
        return (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))
    at = np.arange(n - KMER + 1)
    h = hashes(at, at + KMER)
    least = (h & ~_PLACE) | at.astype(np.uint64)  # equal hashes: the first one
    width, want = 1, LENGTH - KMER + 1
    while width * 2 <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[: n - LENGTH + 1], least[want - width : want - width + n - LENGTH + 1])
    anchor = (least & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    count = np.diff(first, append=len(anchor))
    key = h[anchor[first]]
    ahead = anchor[first] - first
    body = hashes(first, first + count + (LENGTH - 1)) ^ _mix((ahead + (count << 16)).astype(np.uint64))
    return key, first, count, body, ahead


def trimmed(group: list[tuple[bytes, int]]) -> list[tuple[int, int]]:
    """For windows (bytes, place of the anchor) of one anchor: the range of starts that may be repeated."""
    left, right = _shared([d[a - 1 :: -1] if a else b"" for d, a in group]), _shared([d[a + KMER :] for d, a in group])
    out = []
    for (data, a), x, y in zip(group, left, right):
        # A start lies o bytes before the anchor (o <= x) and its string ends LENGTH - KMER - o bytes after it (<= y).
        low, high = max(0, a - x), min(len(data) - LENGTH, a - (LENGTH - KMER) + y)
        out.append((low, max(low, high + 1)))
    return out


def _shared(contexts: list[bytes]) -> list[int]:
    """For each context a length that its prefix shared with another one has at most."""
    most, open_ = [0] * len(contexts), range(len(contexts))
    for n in range(TRIM, LENGTH - KMER + TRIM, TRIM):
        heads: dict[bytes, int] = {}
        for i in open_:
            heads[contexts[i][:n]] = heads.get(contexts[i][:n], 0) + 1
        shared = []
        for i in open_:
            most[i] = n - 1  # what is shared may end just before
            # A context that ends earlier may go on as any other does.
            if len(contexts[i]) < n or heads[contexts[i][:n]] > 1:
                shared.append(i)
        open_ = shared
    for i in open_:
        most[i] = LENGTH
    return most


class _Column:
    """One column of the collection in a file that each round reads through and writes anew."""

    def __init__(self, values: np.ndarray):
        self.put(values)

    def put(self, values: np.ndarray) -> None:
        self.file = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)
        self.file.write(values.tobytes())
        self.file.seek(0)

    def get(self) -> np.ndarray:
        data = np.frombuffer(self.file.read(), np.uint8)
        self.file.close()
        return data


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Smallest of values[low : high + 1] for each pair, low <= high."""
    out, level, width = np.empty(len(low), np.uint8), values, 1
    span = high - low + 1
    while len(low):
        which = np.flatnonzero((span >= width) & (span < 2 * width))
        if len(which):
            out[which] = np.minimum(level[low[which]], level[high[which] - width + 1])
        if not (span >= 2 * width).any():
            break
        level, width = np.minimum(level[:-width], level[width:]), width * 2
    return out


def repeated_starts(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text the starts whose ``length`` bytes also start elsewhere in the collection."""
    m, sizes = len(texts), np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer(b"".join(texts), np.uint8) + np.uint8(1)  # UTF-8 has no byte 255; 0 is the end
    ends = np.cumsum(sizes)
    bwt = _Column(np.where(sizes > 0, flat[ends - 1] if len(flat) else 0, 0).astype(np.uint8))
    common = _Column(np.zeros(m, np.uint8))
    alive, place = np.flatnonzero(sizes > 0), np.flatnonzero(sizes > 0)  # place: of the suffix last inserted
    at_all = np.arange(m + int(sizes.sum()), dtype=np.int32)
    for j in range(1, int(sizes.max(initial=0)) + 1):
        b, lcp = bwt.get(), common.get()
        order = np.argsort(b, kind="stable")  # of bytes: a counting pass
        rank = np.empty(len(b), np.int32)
        rank[order] = at_all[: len(b)]
        done = len(b) - int(np.count_nonzero(b))
        k, symbol = rank[place].astype(np.int64), b[place]
        new = m + k - done  # all empty suffixes, then the suffixes in the order of their first symbols
        before, after = order[np.maximum(k - 1, 0)], order[np.minimum(k + 1, len(b) - 1)]
        has_before, has_after = (k > 0) & (b[before] == symbol), (k + 1 < len(b)) & (b[after] == symbol)
        size = len(b) + len(place)
        old = np.ones(size, bool)
        old[new] = False
        next_b, next_lcp = np.empty(size, np.uint8), np.empty(size, np.uint8)
        next_b[old], next_lcp[old] = b, lcp
        left = ends[alive] - j - 1
        next_b[new] = np.where(sizes[alive] > j, flat[np.maximum(left, 0)], 0)
        next_lcp[new] = 0
        low = np.concatenate([before[has_before] + 1, place[has_after] + 1])
        least = _least_between(lcp, low, np.concatenate([place[has_before], after[has_after]]))
        next_lcp[np.concatenate([new[has_before], new[has_after] + 1])] = np.minimum(least, length - 1) + 1
        bwt.put(next_b)
        common.put(next_lcp)
        alive, place = alive[sizes[alive] > j], new[sizes[alive] > j]
    b, lcp = bwt.get(), common.get()
    repeated = lcp >= length
    repeated[:-1] |= repeated[1:].copy() if len(repeated) else repeated[1:]
    rank = np.empty(len(b), np.int64)
    rank[np.argsort(b, kind="stable")] = np.arange(len(b))
    done, found = int((b == 0).sum()), [[] for _ in texts]
    at, place = np.arange(m), np.arange(m)
    for j in range(1, int(sizes.max(initial=0)) + 1):  # walk each text from its end
        place = m + rank[place[sizes[at] >= j]] - done
        at = at[sizes[at] >= j]
        if j >= length:
            for i in at[repeated[place]].tolist():
                found[i].append(int(sizes[i]) - j)
    return [np.array(f[::-1], np.int64) for f in found]


# --- Spark ---------------------------------------------------------------------------------------

_ROW = "doc_id long, text_key long, key long, first int, count int, body long, ahead int"


def _find_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers, inverse = powers_for(1 << 17)
    for b in batches:
        parts = []
        for row, text in enumerate(b.column(2).to_pylist()):
            data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
            for start in range(0, max(1, len(data) - LENGTH + 1), PIECE - LENGTH):
                piece = data[start : start + PIECE]
                if len(piece) > len(powers):
                    powers, inverse = powers_for(len(piece))
                key, first, count, body, ahead = windows(piece, Hashes(piece, powers, inverse))
                # Starts that the next piece has too are left to it.
                own = np.minimum(count, PIECE - LENGTH - first) if start + PIECE < len(data) else count
                keep = own > 0
                parts.append((np.full(keep.sum(), row), key[keep], first[keep] + start, own[keep], body[keep], ahead[keep]))
        row, key, first, count, body, ahead = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.int64)] * 6
        for lo in range(0, len(row), 100_000):
            at = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row[at])), b.column(1).take(pa.array(row[at])), pa.array(key[at].view(np.int64)),
                 pa.array(first[at].astype(np.int32)), pa.array(count[at].astype(np.int32)), pa.array(body[at].view(np.int64)), pa.array(ahead[at].astype(np.int32))],
                names=[x.split()[0] for x in _ROW.split(", ")],
            )


def _cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, key, first, count, ahead, single, bytes) of rows (doc_id, text_key, text, wanted)."""
    for b in batches:
        rows = []
        for doc_id, text_key, text, wanted in zip(*(c.to_pylist() for c in b.columns)):
            data = (text or "").encode("utf-8", "surrogatepass")
            for w in wanted:
                rows.append((doc_id, text_key, w["key"], w["first"], w["count"], w["ahead"], w["single"], data[w["first"] : w["first"] + w["count"] + LENGTH - 1]))
        for lo in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo : lo + 10_000]), _CUT_TYPES)], names=_CUT_NAMES)


_CUT = "doc_id long, text_key long, key long, first int, count int, ahead int, single boolean, bytes binary"
_CUT_NAMES = [x.split()[0] for x in _CUT.split(", ")]
_CUT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals (doc_id, text_key, low, high) removed from single windows; rows come sorted by key."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    held: list[tuple] = []
    for _, group in itertools.groupby(rows, key=lambda r: r[2]):
        group = list(group)
        for (doc_id, text_key, _, first, _, ahead, single, data), (low, high) in zip(group, trimmed([(r[7], r[5]) for r in group])):
            if low < high:
                held.append((doc_id, text_key, first + low, single, data[low : high + LENGTH - 1], ahead - low))
        if len(held) >= GROUP_WINDOWS:
            yield from _intervals(held)
            held = []
    yield from _intervals(held)


def named_anchors(texts: list[bytes], places: list[int]) -> list[bytes]:
    """The texts with their anchors' bytes (at ``places``) replaced by a name of ``CODE`` symbols: the same for the
    same bytes, another for others."""
    known: dict[bytes, bytes] = {}
    out = []
    for text, a in zip(texts, places):
        anchor = text[a : a + KMER]
        if anchor not in known:
            n = len(known)
            known[anchor] = bytes(CODE_SYMBOLS[n // len(CODE_SYMBOLS) ** i % len(CODE_SYMBOLS)] for i in range(CODE))
        out.append(text[:a] + known[anchor] + text[a + KMER :])
    if len(known) > len(CODE_SYMBOLS) ** CODE:
        raise ValueError("more anchors in a collection than names")
    return out


def _intervals(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    out = []
    texts = named_anchors([r[4] for r in rows], [r[5] for r in rows])
    for (doc_id, text_key, first, single, _, _), starts in zip(rows, repeated_starts(texts, LENGTH - KMER + CODE) if rows else []):
        if single and len(starts):
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                out.append((doc_id, text_key, first + int(run[0]), first + int(run[-1]) + LENGTH))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "text_key", "low", "high"])


def _single_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Crowded windows cut into single starts: (doc_id, text_key, key, first, count, body)."""
    powers, inverse = powers_for(4 * LENGTH)
    for b in batches:
        for lo in range(0, b.num_rows, 1000):
            part = b.slice(lo, 1000)
            row, start, body = [], [], []
            for i, (first, count, data) in enumerate(zip(part.column(3).to_pylist(), part.column(4).to_pylist(), part.column(7).to_pylist())):
                at = np.arange(count)
                row.append(np.full(count, i))
                start.append(first + at)
                body.append(Hashes(np.frombuffer(data, np.uint8), powers, inverse)(at, at + LENGTH).view(np.int64))
            row, start, body = np.concatenate(row), np.concatenate(start), np.concatenate(body)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(body), pa.array(start.astype(np.int32)), pa.array(np.ones(len(row), np.int32)), pa.array(body), pa.array(np.zeros(len(row), np.int32))],
                names=[x.split()[0] for x in _ROW.split(", ")],
            )


def _paired(rows: DataFrame) -> DataFrame:
    """Windows that are not alone with their anchor, with ``n_same`` (rows with equal bytes, 2 for more),
    ``place`` (number among those) and ``kinds`` (whether the anchor has windows of other bytes)."""
    by_key, same = Window.partitionBy("key"), Window.partitionBy("key", "body")
    return rows.withColumns({
        "_lo": F.min("body").over(by_key), "_hi": F.max("body").over(by_key), "_n": F.count(F.lit(1)).over(same),
    }).withColumns({"kinds": F.col("_lo") != F.col("_hi")}).where("kinds or _n > 1").drop("_lo", "_hi")


def repeated_intervals(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, low, high): byte ranges to remove; they may overlap."""
    text_key = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key.alias("text_key"), "text")
    paired = stored(_paired(rows.mapInArrow(_find_windows, _ROW)), "windows")
    whole = paired.where("_n > 1").select("doc_id", "text_key", F.col("first").cast("long").alias("low"), (F.col("first") + F.col("count") + (LENGTH - 1)).cast("long").alias("high"))

    mixed = paired.where("kinds")
    one = mixed.groupBy("key", "body").agg(F.min(F.struct("doc_id", "text_key", "first", "count", "ahead")).alias("w"), F.count(F.lit(1)).alias("_n"))
    one = one.select("key", "w.*", (F.col("_n") == 1).alias("single"))
    crowded = mixed.groupBy("key").agg(F.approx_count_distinct("body").alias("_kinds")).where(F.col("_kinds") > CROWD).select("key")
    crowded = stored(crowded, "crowded-anchors")
    wanted = one.join(crowded, "key", "left_anti").withColumn("_crowded", F.lit(False))
    hot = mixed.join(crowded, "key", "left_semi").where("_n = 1").select("key", "doc_id", "text_key", "first", "count", "ahead", F.lit(True).alias("single"), F.lit(True).alias("_crowded"))
    hot_whole = mixed.join(crowded, "key", "left_semi").where("_n > 1").groupBy("key", "body").agg(F.min(F.struct("doc_id", "text_key", "first", "count", "ahead")).alias("w"))
    # Of windows that repeat as a whole two rows stand for all: their strings are repeated anyway.
    twice = hot_whole.select("key", "w.*", F.lit(False).alias("single"), F.lit(True).alias("_crowded"))
    wanted = wanted.unionByName(hot).unionByName(twice).unionByName(twice)

    entry = F.struct("key", "first", "count", "ahead", "single", "_crowded")
    by_doc = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(entry).alias("wanted")).withColumnsRenamed({"doc_id": "_id", "text_key": "_text_key"})
    # Equal rows cut their windows more than once. That changes nothing: none of theirs is single.
    texts = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text_key"))).select("doc_id", "text_key", "text", "wanted")
    plain = texts.withColumn("wanted", F.filter("wanted", lambda w: ~w["_crowded"])).mapInArrow(_cut_windows, _CUT)
    judged = plain.repartition("key").sortWithinPartitions("key").mapInArrow(_judge, "doc_id long, text_key long, low long, high long")
    found = whole.unionByName(judged)
    if not crowded.isEmpty():
        cut = texts.withColumn("wanted", F.filter("wanted", lambda w: w["_crowded"])).mapInArrow(_cut_windows, _CUT)
        starts = cut.mapInArrow(_single_starts, _ROW)
        again = starts.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("_n > 1")
        found = found.unionByName(again.select("doc_id", "text_key", F.col("first").cast("long").alias("low"), (F.col("first") + LENGTH).cast("long").alias("high")))
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, out = b.column(0), []
        for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            data = (text or "").encode("utf-8", "surrogatepass")
            kept, at, removed, merged = hashlib.sha256(), 0, 0, []
            for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            for low, high in merged:
                kept.update(data[at:low])
                removed, at = removed + high - low, high
            kept.update(data[at:])
            out.append((len(data), removed, len(merged), kept.hexdigest(), [x for m in merged for x in m]))
        n, removed, spans, digest, flat = zip(*out) if out else ((),) * 5
        yield pa.record_batch({
            "doc_id": ids, "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array(digest, pa.string()), "removed": pa.array(flat, pa.list_(pa.int64())),
        })


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed) of each row of ``docs``; ``removed``
    lists the ends of the removed byte ranges in turn."""
    spans = repeated_intervals(docs).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "_id", "text_key": "_text_key"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text_key")), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>")
