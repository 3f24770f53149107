"""Secret scans: fixed patterns, and a character convolutional network for what they miss.

The patterns give the base findings. Every run of value characters that holds a letter and a digit is a
candidate; those that a base finding covers are the labelled findings, the others the labelled rest.
A network of one convolution over characters (candidate and surrounding context told apart),
maxima over candidate and over context, and one dense unit is fitted on three fifths of all distinct
windows (a candidate with its context), by a hash of the window: each round, every block of windows goes on from
the common weights by itself (Adam), and the blocks' weights and moments are averaged by their windows (in
integers, so that the order does not count). Its output is calibrated (Platt) on another fifth, and on the last the threshold is set: the
highest that still finds ``recall`` of the labelled findings there. Candidates outside base findings that reach
it are added; base findings stay.

A maximum over positions may be taken piece by piece, so a candidate of any length is learnt from and scored
whole, in chunks. Documents are scanned twice (windows, findings), each time in one pass without a shuffle of
texts. The driver gets sums and weights.

Defined results: a null or empty text has no findings; a null id stays null; repeated rows each give a row;
no labelled findings or no rest (or no documents) leave the base findings alone; columns beside id
and text are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import stored

# Fixed by the contract: kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")  # a run's match starts at its start: the same as [0-9a-f]+ of 24 or more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
MODEL = "model"

CANDIDATE_LEAST = 8
BEFORE, AFTER = 24, 16
WIDTH, FILTERS = 5, 24
CHUNK = 128
ROWS = 512  # chunks convolved at a time
HELD = 50_000  # windows a task holds before it passes them on
BLOCK, BLOCK_BYTES = 4_096, 8 << 20  # windows of a block, and their bytes, about
BUCKETS = 1_024
RECALL = 0.98

# Symbols: printable ASCII, one for all else, one for padding; twice, for context and candidate.
_OTHER, _PAD, _SYMBOLS = 95, 96, 97
_SYMBOL = np.array([b - 32 if 32 <= b <= 126 else _OTHER for b in range(256)], np.int16)
_VALUE, _DIGIT, _LETTER = 1, 2, 4
_CLASS = np.zeros(256, np.uint8)
for _c in b"+/_.=-":
    _CLASS[_c] = _VALUE
for _c in range(128):
    _CLASS[_c] |= _VALUE | _DIGIT if chr(_c).isdigit() else _VALUE | _LETTER if chr(_c).isalpha() else 0


def base_findings(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) by the patterns, in bytes: leftmost matches of each kind that do not overlap,
    without those that are too short."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) in bytes of the maximal runs of value characters with a letter and a digit."""
    kind = _CLASS[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff((kind > 0).view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= CANDIDATE_LEAST
    starts, ends = starts[long], ends[long]
    for what in (_DIGIT, _LETTER):
        if not len(starts):
            break
        upto = np.zeros(len(kind) + 1, np.int64)
        np.cumsum(kind & what > 0, out=upto[1:])
        has = upto[ends] > upto[starts]
        starts, ends = starts[has], ends[has]
    return starts, ends


def covered(starts: np.ndarray, ends: np.ndarray, base: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether a base finding overlaps each candidate."""
    out = np.zeros(len(starts), bool)
    for s, _, e in base:
        # Candidates are apart and in order: those that overlap s..e are neighbours.
        out[np.searchsorted(ends, s, "right") : np.searchsorted(starts, e, "left")] = True
    return out


def window(text: bytes, start: int, end: int) -> tuple[bytes, int, int]:
    """The candidate with its context, and where it lies in it."""
    begin = max(0, start - BEFORE)
    return text[begin : end + AFTER], start - begin, end - begin


def encode(windows: list[tuple[bytes, int, int]], chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """(symbols: rows of ``chunk`` + WIDTH - 1; window of each row). Chunks overlap so that every place of a
    window is the middle of one convolution."""
    rows, owner = [], []
    half = WIDTH // 2
    for k, (raw, s, e) in enumerate(windows):
        sym = _SYMBOL[np.frombuffer(raw, np.uint8)]
        sym[s:e] += _SYMBOLS
        sym = np.concatenate([np.full(half, _PAD, np.int16), sym, np.full(half, _PAD, np.int16)])
        for at in range(0, len(raw), chunk):
            row = np.full(chunk + 2 * half, _PAD, np.int16)
            part = sym[at : at + chunk + 2 * half]
            row[: len(part)] = part
            rows.append(row)
            owner.append(k)
    if not rows:
        return np.empty((0, chunk + 2 * half), np.int16), np.empty(0, np.int64)
    return np.stack(rows), np.array(owner)


@dataclass
class Network:
    kernel: np.ndarray  # WIDTH x symbols x FILTERS
    bias: np.ndarray
    dense: np.ndarray  # maxima over the candidate, then over the context
    offset: float
    slope: float = 1.0  # calibration of the output
    shift: float = 0.0
    threshold: float = 1.0

    def maxima(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest value of each filter over candidate and over context: 2 x rows x FILTERS; its place)."""
        places = symbols.shape[1] - WIDTH + 1
        z = np.zeros((len(symbols), places, FILTERS), np.float32)
        for k in range(WIDTH):
            z += self.kernel[k][symbols[:, k : k + places]]
        middle = symbols[:, WIDTH // 2 : WIDTH // 2 + places]
        inside = middle >= _SYMBOLS
        values, at = [], []
        for here in (inside, ~inside & (middle != _PAD)):
            zz = np.where(here[:, :, None], z, np.float32(-1e9))
            a = zz.argmax(axis=1)
            at.append(a)
            values.append(np.take_along_axis(zz, a[:, None, :], 1)[:, 0])
        return np.stack(values), np.stack(at)

    def tops(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of whole windows (``owner`` ascends from 0): (``maxima``: windows x 2 x FILTERS; the symbols under them:
        the same x WIDTH)."""
        best = np.full((owner[-1] + 1, 2, FILTERS), -np.inf, np.float32)
        under = np.zeros((*best.shape, WIDTH), np.int16)
        for lo in range(0, len(symbols), ROWS):
            x, who = symbols[lo : lo + ROWS], owner[lo : lo + ROWS]
            values, at = self.maxima(x)
            first = np.flatnonzero(np.diff(who, prepend=-1))
            top = np.maximum.reduceat(values, first, axis=1)
            mine = np.repeat(np.arange(len(first)), np.diff(first, append=len(who)))
            row = np.maximum.reduceat(np.where(values == top[:, mine], np.arange(len(who))[:, None], -1), first, axis=1)
            place = np.take_along_axis(at, row, 1)
            found = x[row[..., None], place[..., None] + np.arange(WIDTH)].transpose(1, 0, 2, 3)
            top, who = top.transpose(1, 0, 2), who[first]
            better = top > best[who]
            best[who] = np.where(better, top, best[who])
            under[who] = np.where(better[..., None], found, under[who])
        return best, under

    def logits(self, windows: list[tuple[bytes, int, int]], rows: int = ROWS) -> np.ndarray:
        """Raw outputs of whole windows; bounded memory whatever their number or length."""
        best = np.full((len(windows), 2, FILTERS), -1e9, np.float32)
        for lo in range(0, len(windows), rows):
            symbols, owner = encode(windows[lo : lo + rows])
            for a in range(0, len(symbols), rows):
                values, _ = self.maxima(symbols[a : a + rows])
                np.maximum.at(best, lo + owner[a : a + rows], values.transpose(1, 0, 2))
        hidden = np.maximum(best + self.bias, 0).reshape(len(windows), -1)
        return (hidden @ self.dense + np.float32(self.offset)).astype(np.float32)

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * logits + self.shift).clip(-60, 60)))

    def probabilities(self, windows: list[tuple[bytes, int, int]]) -> np.ndarray:
        return self.calibrated(self.logits(windows))

    def weights(self) -> np.ndarray:
        return np.concatenate([self.kernel.ravel(), self.bias, self.dense, [self.offset]]).astype(np.float64)

    @staticmethod
    def parts(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Views of ``weights``: kernel, bias, dense, offset."""
        kernel, bias, dense, offset = np.split(weights, np.cumsum([WIDTH * 2 * _SYMBOLS * FILTERS, FILTERS, 2 * FILTERS]))
        return kernel.reshape(WIDTH, 2 * _SYMBOLS, FILTERS), bias, dense, offset

    @staticmethod
    def of(weights: np.ndarray) -> Network:
        kernel, bias, dense, offset = Network.parts(weights.astype(np.float32, copy=False))
        return Network(kernel, bias, dense, float(offset[0]))


def _start(seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    return Network(
        rng.normal(0, 0.1, (WIDTH, 2 * _SYMBOLS, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), 0.0,
    )


def _learn(state: np.ndarray, done: int, windows, labels: np.ndarray, weight: tuple[float, float], decay: float, seed) -> np.ndarray:
    """Adam on the logistic loss, once through the windows, after ``done`` steps; ``weight`` is that of a window by
    its label, ``decay`` holds the dense unit back. The state: weights, first moments, roots of the second ones."""
    symbols, owner = encode(windows)
    first = np.searchsorted(owner, np.arange(len(windows) + 1))
    y = labels.astype(np.float32)
    each = np.where(y == 1, weight[1], weight[0])
    state = state.astype(np.float32)
    state[2] **= 2
    net = Network.of(state[0])  # its arrays are views
    params, one, two = ([*Network.parts(x)] for x in state)
    offset = params[3]
    order = np.random.default_rng(seed).permutation(len(y))
    filters = np.arange(FILTERS)
    for step, lo in enumerate(range(0, len(order), 128), done + 1):
        pick = order[lo : lo + 128]
        long = first[pick + 1] - first[pick]
        rows = np.repeat(first[pick] - (np.cumsum(long) - long), long) + np.arange(long.sum())
        values, under = net.tops(symbols[rows], np.repeat(np.arange(len(pick)), long))
        raw = values + net.bias
        hidden = np.maximum(raw, 0).reshape(len(pick), -1)
        p = 1 / (1 + np.exp(-(hidden @ net.dense + offset[0]).clip(-60, 60)))
        d = ((p - y[pick]) * each[pick] / len(pick)).astype(np.float32)
        back = (d[:, None] * net.dense[None, :]).reshape(len(pick), 2, FILTERS) * (raw > 0)
        g_kernel = np.zeros_like(net.kernel)
        for k in range(WIDTH):
            np.add.at(g_kernel[k], (under[..., k], np.broadcast_to(filters, back.shape)), back)
        grads = [g_kernel, back.sum((0, 1)), hidden.T @ d + decay * net.dense, np.array([d.sum()], np.float32)]
        for q, g, m, v in zip(params, grads, one, two):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            q -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    state[2] **= 0.5
    return state.astype(np.float64)


def _fit(windows: DataFrame, count: dict[int, int], n_bytes: int, epochs: int, block: int) -> Network:
    """The network fitted on all ``windows`` (label, h, raw, s, e), ``count`` by label. What a round gives depends
    on the windows alone, not on how they are dealt out."""
    rows = sum(count.values())
    n_blocks = max(math.ceil(rows / block), math.ceil(n_bytes / BLOCK_BYTES))
    # Both labels weigh the same; the rarer one's windows 1, so that moments stay small however rare it is.
    fewest = min(count.values())
    weight, decay = (fewest / count[0], fewest / count[1]), 1e-4 * 2 * fewest / rows
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("h"), F.lit(n_blocks))).repartition(n_blocks, "block").persist()
    state = np.stack([_start().weights(), *np.zeros((2, len(_start().weights())))])
    unit = 2.0 ** (52 - math.ceil(math.log2(rows)))  # sums of values below 2**10 fit in 63 bits
    for epoch in range(epochs):
        shared = windows.sparkSession.sparkContext.broadcast(state)

        def learn(held):
            held = held.sort_by([("h", "ascending"), ("label", "ascending")])
            raw, s, e, labels = (held.column(c) for c in ("raw", "s", "e", "label"))
            spans = list(zip(raw.to_pylist(), s.to_pylist(), e.to_pylist()))
            done, seed = epoch * math.ceil(rows / n_blocks / 128), [epoch, held.column("block")[0].as_py()]
            new = _learn(shared.value, done, spans, labels.to_numpy(), weight, decay, seed)
            sums = np.rint(new.ravel() * unit).astype(np.int64) * len(spans)
            return pa.table({"place": pa.array(np.arange(len(sums)), pa.int32()), "sum": pa.array(sums, pa.int64())})

        learnt = dealt.groupBy("block").applyInArrow(learn, "place int, sum long")
        sums = learnt.groupBy("place").agg(F.sum("sum").alias("sum")).toArrow()  # as many rows as the state has values
        state.ravel()[sums.column("place").to_numpy()] = sums.column("sum").to_numpy() / rows / unit
        shared.unpersist()
    dealt.unpersist()
    return Network.of(state[0])


def _platt(scored: DataFrame) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (z, label), labels smoothed by their counts: Newton's method,
    the sums by Spark."""
    up, down, most = scored.agg(F.sum("label"), F.sum(1 - F.col("label")), F.max(F.abs("z")).cast("double")).first()
    scale = max(most, 1e-6)
    x = F.col("z").cast("double") / F.lit(scale)
    t = F.when(F.col("label") == 1, F.lit((up + 1) / (up + 2))).otherwise(F.lit(1 / (down + 2)))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        out = F.greatest(F.least(x * F.lit(float(w[0])) + F.lit(float(w[1])), F.lit(60.0)), F.lit(-60.0))
        rows = scored.select(x.alias("x"), (1 / (1 + F.exp(-out))).alias("p"), t.alias("t"))
        v = F.col("p") * (1 - F.col("p"))
        off = F.col("p") - F.col("t")
        xx, x1, one, ox, o1 = rows.agg(F.sum(v * F.col("x") * F.col("x")), F.sum(v * F.col("x")), F.sum(v), F.sum(off * F.col("x")), F.sum(off)).first()
        step = np.clip(np.linalg.solve(np.array([[xx, x1], [x1, one]]) + 1e-6 * np.eye(2), np.array([ox, o1]) + 1e-6 * w), -5, 5)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return float(np.float32(w[0] / scale)), float(np.float32(w[1]))


def _ranked(values: DataFrame, place: int) -> float:
    """The value ``v`` at ``place`` (from 0) in ascending order: counted in buckets, each time those of one bucket."""
    lo, hi = values.agg(F.min("v"), F.max("v")).first()
    while lo < hi:
        bucket = F.floor((F.col("v") - F.lit(lo)) / F.lit(hi - lo) * BUCKETS)
        inside = values.where(F.col("v").between(lo, hi)).groupBy(bucket.alias("bucket"))
        for r in inside.agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("bucket").collect():
            if place < r.n:
                lo, hi = r.lo, r.hi
                break
            place -= r.n
    return lo


def all_windows(docs: DataFrame, text_col: str) -> DataFrame:
    """``label, h, raw, s, e``: all documents' distinct windows, with a hash of each."""

    def passed_on(held) -> pa.RecordBatch:
        names = ["label", "h", "raw", "s", "e"]
        types = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        columns = list(zip(*held)) if held else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def pick(batches):
        held = {}
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if not text:
                    continue
                starts, ends = candidates(text)
                if not len(starts):
                    continue
                for s, e, label in zip(starts.tolist(), ends.tolist(), covered(starts, ends, base_findings(text)).tolist()):
                    raw, a, b = window(text, s, e)
                    held[int(label), xxhash.xxh64_intdigest(raw, a) >> 1, raw, a, b] = None
                    if len(held) >= HELD:
                        yield passed_on(held)
                        held.clear()
        yield passed_on(held)

    texts = docs.select(F.col(text_col).cast("binary"))
    return texts.mapInArrow(pick, "label int, h bigint, raw binary, s int, e int").distinct()


def train(docs: DataFrame, text_col: str = "text", *, sample: int | None = None, recall: float = RECALL, epochs: int = 8, block: int = BLOCK) -> Network | None:
    """The network, fitted, calibrated and given its threshold on all distinct windows of ``docs`` (``sample``, if the
    caller wants a quick look: on so many a label); ``None`` if the labels are too few to fit and judge one."""
    found = all_windows(docs, text_col)
    if sample is not None:
        found = stored(found, "secret-windows-all")
        found = found.where("label = 0").orderBy("h").limit(sample).union(found.where("label = 1").orderBy("h").limit(sample))
    # Five parts by hash: three fit, one calibrates, one sets the threshold.
    windows = stored(found.withColumn("part", F.greatest(F.col("h") % 5, F.lit(2)).cast("int")), "secret-windows")
    n, n_bytes = {}, 0
    for r in windows.groupBy("part", "label").agg(F.count("h").alias("n"), F.sum(F.length("raw")).alias("n_bytes")).collect():
        n[r.part, r.label] = r.n
        n_bytes += r.n_bytes if r.part == 2 else 0
    if len(n) < 6:
        return None
    net = _fit(windows.where("part = 2").drop("part"), {label: n[2, label] for label in (0, 1)}, n_bytes, epochs, block)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches):
        for b in batches:
            spans = list(zip(*(b.column(c).to_pylist() for c in range(2, 5))))
            yield pa.record_batch({"label": b.column(0), "part": b.column(1), "z": pa.array(shared.value.logits(spans), pa.float32())})

    left = windows.where("part > 2").select("label", "part", "raw", "s", "e")
    scored = stored(left.mapInArrow(score, "label int, part int, z float"), "secret-scores")
    net.slope, net.shift = _platt(scored.where("part = 3"))
    way = 1 if net.slope >= 0 else -1
    known = scored.where("part = 4 and label = 1").select((F.col("z").cast("double") * way).alias("v"))
    lowest = way * _ranked(known, int(np.floor((1 - recall) * n[4, 1])))
    net.threshold = float(net.calibrated(np.array([lowest], np.float32))[0])
    return net


_FINDINGS = "array<struct<kind: string, start: bigint, end: bigint, score: double>>"


def find_secrets(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, findings``: each document's findings by start, then kind; code points, end exclusive. ``score`` is
    the network's for its own (kind ``model``), null for those of the patterns."""
    names = [*KINDS, MODEL]
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def scan(batches):
        model = shared.value
        for batch in batches:
            found, todo = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                text = text or b""
                base = base_findings(text)
                found.append([(s, kind, e, None) for s, kind, e in base])
                if model is not None and text:
                    starts, ends = candidates(text)
                    free = ~covered(starts, ends, base)
                    todo += [(k, s, e) for s, e in zip(starts[free].tolist(), ends[free].tolist())]
            texts = batch.column(1)
            for lo in range(0, len(todo), 4096):
                some = todo[lo : lo + 4096]
                at, held, windows = -1, b"", []
                for k, s, e in some:
                    if k != at:
                        at, held = k, texts[k].as_py()
                    windows.append(window(held, s, e))
                scores = model.probabilities(windows)
                for j in np.flatnonzero(scores >= model.threshold):
                    k, s, e = some[j]
                    found[k].append((s, len(KINDS), e, float(scores[j])))
            out = []
            for k, spans in enumerate(found):
                place = _code_points(texts[k].as_py(), spans) if spans else {}
                out.append([{"kind": names[kind], "start": place[s], "end": place[e], "score": p} for s, kind, e, p in sorted(spans, key=lambda x: x[:3])])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["id", "findings"])

    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary")).mapInArrow(scan, f"id {id_type}, findings {_FINDINGS}")
    return found.select(F.col("id").alias(id_col), "findings")


def _code_points(text: bytes, spans) -> dict[int, int]:
    """{byte offset: code points before it} of the spans' ends."""
    ends = sorted({x for s, _, e, _ in spans for x in (s, e)})
    if text.isascii():
        return {x: x for x in ends}
    before = np.zeros(len(text) + 1, np.int64)
    np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80, out=before[1:])
    return {x: int(before[x]) for x in ends}


def with_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_assign, n_access, n_hex, n_model, base_sha256, spans`` of ``find_secrets``' rows."""
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = joined(F.filter("findings", lambda x: x["kind"] != MODEL))
    return found.select(id_col, *[count(k) for k in (*KINDS, MODEL)], F.sha2(base, 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))
