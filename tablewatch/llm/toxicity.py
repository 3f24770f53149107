"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams (``NGRAMS``) of the lower-cased text, hashed to
``2**BITS`` places. Training counts in how many toxic and in how many clean rows each place occurs
(Spark, partial sums), turns the counts into log-count ratios ``r``, and fits a logistic regression
on the features ``r``-scaled (present or absent), until its gradient has settled (L-BFGS). Which
places are too weak to use and how strongly the weights are held back is chosen by the log loss on
left-out training rows (``FOLDS`` parts by a hash of the text, so that copies stay together). The model
is one float per place plus a bias: 1 MB whatever the corpus, so scoring broadcasts it.

Training rows are a bounded sample, ``max_rows`` labelled rows, drawn by a hash of the id (all
of them when there are fewer). Scoring covers every row and every whole text.

Defined results: null and empty texts have no features and get the bias score; a null or repeated id
is scored like any other row; labels repeated for one id count once (toxic if any says so); rows of
``labels`` without a document, or with a null label, are not used. Without both classes in the
sample there is nothing to learn: every score is the share of toxic rows (0 if there are none).
Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 18
NGRAMS = (3, 4, 5)
MIN_ROWS = 4  # a place seen in fewer training rows says nothing
WEAK = (0.5, 1.0, 1.5, 2.0)  # places whose |log-count ratio| is below this are left out: the choices
L2 = (10.0, 3.0, 1.0, 0.3, 0.1)  # the choices, strongest first
FOLDS = 3
BLOCK = 1 << 20  # features summed at once on the driver
SLICE = 512  # texts made Python strings at a time
SETTLED = 1e-3  # largest entry of the gradient, summed over the rows


def char_places(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Sorted distinct places of the text's n-grams. ``seen``: 2**BITS False values, left so."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for n in NGRAMS:
        if len(points) >= n:
            h = np.full(len(points) - n + 1, n, np.uint32)
            for i in range(n):
                h = h * np.uint32(0x01000193) + points[i : len(points) - n + 1 + i]
            h ^= h >> np.uint32(15)
            seen[(h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)] = True
    places = np.flatnonzero(seen)
    seen[places] = False
    return places


@dataclass
class ToxicityModel:
    weights: np.ndarray  # float32, 2**BITS
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        seen = np.zeros(1 << BITS, bool)
        slices = (texts.slice(start, SLICE).to_pylist() for start in range(0, len(texts), SLICE))
        sums = np.array([self.weights[char_places(t, seen)].sum(dtype=np.float64) for part in slices for t in part], np.float64)
        return 1.0 / (1.0 + np.exp(-np.clip(sums + self.bias, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves remainder 1 by 3 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(text, toxic) of at most ``max_rows`` labelled documents that are not held out. Only that
    bounded list of ids is broadcast; the texts are not shuffled."""
    known = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).dropna()
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> ToxicityModel:
    fold = F.coalesce(F.pmod(F.xxhash64("text"), F.lit(FOLDS)), F.lit(0)).cast("int").alias("fold")
    rows = training_rows(docs, labels, max_rows).select("text", "toxic", fold, F.xxhash64("text", "toxic").alias("h")).repartition(8).persist()
    by_class = [f"{c}{k}" for c in ("clean", "toxic") for k in range(FOLDS)]
    counted = rows.mapInArrow(_count_places, "place int, " + ", ".join(f"{c} int" for c in by_class))
    sums = counted.groupBy("place").agg(*(F.sum(c).cast("int").alias(c) for c in by_class))
    places = sums.where(sum(F.col(c) for c in by_class) >= MIN_ROWS).toArrow()  # at most 2**BITS rows
    counts = np.zeros((2, FOLDS, 1 << BITS), np.int32)
    counts.reshape(2 * FOLDS, -1)[:, places.column("place").to_numpy()] = [places.column(c).to_numpy() for c in by_class]
    n = np.zeros((2, FOLDS), np.int64)
    for r in rows.select((F.col("toxic") == 1).alias("toxic"), "fold").groupBy("toxic", "fold").count().collect():
        n[int(r.toxic), r.fold] = r["count"]
    n_clean, n_toxic = n.sum(axis=1).tolist()
    if not n_toxic or not n_clean:
        rows.unpersist()
        share = n_toxic / max(1, n_toxic + n_clean)
        return ToxicityModel(np.zeros(1 << BITS, np.float32), float(np.clip(np.log(max(share, 1e-12) / max(1 - share, 1e-12)), -500, 500)))
    ratio = _ratios(counts.sum(axis=1), n.sum(axis=1))
    without = [_ratios(counts.sum(axis=1) - counts[:, k], n.sum(axis=1) - n[:, k]) for k in range(FOLDS)]
    held = rows.sparkSession.sparkContext.broadcast(np.any([np.abs(r) >= min(WEAK) for r in (ratio, *without)], axis=0))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, strong = np.zeros(1 << BITS, bool), held.value
        for b in batches:
            kept = [p[strong[p]].astype(np.int32) for p in (char_places(t, seen) for t in b.column(0).to_pylist())]
            columns = {"toxic": pa.array(b.column(1)).cast(pa.int32()), "fold": b.column(2), "h": b.column(3)}
            yield pa.record_batch({"places": pa.array(kept, pa.list_(pa.int32()))} | columns)

    strong = rows.mapInArrow(features, "places array<int>, toxic int, fold int, h long")
    judged = rows.sparkSession.sparkContext.broadcast((ratio, without))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights = _choose_and_fit(pa.Table.from_batches(list(batches)), *judged.value)
        pa.default_memory_pool().release_unused()  # the worker lives on
        yield pa.record_batch({"place": pa.array(places, pa.int32()), "weight": pa.array(weights, pa.float64())})

    # The sample is bounded: one task fits it, in the same order whenever it runs. The driver gets weights.
    fitted = strong.repartition(1).sortWithinPartitions("h").mapInArrow(fit, "place int, weight double").toArrow()
    rows.unpersist()
    held.unpersist()
    judged.unpersist()
    place, weight = fitted.column("place").to_numpy(), fitted.column("weight").to_numpy()
    weights = np.zeros(1 << BITS, np.float32)
    weights[place[place >= 0]] = weight[place >= 0]
    return ToxicityModel(weights, float(weight[place < 0][0]))


def _choose_and_fit(sample: pa.Table, ratio: np.ndarray, without: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(places, weights), the bias last at place -1: least held back and weak places by the loss on left-out
    folds, then a fit on all rows."""
    lists = sample.column("places").combine_chunks()
    flat, lengths = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    label, part = (sample.column("toxic").to_numpy() == 1).astype(np.float64), sample.column("fold").to_numpy()
    loss = {}
    for weak in WEAK:
        for k in range(FOLDS):
            learn = rest = None  # one choice's rows go before the next one's are made
            learn = _Rows(flat, lengths, part != k, _strong(without[k], weak))
            rest = _Rows(flat, lengths, part == k, _strong(without[k], weak))
            fitted = None
            for l2 in L2:
                fitted = _fit(learn, label[part != k], l2, fitted)
                margin = rest.margins(fitted)
                loss[weak, l2] = loss.get((weak, l2), 0.0) + np.logaddexp(0, margin).sum() - margin @ label[part == k]
    learn = rest = None
    weak, l2 = min(loss, key=loss.get)
    learn = _Rows(flat, lengths, part >= 0, _strong(ratio, weak))
    fitted = _fit(learn, label, l2)
    return np.append(learn.places, -1), np.append(fitted[:-1] * learn.scale, fitted[-1])


def _count_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, sums = np.zeros(1 << BITS, bool), np.zeros((2, FOLDS, 1 << BITS), np.int32)
    for b in batches:
        for text, toxic, fold, _ in zip(*(c.to_pylist() for c in b.columns)):
            sums[int(toxic == 1), fold][char_places(text, seen)] += 1
    found = np.flatnonzero(sums.any(axis=(0, 1)))
    if len(found):
        names = [f"{c}{k}" for c in ("clean", "toxic") for k in range(FOLDS)]
        yield pa.record_batch({"place": pa.array(found, pa.int32())} | dict(zip(names, sums.reshape(2 * FOLDS, -1)[:, found])))


def _ratios(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log-count ratio of each place from its (clean, toxic) rows of ``n``; 0 where it is too rare."""
    ratio = np.log((counts[1] + 1.0) / (n[1] + 2.0)) - np.log((counts[0] + 1.0) / (n[0] + 2.0))
    return np.where(counts.sum(axis=0) >= MIN_ROWS, ratio, 0.0)


def _strong(ratio: np.ndarray, weak: float) -> np.ndarray:
    return np.where(np.abs(ratio) >= weak, ratio, 0.0)


class _Rows:
    """Some rows' scaled features, in row order and in place order: two sums a step, no matrix."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray, kept: np.ndarray, scaled: np.ndarray):
        self.places = np.flatnonzero(scaled)
        self.scale = scaled[self.places].astype(np.float64)
        number = (np.cumsum(kept) - 1).astype(np.int32)
        use = np.repeat(kept, lengths)
        use &= (scaled != 0)[flat]
        row = np.repeat(number, lengths)[use]
        self.column = (np.cumsum(scaled != 0) - 1).astype(np.int32)[flat[use]]
        self.row_at = np.searchsorted(row, np.arange(kept.sum() + 1))
        order = np.argsort(self.column, kind="stable")
        self.row = row[order]
        self.column_at = np.searchsorted(self.column[order], np.arange(len(self.places) + 1))

    def margins(self, x: np.ndarray) -> np.ndarray:
        return _sums(x[:-1] * self.scale, self.column, self.row_at) + x[-1]

    def slopes(self, off: np.ndarray) -> np.ndarray:
        return np.append(_sums(off, self.row, self.column_at) * self.scale, off.sum())


def _sums(values: np.ndarray, which: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[which] between the places ``at``, a block at a time: the driver holds no second copy."""
    out, lo = np.empty(len(at) - 1), 0
    while lo < len(out):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + BLOCK, side="right")) - 1)
        upto = np.concatenate([[0.0], np.cumsum(values[which[at[lo] : at[hi]]])])
        out[lo:hi] = np.diff(upto[at[lo : hi + 1] - at[lo]])
        lo = hi
    return out


def _fit(rows: _Rows, label: np.ndarray, l2: float, start: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, the bias of the logistic regression: L-BFGS until the gradient has settled,
    or until rounding lets no step go down further."""

    def at(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = rows.margins(x)
        off = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))) - label
        held_back = np.append(l2 * x[:-1], 0.0)
        return np.logaddexp(0, margin).sum() - margin @ label + 0.5 * held_back @ x, rows.slopes(off) + held_back

    x = np.zeros(len(rows.places) + 1) if start is None else start
    loss, slope = at(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    while np.abs(slope).max() > SETTLED:
        way, shares = -slope, []
        for s, y in reversed(past):
            shares.append((s @ way) / (s @ y))
            way = way - shares[-1] * y
        way = way * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1.0 / np.linalg.norm(slope))
        for (s, y), share in zip(past, reversed(shares)):
            way = way + (share - (y @ way) / (s @ y)) * s
        step, down = 1.0, slope @ way
        while (new := at(x + step * way))[0] > loss + 1e-4 * step * down and step > 1e-9:
            step /= 2
        if new[0] >= loss:
            break
        if step * (new[1] - slope) @ way > 1e-12:
            past = [*past[-9:], (step * way, new[1] - slope)]
        x, loss, slope = x + step * way, *new
    return x


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        return pa.array(held.value.scores(texts), pa.float64())

    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.arrow_udf(score, "double")(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def clean(texts: pa.Array) -> pa.Array:
        return pa.array(held.value.scores(texts) < threshold)

    return docs.where(F.arrow_udf(clean, "boolean")(F.col("text")))
