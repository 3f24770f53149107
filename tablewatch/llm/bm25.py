"""Benchmark decontamination: BM25 over the test items with block-max WAND, then overlap checks.

The *items* are indexed (term -> postings in blocks, each with its largest impact), and every
passage of every document is a query: its distinct terms. All items whose score is at least
``threshold`` of the score they give their own text are retrieved, and a retrieved pair counts when
the passage holds enough of the question's and of the answer's word n-grams, or when it holds at least
``WHOLE_OVERLAP`` of the whole item (question and answer words together) in finer grams: no longer than
``WHOLE_GRAM`` words, and shorter for short items, so that any one changed word leaves enough of them. A
copy that was edited, or that lacks a short answer, counts by this; a question alone whose answer is
longer than that does not.

Passages are windows of the document's words, twice ``stride`` long and ``stride`` apart, where
``stride`` is at least the longest item: each copy of an item lies whole in one window.

Most passages share only common words with any item. Before WAND runs, a bound rules them out for a
whole batch of documents at once: per block of items, the largest impact of each of the passage's
terms summed up. Only passages for which some block reaches the threshold are queried, and WAND,
which then skips by the postings' block maxima, decides exactly.

An index holds about ``ITEMS_PER_INDEX`` items; a larger benchmark is cut into several, queried in turn.
Document frequencies, the mean length and the stride are those of the whole benchmark (counted in
Spark), so scores and passages do not depend on the cut.

Defined results: null, blank or word-free texts and items match nothing. An item whose answer has no
words is judged by its question alone (and the other way round). Repeated items each match; repeated
documents each get their rows. Extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import stored

K1, B = 1.2, 0.75
ITEMS_PER_INDEX = 4096
BOUND_ITEMS = 4  # items per block of the batch bound
POSTINGS_PER_BLOCK = 16
LEAST_STRIDE = 64
WHOLE_OVERLAP = 0.65
WHOLE_GRAM = 2
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


@dataclass
class Item:
    item_id: int
    question: list[str]
    answer: list[str]


@dataclass
class Statistics:
    """Of a whole benchmark: items with words, their words, the longest one's; per word, items that hold it."""

    items: int
    words: int
    longest: int
    found: dict[str, int]

    @staticmethod
    def of(items: list[Item]) -> Statistics:
        texts = [i.question + i.answer for i in items if i.question or i.answer]
        lengths = [len(t) for t in texts]
        return Statistics(len(texts), sum(lengths), max(lengths, default=0), Counter(w for t in texts for w in set(t)))


class Bm25Index:
    """Impacts are divided by the score of the item's own text, so 1.0 is a full match. ``whole``: the
    benchmark's statistics, where ``items`` are a part of it."""

    def __init__(self, items: list[Item], whole: Statistics | None = None):
        whole = whole or Statistics.of(items)
        self.items = [i for i in items if i.question or i.answer]
        texts = [Counter(i.question + i.answer) for i in self.items]
        self.longest, found = whole.longest, whole.found
        self.term = {w: k for k, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        mean = whole.words / whole.items if whole.items else 1.0
        postings = defaultdict(list)
        for number, t in enumerate(texts):
            norm = K1 * (1 - B + B * t.total() / mean)
            weights = {
                w: np.log(1 + (whole.items - found[w] + 0.5) / (found[w] + 0.5)) * tf * (K1 + 1) / (tf + norm) for w, tf in t.items()
            }
            own = sum(weights.values())
            for w, x in weights.items():
                postings[self.term[w]].append((number, x / own))
        self.docs, self.impacts, self.block_max, self.top = [], [], [], np.zeros(len(self.term))
        rows, blocks, best = [], [], []
        for k in range(len(self.term)):
            docs, impacts = np.array([p[0] for p in postings[k]]), np.array([p[1] for p in postings[k]])
            self.docs.append(docs.tolist())
            self.impacts.append(impacts.tolist())
            self.block_max.append(np.maximum.reduceat(impacts, np.arange(0, len(docs), POSTINGS_PER_BLOCK)).tolist())
            self.top[k] = impacts.max()
            starts = np.flatnonzero(np.diff(docs // BOUND_ITEMS, prepend=-1))
            rows.append(len(starts))
            blocks.append(docs[starts] // BOUND_ITEMS)
            best.append(np.maximum.reduceat(impacts, starts))
        self.bound_at = np.concatenate([[0], np.cumsum(rows)]).astype(np.int64)
        self.bound_block = np.concatenate(blocks) if blocks else np.empty(0, np.int64)
        self.bound_max = np.concatenate(best) if best else np.empty(0)
        self.bound_blocks = len(self.items) // BOUND_ITEMS + 1

    def promising(self, passage: np.ndarray, term: np.ndarray, passages: int, threshold: float) -> np.ndarray:
        """Numbers of the passages that some block of items lets reach the threshold, given the
        distinct (passage, term) pairs."""
        passed, chunk = [], max(1, 4_000_000 // self.bound_blocks)
        for low in range(0, passages, chunk):
            lo, hi = np.searchsorted(passage, [low, low + chunk])
            t = term[lo:hi]
            n = self.bound_at[t + 1] - self.bound_at[t]
            at = np.repeat(self.bound_at[t] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            cell = np.repeat(passage[lo:hi] - low, n) * self.bound_blocks + self.bound_block[at]
            sums = np.bincount(cell, self.bound_max[at], min(chunk, passages - low) * self.bound_blocks)
            passed.append(low + np.flatnonzero(sums.reshape(-1, self.bound_blocks).max(axis=1) >= threshold - 1e-9))
        return np.concatenate(passed) if passed else np.empty(0, np.int64)

    def retrieve(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: every item with a score of at least ``threshold``, and the score."""
        need, out = threshold - 1e-9, []
        cursors = [[self.docs[t][0], t] for t in terms]  # next item, term
        top = self.top.tolist()
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += top[c[1]]
                if bound >= need:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            ahead, block_bound, next_item = [], 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.items)
            for c in cursors[: pivot + 1]:
                docs = self.docs[c[1]]
                place = bisect_left(docs, item)
                ahead.append(place)
                if place < len(docs):
                    block = place // POSTINGS_PER_BLOCK
                    block_bound += self.block_max[c[1]][block]
                    next_item = min(next_item, docs[min(len(docs), (block + 1) * POSTINGS_PER_BLOCK) - 1] + 1)
            if block_bound >= need:
                score = sum(self.impacts[c[1]][p] for c, p in zip(cursors, ahead) if p < len(self.docs[c[1]]) and self.docs[c[1]][p] == item)
                if score >= need:
                    out.append((item, score))
                next_item = item + 1
            next_item = max(next_item, item + 1)  # no item before it can reach the threshold
            for c in cursors[: pivot + 1]:
                place = bisect_left(self.docs[c[1]], next_item)
                c[0] = self.docs[c[1]][place] if place < len(self.docs[c[1]]) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return out


def indexes(benchmark: DataFrame) -> Iterator[Bm25Index]:
    """The items (item_id, question, answer) as indexes of about ``ITEMS_PER_INDEX``. The driver holds
    one of them at a time, with the counts of its own words."""
    shards = max(1, -(-benchmark.count() // ITEMS_PER_INDEX))
    place = F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(shards)).cast("int")
    numbered = benchmark.select(place.alias("shard"), "item_id", "question", "answer")
    words = stored(numbered.select("shard", "question", "answer").mapInArrow(_item_words, "shard int, word string, length long"), "item-words")
    whole = words.where("word is null").agg(F.count("length"), F.sum("length"), F.max("length")).first()
    own = words.where("word is not null").groupBy("shard", "word").count()
    found = stored(own.select("shard", "word", F.sum("count").over(Window.partitionBy("word")).alias("found")), "item-word-counts")
    for shard in range(shards):
        held = found.where(F.col("shard") == shard).toArrow()
        counts = dict(zip(held.column("word").to_pylist(), held.column("found").to_pylist()))
        rows = numbered.where(F.col("shard") == shard).orderBy("item_id", "question", "answer").toLocalIterator()
        items = [Item(r.item_id, words_of(r.question), words_of(r.answer)) for r in rows]
        yield Bm25Index(items, Statistics(*(n or 0 for n in whole), counts))


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per item with words: its distinct words, then a row without a word and with its length."""
    for b in batches:
        rows = []
        for shard, question, answer in zip(*(c.to_pylist() for c in b.columns)):
            words = words_of(question) + words_of(answer)
            rows += [(shard, w, None) for w in dict.fromkeys(words)]
            rows += [(shard, None, len(words))] if words else []
        if rows:
            shards, found, lengths = zip(*rows)
            yield pa.record_batch({"shard": pa.array(shards, pa.int32()), "word": pa.array(found, pa.string()), "length": pa.array(lengths, pa.int64())})


def _passages(words: np.ndarray, stride: int) -> list[tuple[int, int]]:
    return [(i, min(i + 2 * stride, len(words))) for i in range(0, max(1, len(words) - stride), stride)]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, question_overlap: float = 0.6, answer_overlap: float = 0.6, n: int = 5
) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): one row per document and item found
    in it, with the best passage's figures. ``benchmark``: item_id, question, answer."""
    found = None
    for index in indexes(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def query(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for start in range(0, b.num_rows, 512):
                    part = b.slice(start, 512)
                    rows = _leaks(held.value, part.column(0).to_pylist(), part.column(1).to_pylist(), threshold, question_overlap, answer_overlap, n)
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        kind = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
        rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(query, kind)
        found = rows if found is None else found.unionByName(rows)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all columns: nothing is shuffled."""
    kept = docs
    for index in indexes(benchmark):
        kept = kept.where(_clean_column(docs.sparkSession.sparkContext.broadcast(index), options))
    return kept


def _clean_column(held, options: dict) -> Column:
    def clean(texts: pa.Array) -> pa.Array:
        return _clean(held.value, texts, options)

    return F.arrow_udf(clean, "boolean")(F.col("text"))


def _clean(index: Bm25Index, texts: pa.Array, options: dict) -> pa.Array:
    clean = np.ones(len(texts), bool)
    for start in range(0, len(texts), 512):
        part = texts.slice(start, 512).to_pylist()
        found = _leaks(index, list(range(start, start + len(part))), part, **{"threshold": 0.6, "least_q": 0.6, "least_a": 0.6, "n": 5} | options)
        clean[[row for row, *_ in found]] = False
    return pa.array(clean)


def _leaks(index: Bm25Index, ids: list, texts: list, threshold: float, least_q: float, least_a: float, n: int) -> list[tuple]:
    if not index.items:
        return []
    stride = max(LEAST_STRIDE, index.longest)
    get, span, term, passage, count = index.term.get, [], [], [], 0
    split = [words_of(t) for t in texts]
    for row, words in enumerate(split):
        known = np.array([get(w, -1) for w in words], np.int64)
        for low, high in _passages(known, stride):
            t = known[low:high]
            t = np.unique(t[t >= 0])
            term.append(t)
            passage.append(np.full(len(t), count))
            span.append((row, low, high))
            count += 1
    terms, passages = np.concatenate([np.empty(0, np.int64), *term]), np.concatenate([np.empty(0, np.int64), *passage])
    best: dict[tuple[int, int], tuple] = {}
    for k in index.promising(passages, terms, count, threshold):
        row, low, high = span[k]
        have = None
        for number, score in index.retrieve(term[k].tolist(), threshold):
            item = index.items[number]
            if have is None:
                have = split[row][low:high]
            q, a = (_overlap(part, have, n) for part in (item.question, item.answer))
            if ((q is None or q >= least_q) and (a is None or a >= least_a)) or _whole(item.question + item.answer, have) >= WHOLE_OVERLAP:
                now = (score, 1.0 if q is None else q, 1.0 if a is None else a)
                best[row, number] = max(best.get((row, number), now), now)
    return [(ids[row], index.items[number].item_id, *figures) for (row, number), figures in sorted(best.items())]


def _overlap(part: list[str], passage: list[str], n: int) -> float | None:
    """Share of the part's distinct word n-grams that the passage holds; None without words."""
    own = grams(part, n)
    if not own:
        return None
    size = len(next(iter(own)))
    return len(own & {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}) / len(own)


def _whole(item: list[str], passage: list[str]) -> float:
    """Share of the whole item that the passage holds, in grams of which one changed word leaves
    ``WHOLE_OVERLAP``. Items too short for grams of two words: their words within as long a stretch."""
    size = min(WHOLE_GRAM, int((len(item) + 1) * (1 - WHOLE_OVERLAP) / (2 - WHOLE_OVERLAP)))
    if size > 1:
        return _overlap(item, passage, size)
    own = Counter(item)
    stretches = (Counter(passage[i : i + len(item)]) for i in range(max(1, len(passage) - len(item) + 1)))
    return max((own & s).total() for s in stretches) / len(item)
