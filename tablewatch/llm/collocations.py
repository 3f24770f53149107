"""Phrase collocations per language, counted by direct-address tiling.

Phrases grow by one word a level. On each level the *units* found so far -- words, then frequent pairs,
then frequent triples -- are ranked by frequency and numbered. An occurrence of (unit, next word) is a
cell of the grid rank x rank. The grid is split into square tiles; a task counts its buffered cells, those
of a tile that holds many of them with a dense ``numpy.bincount`` over the tile's addresses, the thin
tiles together as sorted coordinates. What a task has counted is summed by Spark, so a very common pair
arrives as one row a buffer, not one row an occurrence; ranked units and words travel as the cell's
number, and only the cells that are frequent become text. Those are ranked again and are the rows of the
next level's grid. Words are cut, and looked up once per distinct word, in batches by Arrow.

A phrase can be frequent only if its parts are, so a level looks only at places whose parts are known
to be frequent. A task knows them from a broadcast of fixed size: the ``head_units`` most frequent units
of all languages by rank (at most ``head_bytes`` of text), and for those beyond a bit table of
``FILTER_BITS`` bits over a hash of the unit. A unit that only the table admits is numbered by the task
itself, after the ranked ones; one that the table admits by accident is counted and then dropped by its
count. So the results do not depend on where the head ends.

Defined results: a null language is ``und``; a null or empty text has no words; repeated rows count as often
as they are there; no documents, no rows; columns beside text and language are not read.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import slices, stored

# Fixed by the contract: piece ends, and the language of documents that have none.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"

TILE = 512
#: A tile is dense if at least one cell in so many is hit.
DENSE_FROM = 8
#: Dense tiles counted at a time.
DENSE_AT_ONCE = 16
BUFFER_CELLS = 1 << 19
#: Text cut into words at a time.
BUFFER_BYTES = 1 << 20
HEAD_UNITS = 1 << 18
HEAD_BYTES = 8 << 20
FILTER_BITS = 1 << 26
FLUSH_WORDS = 500_000
#: Rows of a batch that a task hands on.
ROWS_OUT = 1 << 16
#: Words that only the bit table admits, held by a task before it counts and forgets them.
MOST_LOCAL = 200_000
#: Languages whose numbering a task keeps from one buffer to the next.
MOST_LANGS = 32

_COUNTS = "lang string, phrase string, a bigint"
_CELLS = "lang string, phrase string, cell bigint, a bigint"
# A-Z to a-z, piece ends to line ends; other bytes of UTF-8 stay.
_FOLDED = bytes(10 if b in PIECE_ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))


# The same with piece ends as a byte that no UTF-8 text has.
PIECE_MARK = b"\xff"
_MARKED = bytes(PIECE_MARK[0] if b in PIECE_ENDS else _FOLDED[b] for b in range(256))


def _words(texts: list[bytes], table: bytes) -> pa.Array:
    """The words of texts in order, a piece end after each text, with the bytes replaced by ``table``. Piece
    marks come as words of their own; there may be empty words at the ends. Arrow parts at ASCII blanks,
    of which only spaces, tabs and line ends are left."""
    joined = b".".join([*texts, b""]).translate(table).replace(PIECE_MARK, b" \xff ")
    return pc.ascii_split_whitespace(pa.array([joined], pa.binary()).view(pa.string())).flatten()


def _texts(batches):
    """Texts of one language at a time, of ``BUFFER_BYTES`` together (or of one longer text): (language, texts)."""
    held, size = defaultdict(list), defaultdict(int)
    for batch in slices(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                held[lang].append(text)
                size[lang] += len(text)
                if size[lang] >= BUFFER_BYTES:
                    yield lang, held.pop(lang)
                    del size[lang]
        if sum(size.values()) >= 4 * BUFFER_BYTES or len(held) > MOST_LANGS:
            yield from held.items()
            held.clear()
            size.clear()
    yield from held.items()


def _utf8(values) -> pa.Array:
    """Byte strings as text. They are cut from texts at ASCII bytes, so they are as valid as the texts."""
    return pa.array(values, pa.binary()).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, phrase, a`` for single words, all occurrences."""

    def count(batches):
        held: defaultdict = defaultdict(list)

        def merged(lang):
            parts = pa.concat_tables(held[lang])
            sums = parts.group_by("phrase", use_threads=False).aggregate([("a", "sum")])
            return pa.table({"phrase": sums["phrase"], "a": sums["a_sum"]})

        def rows():
            for lang in list(held):
                found = merged(lang)
                held.pop(lang)
                found = found.filter(pc.greater(pc.binary_length(found["phrase"]), 0)).combine_chunks()
                for batch in found.to_batches(ROWS_OUT):
                    langs = pa.DictionaryArray.from_arrays(pa.array(np.zeros(batch.num_rows, np.int32)), pa.array([lang])).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([langs, *batch.columns], names=["lang", "phrase", "a"])

        size = 0
        for lang, texts in _texts(batches):
            found = _words(texts, _FOLDED).value_counts()
            held[lang].append(pa.table({"phrase": found.field(0), "a": found.field(1)}))
            size += len(found)
            if size >= FLUSH_WORDS:
                for x in held:
                    held[x] = [merged(x)]
                size = sum(t.num_rows for [t] in held.values())
                if size >= FLUSH_WORDS // 2:
                    yield from rows()
                    size = 0
        yield from rows()
        pa.default_memory_pool().release_unused()  # the worker lives on

    return docs.mapInArrow(count, _COUNTS).repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def _mix(h: np.ndarray) -> np.ndarray:
    z = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _joined(unit: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a unit and one more word."""
    return _mix(unit * np.uint64(0x9E3779B97F4A7C15) + word)


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode()))


@dataclass
class Head:
    """What tasks know of one level's frequent units."""

    ranked: dict = field(default_factory=dict)  # lang -> units by rank (byte strings, words joined by one space)
    table: bytes = b""  # bits over hashes of the frequent units without a rank; empty if all have one
    cells: dict = field(default_factory=dict)  # lang -> rank of the unit before << 32 | rank of the word, by rank; -1: none
    hashes: dict = field(default_factory=dict)  # lang -> hashes of the ranked words, where a level has a table

    def address(self, before: list[Head]) -> None:
        """Set ``cells``: where the ranked units lie in the grid of the ``before`` level's units and the words. A
        unit whose parts have no rank themselves cannot be addressed; the bit table has it too."""
        for lang, units in self.ranked.items():
            words = {w: i for i, w in enumerate(before[0].ranked.get(lang, ()))}
            shorter = {u: i for i, u in enumerate(before[-1].ranked.get(lang, ()))}
            parts = [u.rpartition(b" ") for u in units]
            cells = [(shorter.get(p, -1), words.get(w, -1)) for p, _, w in parts]
            self.cells[lang] = np.array([(p << 32) | w if p >= 0 and w >= 0 else -1 for p, w in cells], np.int64)

    def admits_one(self, h: int) -> bool:
        at = h % (len(self.table) * 8)
        return self.table[at >> 3] >> (at & 7) & 1 == 1

    def admits(self, hashes: np.ndarray) -> np.ndarray:
        if not self.table:
            return np.zeros(len(hashes), bool)
        bits = np.frombuffer(self.table, np.uint8)
        at = (hashes % np.uint64(len(bits) * 8)).astype(np.int64)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def head_of(units: DataFrame, before: list[Head], head_units: int, head_bytes: int, filter_bits: int) -> Head:
    """The level's broadcast, of bounded size: ranks of the most frequent units, bits for all units if some
    have no rank or consist of parts without one (``before``: the heads of shorter units).

    ``units``: stored ``lang, phrase, a``. The driver receives at most ``head_units`` rows of at most
    ``head_bytes`` together, and at most ``filter_bits / 8`` bytes of table."""
    fits = F.length(F.col("phrase").cast("binary")) <= head_bytes // 1024  # a word as long as a book gets no rank
    order = [F.col("a").desc(), "lang", "phrase"]
    head, total, full = Head(), 0, False
    for batch in units.where(fits).orderBy(*order).limit(head_units).select("lang", F.col("phrase").cast("binary")).toArrow().to_batches():
        for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total += len(phrase) + len(lang.encode())
            if total > head_bytes:
                full = True
                break
            head.ranked.setdefault(lang, []).append(phrase)
        if full:
            break
    if not any(h.table for h in before) and units.count() == sum(map(len, head.ranked.values())):
        return head

    def bits(batches):
        for batch in batches:
            at = [_phrase_hash(lang, phrase) % filter_bits for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([x >> 6 for x in at], pa.int64()), pa.array([(1 << (x & 63)) - (1 << 64 if x & 63 == 63 else 0) for x in at], pa.int64())], names=["at", "bits"])

    table = np.zeros(filter_bits >> 6, np.int64)
    cells = units.select("lang", F.col("phrase").cast("binary")).mapInArrow(bits, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    got = cells.toArrow()
    table[got.column(0).to_numpy()] = got.column(1).to_numpy()
    head.table = table.tobytes()
    return head


def _phrase_hash(lang: str, phrase: bytes) -> int:
    words = [np.array([_word_hash(lang, w)], np.uint64) for w in phrase.split(b" ")]
    h = words[0]
    for w in words[1:]:
        h = _joined(h, w)
    return int(h[0])


def count_cells(rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, count) of each distinct cell. Tiles of ``TILE`` x ``TILE``: dense ones by bincount over
    the tile's addresses, thin ones by sorting their coordinates."""
    if not len(rows):
        return rows, columns, rows
    wide = int(columns.max()) // TILE + 1
    tile = (rows // TILE) * wide + columns // TILE
    dense = np.flatnonzero(np.bincount(tile) >= TILE * TILE // DENSE_FROM)
    number = np.full(int(tile.max()) + 1, -1, np.int32)
    number[dense] = np.arange(len(dense))
    number = number[tile]
    out = []
    for first in range(0, len(dense), DENSE_AT_ONCE):
        here = np.flatnonzero((number >= first) & (number < first + DENSE_AT_ONCE))
        address = (number[here].astype(np.int64) - first) * (TILE * TILE) + (rows[here] % TILE) * TILE + columns[here] % TILE
        counts = np.bincount(address)
        hit = np.flatnonzero(counts)
        corner, inside = dense[first + hit // (TILE * TILE)], hit % (TILE * TILE)
        out.append((corner // wide * TILE + inside // TILE, corner % wide * TILE + inside % TILE, counts[hit]))
    thin = number < 0
    if thin.any():
        across = int(columns.max()) + 1
        cells = np.sort(rows[thin] * across + columns[thin])
        starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        counts = np.diff(np.r_[starts, len(cells)])
        out.append((cells[starts] // across, cells[starts] % across, counts))
    return tuple(np.concatenate(x) for x in zip(*out))


class _Numbers:
    """A language's numbering in a task: ranked words first, then words that the bit table admits; words
    that it does not admit are remembered as -1."""

    def __init__(self, lang: str, heads: list[Head]):
        self.lang, self.heads = lang, heads
        self.words = list(heads[0].ranked.get(lang, ()))
        self.ranked = len(self.words)
        self.others = {PIECE_MARK: -1, b"": -1}  # numbers of words without a rank
        self.ranked_text = _utf8(self.words)
        self.open = bool(heads[0].table)  # words without a rank may be frequent
        self.hashed = any(h.table for h in heads)
        self.hashes = heads[0].hashes[lang].tolist() if lang in heads[0].hashes else []
        self._text = self._hash = None
        # Each further level's ranked units: their cells, in the order of the ranks, and texts.
        self.levels = []
        for head in heads[1:]:
            keys = head.cells.get(lang, np.empty(0, np.int64))
            self.levels.append((pa.array(keys), _utf8(head.ranked.get(lang, ()))))
        # Units and words that all tasks number alike.
        self.ranked_units = len(heads[-1].ranked.get(lang, ()))

    def text(self) -> pa.Array:
        if self._text is None or len(self._text) != len(self.words):
            self._text = _utf8(self.words)
        return self._text

    def hash(self) -> np.ndarray:
        if self._hash is None or len(self._hash) != len(self.hashes):
            self._hash = np.array(self.hashes, np.uint64)
        return self._hash

    def codes(self, texts: list[bytes]) -> np.ndarray:
        """Word numbers of texts in order, -1 between pieces and for words that are not frequent."""
        coded = _words(texts, _MARKED).dictionary_encode()
        distinct = coded.dictionary
        numbers = np.full(len(distinct), -1, np.int32)
        at = pc.fill_null(pc.index_in(self.ranked_text, value_set=distinct), -1).to_numpy(zero_copy_only=False)
        here = np.flatnonzero(at >= 0)
        numbers[at[here]] = here
        if self.open:
            rest = np.flatnonzero(numbers < 0)
            known = self.others.get
            words = distinct.take(pa.array(rest)).view(pa.binary()).to_pylist()
            numbers[rest] = [self.number(w) if (k := known(w)) is None else k for w in words]
        return numbers[coded.indices.to_numpy()]

    def number(self, word: bytes) -> int:
        """The number of a word that is not ranked: -1 if it is not frequent."""
        h = _word_hash(self.lang, word)
        if self.heads[0].admits_one(h):
            self.others[word] = len(self.words)
            self.words.append(word)
            self.hashes.append(h)
        else:
            self.others[word] = -1
        return self.others[word]

    def forget(self) -> None:
        del self.words[self.ranked :], self.hashes[self.ranked :]
        self._text = self._hash = None
        self.others = {PIECE_MARK: -1, b"": -1}


def _cells_of(numbers: _Numbers, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(unit, word, count) of the distinct phrases of one more word than the last level's units, and the units'
    texts. ``codes``: word numbers in text order, -1 between pieces and for words that are not frequent."""
    codes = codes.astype(np.int64) if numbers.words else codes[:0].astype(np.int64)  # none: no frequent word in this language
    words = numbers.text()
    hashes = numbers.hash() if numbers.hashed else None
    unit, unit_text = codes, words
    unit_hash = None if hashes is None else hashes[codes]
    for level, (keys, text) in enumerate(numbers.levels, start=1):
        n = len(codes) - level  # places where a unit of level + 1 words may start
        n = max(n, 0)
        word = codes[level : level + n]
        ok = (unit[:n] >= 0) & (unit[1 : n + 1] >= 0) & (word >= 0) if level > 1 else (unit[:n] >= 0) & (word >= 0)
        ok = np.flatnonzero(ok)
        cell = unit[ok] << 32 | word[ok]
        rank = pc.fill_null(pc.index_in(pa.array(cell), value_set=keys), -1).to_numpy(zero_copy_only=False)
        after = np.full(n, -1, np.int64)
        after[ok] = rank
        ranked = len(text)
        if hashes is not None:
            unit_hash = _joined(unit_hash[:n], hashes[word])
        if numbers.heads[level].table:
            loose = rank < 0
            loose[loose] = numbers.heads[level].admits(unit_hash[ok[loose]])
            if loose.any():
                cells, local = np.unique(cell[loose], return_inverse=True)
                after[ok[loose]] = local + ranked
                more = pc.binary_join_element_wise(unit_text.take(pa.array(cells >> 32)), words.take(pa.array(cells & 0xFFFFFFFF)), " ")
                text = pa.concat_arrays([text, more])
        unit, unit_text = after, text
    level = len(numbers.levels) + 1
    n = max(len(codes) - level, 0)
    word = codes[level : level + n]
    ok = (unit[:n] >= 0) & (word >= 0)
    if level > 1:
        ok &= unit[1 : n + 1] >= 0
    return *count_cells(unit[:n][ok], word[ok]), unit_text


def _phrases(numbers: _Numbers, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, unit_text: pa.Array) -> pa.RecordBatch:
    phrases = pc.binary_join_element_wise(unit_text.take(pa.array(rows)), numbers.text().take(pa.array(columns)), " ")
    langs = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(counts), np.int32)), pa.array([numbers.lang])).cast(pa.string())
    return pa.RecordBatch.from_arrays([langs, phrases, pa.array(counts, pa.int64())], names=["lang", "phrase", "a"])


def _count_buffer(numbers: _Numbers, codes: np.ndarray) -> pa.RecordBatch:
    """Distinct phrases of one more word than the last level's units, with their counts."""
    return _phrases(numbers, *_cells_of(numbers, codes))


def _number_buffer(numbers: _Numbers, codes: np.ndarray, first: int) -> list[pa.RecordBatch]:
    """The same: phrases of a ranked unit and a ranked word by the unit's number among all languages' units
    (``first``: that of the language's first one) << 32 | the word's, the others as text."""
    rows, columns, counts, unit_text = _cells_of(numbers, codes)
    ranked = (rows < numbers.ranked_units) & (columns < numbers.ranked)
    cells = rows[ranked] + first << 32 | columns[ranked]
    none = pa.nulls(len(cells), pa.string())
    rest = _phrases(numbers, rows[~ranked], columns[~ranked], counts[~ranked], unit_text)
    names = [x.split()[0] for x in _CELLS.split(", ")]
    return [
        pa.RecordBatch.from_arrays([none, none, pa.array(cells), pa.array(counts[ranked], pa.int64())], names=names),
        pa.RecordBatch.from_arrays([rest.column(0), rest.column(1), pa.nulls(rest.num_rows, pa.int64()), rest.column(2)], names=names),
    ]


def _firsts(head: Head) -> dict[str, int]:
    """Each language's first number, where its units are numbered after those of the languages before."""
    langs = sorted(head.ranked)
    return dict(zip(langs, np.cumsum([0, *(len(head.ranked[x]) for x in langs)]).tolist()))


def longer_counts(docs: DataFrame, shared, min_count: int = 1) -> DataFrame:
    """``lang, phrase, a`` of phrases one word longer than the units of the last head in ``shared`` (a
    broadcast list of heads, one a level) that occur ``min_count`` times or more."""

    def count(batches):
        heads, known, buffers = shared.value, {}, {}
        firsts = _firsts(heads[-1])

        def flush(lang):
            numbers = known[lang]
            for out in _number_buffer(numbers, np.concatenate(buffers.pop(lang)), firsts.get(lang, 0)):
                for lo in range(0, out.num_rows, ROWS_OUT):
                    yield out.slice(lo, ROWS_OUT)
            if len(numbers.others) > MOST_LOCAL:
                numbers.forget()

        size = 0
        for lang, texts in _texts(batches):
            if lang not in known:
                known[lang] = _Numbers(lang, heads)
            codes = known[lang].codes(texts)
            buffers.setdefault(lang, []).append(codes)
            size += len(codes)
            if size >= BUFFER_CELLS:
                for x in list(buffers):
                    yield from flush(x)
                if len(known) > MOST_LANGS:
                    known.clear()
                size = 0
        for x in list(buffers):
            yield from flush(x)
        pa.default_memory_pool().release_unused()  # the worker lives on

    def spell(batches):
        words, units = shared.value[0], shared.value[-1]
        firsts, first_words = _firsts(units), _firsts(words)
        langs = sorted(units.ranked)
        starts = np.array([firsts[x] for x in langs])
        word_starts = np.array([first_words.get(x, 0) for x in langs])
        lang_text = pa.array(langs, pa.string())
        unit_text, word_text = (_utf8([u for x in sorted(h.ranked) for u in h.ranked[x]]) for h in (units, words))
        names = [x.split()[0] for x in _COUNTS.split(", ")]
        for batch in batches:
            numbered = pc.is_valid(batch.column(2))
            lang, phrase, _, counts = batch.filter(pc.invert(numbered)).columns
            yield pa.RecordBatch.from_arrays([lang, phrase, counts], names=names)
            _, _, cells, counts = batch.filter(numbered).columns
            if len(cells):
                cell = cells.to_numpy()
                unit, word = cell >> 32, cell & 0xFFFFFFFF
                which = np.searchsorted(starts, unit, side="right") - 1
                phrase = pc.binary_join_element_wise(unit_text.take(pa.array(unit)), word_text.take(pa.array(word_starts[which] + word)), " ")
                yield pa.RecordBatch.from_arrays([lang_text.take(pa.array(which)), phrase, counts], names=names)

    # A task's buffers repeat few cells: they are dealt before any sum.
    dealt = docs.mapInArrow(count, _CELLS).repartition("lang", "phrase", "cell")
    sums = dealt.groupBy("lang", "phrase", "cell").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)
    return sums.select("lang", "phrase", "cell", "a").mapInArrow(spell, _COUNTS)


def frequent_phrases(
    docs: DataFrame,
    lang_col: str,
    text_col: str,
    max_words: int,
    min_count: int,
    head_units: int = HEAD_UNITS,
    head_bytes: int = HEAD_BYTES,
    filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(``lang, phrase, a, words`` of phrases of 1 to ``max_words`` words that occur ``min_count`` times or
    more; ``lang, n``: all word occurrences)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    counts = stored(word_counts(texts), "collocation-words")
    sizes = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    found = [counts.where(F.col("a") >= min_count)]
    heads = [head_of(found[0], [], head_units, head_bytes, filter_bits)]
    for level in range(2, max_words + 1):
        if any(h.table for h in heads) and not heads[0].hashes:
            heads[0].hashes = {lang: np.array([_word_hash(lang, w) for w in words], np.uint64) for lang, words in heads[0].ranked.items()}
        shared = spark.sparkContext.broadcast(heads)
        longer = stored(longer_counts(texts, shared, min_count), f"collocation-{level}")
        shared.destroy()
        found.append(longer)
        if level < max_words:
            head = head_of(longer, heads, head_units, head_bytes, filter_bits)
            head.address(heads)
            heads = [*heads, head]
    whole = found[0].withColumn("words", F.lit(1))
    for level, df in enumerate(found[1:], start=2):
        whole = whole.unionByName(df.withColumn("words", F.lit(level)))
    return whole, sizes


def _parts(words, max_words: int, least: int):
    """Contiguous parts of ``least`` words or more, shorter than the whole, of an array of words."""
    spans = [(s, k) for k in range(least, max_words) for s in range(max_words - k + 1)]
    return F.array_distinct(
        F.filter(
            F.array(*[F.when(F.size(words) >= F.lit(s + k), F.when(F.size(words) > F.lit(k), F.array_join(F.slice(words, s + 1, k), " "))) for s, k in spans]),
            lambda p: p.isNotNull(),
        )
    )


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    *,
    max_words: int = 4,
    min_count: int = 30,
    scale: int = 2_000_000,
    cover_percent: int = 80,
    top: int = 2000,
    **tiling,
) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``score`` is floor(scale * a / (l + r)) of the phrase's lowest-scoring cut in two (ties: smallest first
    part). Phrases inside a longer one that has ``cover_percent`` % of their count are left out. All
    products are taken as 38-digit decimals."""
    whole, sizes = frequent_phrases(docs, lang_col, text_col, max_words, min_count, **tiling)
    words = F.split("phrase", " ")
    candidates = whole.where("words > 1")
    cuts = candidates.select(
        "lang",
        "phrase",
        "a",
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    ).withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn("rest", F.array_join(F.slice(words, F.col("k") + 1, F.lit(max_words)), " "))
    left = whole.select(F.col("lang").alias("_l1"), F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = whole.select(F.col("lang").alias("_l2"), F.col("phrase").alias("rest"), F.col("a").alias("r"))
    valued = (
        cuts.join(left, (F.col("lang") == F.col("_l1")) & (cuts["first"] == left["first"]))
        .join(right, (F.col("lang") == F.col("_l2")) & (cuts["rest"] == right["rest"]))
        .select("lang", "phrase", "a", "k", "l", "r", F.expr(f"CAST({scale} AS DECIMAL(18,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))").alias("score"))
    )
    scored = valued.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = candidates.where("words > 2").select("lang", F.explode(_parts(words, max_words, 2)).alias("phrase"), F.col("a").alias("longer"))
    covers = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    big = lambda c, k: F.col(c).cast("decimal(20,0)") * F.lit(k).cast("decimal(10,0)")
    kept = scored.join(covers, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (big("longer", 100) < big("a", cover_percent)))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # One row a language.
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("int").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").cast("bigint").alias("score")
    )
