"""Token ids in length-delimited binary records, with an offset index beside them.

A record file is a sequence of frames, each made of the payload's length (8 bytes, little endian), a
masked CRC-32C of those 8 bytes, the payload, and a masked CRC-32C of the payload. The payload is one
document: a flag byte (bit 0: the id is known; bit 1: 4-byte token ids, else 2-byte ones), the id
(8 bytes) and the token ids, little endian.

``write_records`` puts the documents in ascending id order by a range partitioning (the work is split
evenly whatever the ids), encodes and writes in tasks, and stores the **index**: per document the file,
the frame's offset and length, and the number of ids. Each attempt of a task writes files of its own,
and only those that the stored index names count, so lost executors and retries leave nothing wrong;
a file is closed at ``FILE_BYTES``. A shuffled read takes index rows in any order and fetches frames
by offset (``read_at``); ``read_records`` goes through whole files.

Encoding keeps a cache of words, since words repeat: where blanks always end a token, a text's ids are
the ids of its words in turn. So too where marks after a word, or the case of letters, do not change how
the word is split. Each of these is tried out on the tokenizer at hand
(``_holds``) before it is used; a tokenizer that merges across blanks is refused. The cache holds the parts
that words are cut into, lives as long as the Python worker, is bounded, and only saves time.

Defined results: null and empty texts have no ids but the end id. Null ids sort first. Rows that
repeat an id are ordered by text and each get a record. An empty table gives an empty index. Extra
columns are ignored.
"""

from __future__ import annotations

import functools
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import filesystem, new_file, stored
from tablewatch.session import scratch_path

FILE_BYTES = 128 << 20
CACHED_WORDS, CACHED_BYTES = 600_000, 32 << 20
MARKS = ".,;:!?#$%&*"  # tried out as marks that start a token after a letter
_HEAD, _CRC = struct.Struct("<Q"), struct.Struct("<I")
_PREFIX = struct.Struct("<Bq")
GROUP = 256  # documents checked at a time
GROUP_BYTES = 2 << 20  # of text, encoded and framed at a time (a longer document makes a group of its own)


# --- CRC-32C (Castagnoli), over whole arrays -----------------------------------------------------

_POLY = 0x82F63B78
_CHUNK = 64


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(_POLY), t >> 1)
    return t


def _zeros_after(table: np.ndarray, register: np.ndarray) -> np.ndarray:
    return (register >> np.uint32(8)) ^ table[register & np.uint32(255)]


class _Crc:
    """A CRC register is linear in the message, so bytes act apart: ``place[i][b]`` is what byte b does
    when i bytes follow it, and ``shift`` moves a register past ``_CHUNK * 2**k`` zero bytes."""

    def __init__(self):
        table = _byte_table()
        self.place = [table]
        for _ in range(_CHUNK - 1):
            self.place.append(_zeros_after(table, self.place[-1]))
        basis = (np.uint32(1) << np.arange(32, dtype=np.uint32)).astype(np.uint32)
        for _ in range(_CHUNK):
            basis = _zeros_after(table, basis)
        self.shifts = [self._tables(basis)]
        for _ in range(40):
            basis = self._move(self.shifts[-1], basis)
            self.shifts.append(self._tables(basis))

    @staticmethod
    def _tables(basis: np.ndarray) -> list[np.ndarray]:
        """Four tables of 256: the map's value for each byte of the register."""
        out = []
        for k in range(4):
            t = np.zeros(256, np.uint32)
            for bit in range(8):
                t ^= np.where(np.arange(256) >> bit & 1, basis[8 * k + bit], 0).astype(np.uint32)
            out.append(t)
        return out

    @staticmethod
    def _move(tables: list[np.ndarray], r: np.ndarray) -> np.ndarray:
        out = tables[0][r & np.uint32(255)]
        for k in (1, 2, 3):
            out = out ^ tables[k][(r >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def short(self, data: bytes) -> int:
        r = 0xFFFFFFFF
        for b in data:
            r = (r >> 8) ^ int(self.place[0][(r ^ b) & 255])
        return r ^ 0xFFFFFFFF

    def many(self, blobs: list[bytes]) -> list[int]:
        """Blobs of like size are laid out as one array, padded in front: zero bytes there do not change
        a register of zero, and the start value is XORed into the first four bytes."""
        out, alike = [0] * len(blobs), {}
        for k, blob in enumerate(blobs):
            if len(blob) < 4:
                out[k] = self.short(blob)
            else:
                alike.setdefault(((len(blob) - 1) // _CHUNK).bit_length(), []).append(k)
        for level, which in alike.items():
            width = _CHUNK << level
            rows = np.zeros((len(which), width), np.uint8)
            for row, k in zip(rows, which):
                row[width - len(blobs[k]) :] = np.frombuffer(blobs[k], np.uint8)
                row[width - len(blobs[k]) : width - len(blobs[k]) + 4] ^= 255
            parts = rows.reshape(-1, _CHUNK)
            r = np.zeros(len(parts), np.uint32)
            for i in range(_CHUNK):
                r ^= self.place[_CHUNK - 1 - i][parts[:, i]]
            for shift in self.shifts[:level]:
                r = self._move(shift, r[0::2]) ^ r[1::2]
            for k, c in zip(which, r.tolist()):
                out[k] = c ^ 0xFFFFFFFF
        return out


@functools.cache
def _crc() -> _Crc:
    return _Crc()


def _masked(c: int) -> int:
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame_all(payloads: list[bytes]) -> list[bytes]:
    out = []
    for payload, c in zip(payloads, _crc().many(payloads)):
        head = _HEAD.pack(len(payload))
        out.append(b"".join((head, _CRC.pack(_masked(_crc().short(head))), payload, _CRC.pack(_masked(c)))))
    return out


def unframe_all(frames: list[bytes]) -> list[bytes]:
    """The payloads of whole frames; raises if anything in one was changed."""
    payloads = []
    for data in frames:
        n = payload_length(data[:12])
        if len(data) != n + 16:
            raise ValueError("record is cut off")
        payloads.append(data[12 : 12 + n])
    for data, c in zip(frames, _crc().many(payloads)):
        if _CRC.unpack_from(data, len(data) - 4)[0] != _masked(c):
            raise ValueError("record data is damaged")
    return payloads


def payload_length(head: bytes) -> int:
    """From a frame's first 12 bytes."""
    if len(head) < 12 or _CRC.unpack_from(head, 8)[0] != _masked(_crc().short(head[:8])):
        raise ValueError("record length is damaged")
    return _HEAD.unpack_from(head)[0]


# --- Encoding ------------------------------------------------------------------------------------


class WordCache:
    """Ids by word, as Arrow strings and flat arrays: some 50 bytes a word. When there are more than ``room``
    words, or more bytes of words and ids than ``room_bytes``, the half used last stays; a word of more than a
    thousandth of the bytes does not."""

    def __init__(self, room: int, room_bytes: int):
        self.room, self.room_bytes, self.turn = room, room_bytes, 0
        self.words, self.ids = pa.array([], pa.string()), np.empty(0, np.uint32)
        self.starts, self.sizes, self.used = (np.empty(0, np.int64) for _ in range(3))

    def find(self, words: pa.Array) -> np.ndarray:
        """Place of each of some distinct words; -1: not here. They make the hash table and the cache is
        looked up in it, so the table stays small."""
        places = np.full(len(words), -1, np.int64)
        if len(words) and len(self.words):
            at = pc.fill_null(pc.index_in(self.words, value_set=words), -1).to_numpy(zero_copy_only=False)
            here = np.flatnonzero(at >= 0)
            places[at[here]] = here
            self.used[here] = self.turn
        return places

    def add(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Add words that are not here; returns their places."""
        places = np.arange(len(self.words), len(self.words) + len(words))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.words, self.ids = pa.concat_arrays([self.words, words]), np.concatenate([self.ids, ids])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.used = np.concatenate([self.used, np.full(len(words), self.turn)])
        return places

    def tidy(self) -> None:
        """To be called between uses: places change."""
        self.turn += 1
        if len(self.words) <= self.room and self.words.nbytes + self.ids.nbytes <= self.room_bytes:
            return
        weight = pc.binary_length(self.words).to_numpy(zero_copy_only=False) + self.ids.itemsize * self.sizes
        short = np.flatnonzero(weight <= self.room_bytes // 1000)
        last = short[np.argsort(-self.used[short], kind="stable")][: self.room // 2]
        kept = np.sort(last[np.cumsum(weight[last]) <= self.room_bytes // 2])
        ids = self.ids[_spans(self.starts[kept], self.sizes[kept])]
        words, sizes, used = self.words.take(pa.array(kept)), self.sizes[kept], self.used[kept]
        self.words, self.ids, self.sizes, self.used, self.starts = words, ids, sizes, used, np.cumsum(sizes) - sizes


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all spans in turn."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def _joined(words: pa.Array) -> str:
    """Words without blanks as one string with blanks between."""
    return pc.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), " ")[0].as_py()


def _strings(words: pa.Array) -> list[str]:
    """Words without blanks as a list; one string is made and split, which is quicker than one by one."""
    return _joined(words).split(" ") if len(words) else []


def _odd(text: str) -> bool:
    """Whether some words may not be cut or put in lower case: other than composed letters with one lower-case
    form each, or a special token's name."""
    return not text.isascii() and (not unicodedata.is_normalized("NFC", text) or "\u03a3" in text or "\u0130" in text) or "<|" in text


def _odd_words(words: pa.Array, joined: str) -> np.ndarray:
    odd = np.zeros(len(words), bool)
    if _odd(joined):
        for i in range(0, len(words), 1024):
            part = words.slice(i, 1024)
            if _odd(_joined(part)):
                odd[i : i + 1024] = [_odd(w) for w in _strings(part)]
    return odd


class WordCachedEncoder:
    """Token ids of texts by a tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), WordCache(CACHED_WORDS, CACHED_BYTES)
        words = ["Alpha", "beta's", "42", "ñandú!?", "x", "ÉCOLE"]
        blanks = (" ", "\n", "\t", "\r\n", "\x0b", "\x0c", "  ")
        if not all(self._holds(words, s.join(words) + s) for s in blanks):
            raise ValueError(f"{path}: blanks do not end tokens, so words cannot be encoded one by one")
        runs = [x for m in MARKS for x in ("École", m, "Alpha", m + "*" + m)]
        self.marks_apart = self._holds(runs, " ".join(a + m for a, m in zip(runs[::2], runs[1::2])))
        self.any_case = self._holds([w.lower() for w in words], " ".join(words))
        bar = self._encode("|")
        self.bar = bar[0] if len(bar) == 1 and self._holds(["x", "|", "42", "|", "beta's"], "x | 42 | beta's") else None

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _holds(self, words: list[str], text: str) -> bool:
        """Whether the text's ids are the words' in turn."""
        return self._encode(text) == [i for w in words for i in self._encode(w)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        ids, ends = self.encode_all(pa.array(texts, pa.string()))
        return np.split(ids, ends[:-1]) if len(ends) else []

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in turn, where each text's ids end). Each distinct word of the texts is cut
        and its parts looked up once; the ids are then gathered by position."""
        self.known.tidy()
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        parts = self._split(coded.dictionary).dictionary_encode()
        places = self._places(parts.dictionary)[parts.indices.to_numpy()]
        # The distinct words' ids, two parts each, then the texts'.
        sizes = self.known.sizes[places]
        distinct = self.known.ids[_spans(self.known.starts[places], sizes)]
        sizes = sizes[0::2] + sizes[1::2]
        starts = np.cumsum(sizes) - sizes
        taken = sizes[which]
        after = np.concatenate([[0], np.cumsum(taken)])
        ends = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
        return distinct[_spans(starts[which], taken)], after[ends]

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where ``known`` has each of some distinct words; those it does not have are encoded and added."""
        places = self.known.find(words)
        new = np.flatnonzero(places < 0)
        if len(new):
            order, ids, sizes = self._encode_words(_strings(words.take(pa.array(new))))
            places[new[order]] = self.known.add(words.take(pa.array(new[order])), ids, sizes)
        return places

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, ids, sizes): the words' ids in that order of the words, and their number by word. Words go to
        the tokenizer many at a time, a bar between, where the bar's id marks the ends."""
        alone = [i for i, w in enumerate(words) if self.bar is None or "|" in w]
        joined = [i for i, w in enumerate(words) if "|" not in w] if self.bar is not None else []
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for i in range(0, len(joined), 64):
            group = joined[i : i + 64]
            found = np.array(self._encode(" | ".join([words[k] for k in group])), np.uint32)
            bars = found == self.bar
            ends = np.concatenate([[-1], np.flatnonzero(bars), [len(found)]])
            if len(ends) != len(group) + 1:
                raise ValueError("the tokenizer did not keep words apart")
            ids.append(found[~bars])
            sizes.append(np.diff(ends) - 1)
        for i in range(0, len(alone), 4096):
            for e in self.tokenizer.encode_batch([words[k] for k in alone[i : i + 4096]], add_special_tokens=False):
                ids.append(np.array(e.ids, np.uint32))
                sizes.append(np.array([len(e.ids)]))
        return np.array(joined + alone, np.int64), np.concatenate(ids), np.concatenate(sizes)

    def _split(self, words: pa.Array) -> pa.Array:
        """Two parts of each word, in turn, whose ids in turn are the word's: the core, without the marks at the
        word's end and in lower case, and those marks; both may be empty."""
        if not len(words):
            return words
        joined = _joined(words)
        odd = _odd_words(words, joined)
        whole = pc.split_pattern(pa.array([joined.lower()]), " ").flatten() if self.any_case else words
        if odd.any():
            whole = pc.if_else(pa.array(odd), words, whole)
        kept = size = pc.binary_length(whole).to_numpy(zero_copy_only=False)
        if self.marks_apart:
            bare = pc.ascii_rtrim(whole, characters=MARKS)
            marked = np.flatnonzero((pc.binary_length(bare).to_numpy(zero_copy_only=False) < size) & ~odd)
            last = pc.utf8_slice_codeunits(bare.take(pa.array(marked)), -1, None).dictionary_encode()
            alpha = np.array([c.isalpha() for c in last.dictionary.to_pylist()], bool)[last.indices.to_numpy()]
            cut, kept = marked[alpha], size.copy()
            kept[cut] = pc.binary_length(bare).to_numpy(zero_copy_only=False)[cut]
        _, offsets, data = whole.buffers()
        starts = np.frombuffer(offsets, np.int32)[whole.offset : whole.offset + len(whole) + 1]
        cuts = np.empty(2 * len(whole) + 1, np.int32)
        cuts[0::2], cuts[1::2] = starts, starts[:-1] + kept
        return pa.StringArray.from_buffers(2 * len(whole), pa.py_buffer(cuts), data)


@functools.cache
def _encoder(path: str) -> WordCachedEncoder:
    return WordCachedEncoder(path)


# --- Writing and reading -------------------------------------------------------------------------

INDEX = "doc_id long, file string, offset long, length long, n_tokens long, place int, row long"


def _groups(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch (doc_id, text) by the bytes of text."""
    before = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < b.num_rows:
        base = before[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(before, base + GROUP_BYTES, side="right")))
        yield b.slice(start, stop - start)
        start = stop


def _writer(folder: str, tokenizer: str, end_id: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        end = np.empty(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)

        def records() -> Iterator[tuple[int | None, int, bytes]]:
            for b in batches:
                for group in _groups(b):
                    doc_ids, counts, payloads, start = group.column(0).to_pylist(), [], [], 0
                    flat, ends = encoder.encode_all(group.column(1))
                    for doc_id, stop in zip(doc_ids, ends.tolist()):
                        ids, start = np.concatenate([flat[start:stop], end]), stop
                        counts.append(len(ids))
                        payloads.append(payload(doc_id, ids))
                    yield from zip(doc_ids, counts, frame_all(payloads))

        rows = records()
        row, pending = 0, next(rows, None)
        while pending is not None:
            index, at = [], 0
            with new_file(folder, f"part-{part:05d}-{row:012d}", ".records") as (out, name):
                while pending is not None and at < FILE_BYTES:
                    doc_id, count, data = pending
                    out.write(data)
                    index.append((doc_id, name, at, len(data), count, part, row))
                    at, row = at + len(data), row + 1
                    pending = next(rows, None)
            for k in range(0, len(index), 10_000):
                columns = list(zip(*index[k : k + 10_000]))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in INDEX.split(", ")])
        pa.default_memory_pool().release_unused()  # the worker lives on

    return run


def write_records(docs: DataFrame, tokenizer: str, end_id: int | None = 1, folder: str | None = None) -> tuple[str, DataFrame]:
    """(folder, stored index). The index's (place, row) ascend with the documents' order."""
    folder = folder or scratch_path(docs.sparkSession, "token-records")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The text's hash spreads an id that many rows repeat over several ranges.
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    return folder, stored(ordered.mapInArrow(_writer(folder, tokenizer, end_id), INDEX), "token-index")


def payload(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) >= 1 << 16
    return _PREFIX.pack((doc_id is not None) | wide << 1, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = _PREFIX.unpack_from(payload)
    return (doc_id if flags & 1 else None), np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=_PREFIX.size)


def read_at(folder: str, file: str, places: list[tuple[int, int]]) -> Iterator[tuple[int | None, np.ndarray]]:
    """The documents of one file at the given (offset, length) places, in the order asked."""
    fs, root = filesystem(folder)
    with fs.open_input_file(f"{root}/{file}") as f:
        for offset, length in places:
            yield parse(unframe_all([f.read_at(length, offset)])[0])


def read_file(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of each frame of an open file, checked."""
    at, offsets, group = 0, [], []
    while head := stream.read(12):
        data = head + stream.read(payload_length(head) + 4)
        offsets.append(at)
        group.append(data)
        at += len(data)
        if len(group) == GROUP:
            yield from zip(offsets, unframe_all(group))
            offsets, group = [], []
    yield from zip(offsets, unframe_all(group))


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(file, offset, doc_id, n_tokens, ids_crc32) of every record in the files the index names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for b in batches:
            for file in b.column(0).to_pylist():
                with fs.open_input_stream(f"{root}/{file}", buffer_size=1 << 20) as f:
                    rows = []
                    for at, payload in read_file(f):
                        doc_id, ids = parse(payload)
                        rows.append((file, at, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                for k in range(0, len(rows), 10_000):
                    columns = zip(*rows[k : k + 10_000])
                    kinds = [pa.string(), *[pa.int64()] * 4]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["file", "offset", "doc_id", "n_tokens", "ids_crc32"])

    # Dealt in turn, not by the file: with as many files as shuffle partitions, Spark would drop an exchange
    # by the file after the distinct, merge its few bytes and read all files in one task.
    files = index.select("file").distinct()
    spread = files.repartition(max(1, min(files.count(), 10_000)))
    return spread.mapInArrow(run, "file string, offset long, doc_id long, n_tokens long, ids_crc32 long")


def with_starts(index: DataFrame) -> DataFrame:
    """``index`` with ``start``: the ids of all documents before. The sum runs over the partitions'
    totals (one row each), then within partitions."""
    totals = index.groupBy("place").agg(F.sum("n_tokens").alias("_all"))
    before = Window.partitionBy(F.lit(0)).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("place", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("place").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(offsets, "place").withColumn(
        "start", F.col("_before") + F.col("_inside")
    ).drop("_before", "_inside")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): written, then read back from the files."""
    folder, index = write_records(docs, tokenizer, end_id)
    starts = with_starts(index).select("file", "offset", "start")
    # One row per document on both sides: Spark's estimate from the compressed index must not broadcast it.
    return read_records(index, folder).join(starts.hint("merge"), ["file", "offset"]).select("doc_id", "start", "n_tokens", "ids_crc32")
