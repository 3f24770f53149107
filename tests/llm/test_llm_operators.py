"""Odd input for every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import io
import random
import zipfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewatch.llm import bm25, column_bwt, components, cover_tree, mix, parity_join, preference, token_records, toxicity, url_trie, zip_warc
from tablewatch.llm.queries import benchmark_items, tokenizer_path
from test_llm_queries import brute_components, brute_repeats

DOC = "doc_id long, text string, source string, `_key` string, SIZE int"
LONG = " ".join(f"w{i}" for i in range(30_000))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], DOC)


ODD = [(1, None, "a"), (2, "", None), (None, "one two three", "a"), (4, "one two three", "b"), (4, "one two three", "b"),
       (5, "  \t ", "a"), (6, LONG, "a"), (7, LONG + " end", "b"), (8, "A b", None), (9, "a B", "c")]


def test_url_rules(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("example.com", "/en/", "allow"), ("a.example.com", "", "allow"), ("example.com", "/e", "block")]
    urls = ["http://EXAMPLE.com/en/x?q", "https://a.example.com/en/", "http://example.com/en", "http://b.org/", None, "nothing", "http://example.com", "http://xexample.com/en/", "http://u?a=http://example.com/en/"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "id int, url string, _match string")
    for size in (100, 1):
        got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in url_trie.filter_urls(df, "url", rules, max_rules_per_trie=size).collect()}
        assert got == {
            0: ("example.com", "/en/x", "example.com/en/", "block"), 1: ("a.example.com", "/en/", "a.example.com", "allow"),
            2: ("example.com", "/en", "example.com/e", "block"), 3: ("b.org", "/", None, "allow"), 4: ("", "", None, "allow"),
            5: ("", "", None, "allow"), 6: ("example.com", "", None, "allow"), 7: ("xexample.com", "/en/", "com/", "allow"), 8: ("u", "", None, "allow"),
        }
    with pytest.raises(ValueError):
        url_trie.filter_urls(df.withColumn("HOST", F.lit(1)), "url", rules)


def test_crc_and_frames():
    def slow(data):
        r = 0xFFFFFFFF
        for b in data:
            r ^= b
            for _ in range(8):
                r = (r >> 1) ^ (0x82F63B78 if r & 1 else 0)
        return r ^ 0xFFFFFFFF

    blobs = [random.Random(n).randbytes(n) for n in [*range(0, 140), 1000, 4097]]
    assert token_records._crc().many(blobs) == [slow(b) for b in blobs]
    assert token_records._crc().many([b"123456789"]) == [0xE3069283]
    frames = token_records.frame_all(blobs)
    assert token_records.unframe_all(frames) == blobs
    assert [p for _, p in token_records.read_file(io.BytesIO(b"".join(frames)))] == blobs
    for k in (3, 9, 20, len(frames[-1]) - 1):
        broken = bytearray(frames[-1])
        broken[k] ^= 1
        with pytest.raises(ValueError):
            token_records.unframe_all([bytes(broken)])


def test_word_cache_changes_no_id():
    from tokenizers import Tokenizer

    plain, cached = Tokenizer.from_file(tokenizer_path()), token_records.WordCachedEncoder(tokenizer_path())
    texts = ["", " ", "a\x1cb ́c d <|endoftext|>x ΣΑΣ İ  q", "It's. We'll, go... A,. B.,C x.\n1. 2, É. ǅ. ß. ẞ, Ǆ K. Å.", "don't. x_. _. a1. a²,\t\x0bq\r\n", "<|ENDOFTEXT|> é. É,"]
    texts += ["".join(random.Random(s).choices("aB.,'é \n!1Σ<|#$%", k=60)) for s in range(400)]
    assert [list(x) for x in cached.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_records_odd_rows(spark, scratch):
    folder, index = token_records.write_records(docs(spark, ODD), tokenizer_path(), 1, scratch("records"))
    rows = index.orderBy("place", "row").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 4, 4, 5, 6, 7, 8, 9]
    shuffled = random.Random(1).sample(rows, len(rows))
    for r in shuffled:
        doc_id, ids = next(token_records.read_at(folder, r.file, [(r.offset, r.length)]))
        assert doc_id == r.doc_id and len(ids) == r.n_tokens and ids[-1] == 1
    assert token_records.token_digests(docs(spark, []), tokenizer_path()).count() == 0


def test_token_records_read_in_several_tasks(spark, scratch):
    from pyspark.sql import functions as F

    folder, parts = scratch("spread"), []
    for part in range(4):
        rows = [(k, f"words of text {k}", None) for k in range(part, 40, 4)]
        parts.append(token_records.write_records(docs(spark, rows), tokenizer_path(), 1, folder)[1])
    index = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(index.select("file").distinct().count()))
    try:
        read = token_records.read_records(index, folder).withColumn("_task", F.spark_partition_id())
        files, tasks, rows = read.select(F.count_distinct("file"), F.count_distinct("_task"), F.count("*")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows == 40
    assert files >= 4 and tasks > 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 55), (70, 70)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 55: 50, 60: 50}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 60)])
def test_parity_join_equals_brute_force(spark, n, percent):
    r = random.Random(percent)
    base = [[r.choice("abcdefghijklmnop") * r.randint(1, 3) for _ in range(r.randint(1, 90))] for _ in range(30)]
    rows = []
    for i in range(400):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            w[r.randrange(len(w))] = r.choice("xyz")
        rows.append((i, " ".join(w)))
    got = parity_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute_components(rows, n, percent)


def test_parity_join_odd_rows(spark):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in parity_join.jaccard_components(docs(spark, ODD), 3, 90).collect())
    assert got == Counter({(1, 0, 1): 1, (2, 0, 2): 1, (None, 1, 4): 1, (4, 1, 4): 2, (5, 0, 5): 1, (6, 29998, 6): 1, (7, 29999, 6): 1, (8, 1, 8): 1, (9, 1, 8): 1})
    assert parity_join.jaccard_components(docs(spark, []), 3, 90).count() == 0
    kept = parity_join.one_of_each_group(docs(spark, ODD))
    assert kept.columns == docs(spark, ODD).columns
    assert Counter(len((r.text or "").split()) for r in kept.collect()) == Counter({0: 3, 3: 1, 2: 1, len(LONG.split()): 1}) or kept.count() == 6


def test_toxicity_odd_rows(spark):
    rows = [(i, "you idiot scum" if i % 2 else "what a lovely day", "a") for i in range(40)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(0, 1, 0), (99, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs(spark, rows), labels)
    got = toxicity.score_toxicity(docs(spark, ODD + rows), model).collect()
    assert len(got) == len(ODD) + 40 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.predicted for r in got[-20:] if r.doc_id % 2 == 0} .keys()
    assert [r for r in got if r.doc_id is None][0].held_out is False
    assert toxicity.score_toxicity(docs(spark, []), toxicity.train(docs(spark, []), labels.limit(0))).count() == 0
    clean = toxicity.without_toxic(docs(spark, ODD), model)
    assert clean.columns == docs(spark, ODD).columns


def plain_places(text):
    """The distinct places of a text's n-grams, one n-gram at a time."""
    places, text = set(), (text or "").lower()
    for n in toxicity.NGRAMS:
        for i in range(len(text) - n + 1):
            h = n
            for c in text[i : i + n]:
                h = (h * 0x01000193 + ord(c)) % 2**32
            h ^= h >> 15
            places.add((h * 0x9E3779B1) % 2**32 >> (32 - toxicity.BITS))
    return places


def test_toxicity_equals_brute_force(spark):
    r = random.Random(9)
    common, bad = [f"word{i}" for i in range(30)], ["vile", "scum", "idiots"]
    rows = [(i, " ".join(r.choices(common, k=12) + (r.choices(bad, k=2) if i % 4 == 0 else [])), "a") for i in range(240)]
    learn = [(t, int(i % 4 == 0)) for i, t, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, *_ in rows], "doc_id long, toxic int")
    assert sorted(map(tuple, toxicity.training_rows(docs(spark, rows), labels, 1000).collect())) == sorted(learn)
    model = toxicity.train(docs(spark, rows), labels)
    seen, n = Counter(), Counter(y for _, y in learn)
    for text, y in learn:
        seen.update((p, y) for p in plain_places(text))
    ratio = {p: np.log((seen[p, 1] + 1) / (n[1] + 2)) - np.log((seen[p, 0] + 1) / (n[0] + 2)) for p, _ in seen if seen[p, 0] + seen[p, 1] >= toxicity.MIN_ROWS}
    used = np.flatnonzero(model.weights)
    assert len(used) and all(abs(ratio[p]) >= min(toxicity.WEAK) for p in used)
    # The fitted weights are a minimum of the regression on the ratio-scaled features, for one of the choices.
    x = np.array([[ratio[p] if p in places else 0.0 for p in used] for places in (plain_places(t) for t, _ in learn)])
    w = np.array([model.weights[p] / ratio[p] for p in used])
    off = 1 / (1 + np.exp(-(x @ w + model.bias))) - np.array([y for _, y in learn])
    assert min(np.abs(off @ x + l2 * w).max() for l2 in toxicity.L2) < 0.01 and abs(off.sum()) < 0.01
    everything = rows + ODD
    expected = sorted(round(1 / (1 + np.exp(-(sum(float(model.weights[p]) for p in plain_places(t)) + model.bias))), 6) for _, t, _ in everything)
    got = toxicity.score_toxicity(docs(spark, everything), model).collect()
    assert np.allclose(sorted(g.score for g in got), expected, atol=2e-6)
    assert {g.doc_id: g.predicted for g in got if g.doc_id is not None and g.doc_id >= 10} == {i: int(i % 4 == 0) for i, *_ in rows if i >= 10}


def test_wand_retrieves_what_brute_force_does():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(80)]
    index = bm25.Bm25Index([bm25.Item(i, r.choices(vocabulary, k=r.randint(1, 30)), r.choices(vocabulary, k=3)) for i in range(120)])
    for _ in range(100):
        terms = sorted({index.term[w] for w in r.choices(vocabulary, k=25) if w in index.term})
        scores = np.zeros(len(index.items))
        for t in terms:
            scores[index.docs[t]] += index.impacts[t]
        for threshold in (0.05, 0.3, 0.6):
            assert {i for i, _ in index.retrieve(terms, threshold)} == set(np.flatnonzero(scores >= threshold - 1e-9))


def test_leaks_odd_rows(spark):
    item = "Which river runs through the old town of the northern valley. The answer is the grey one."
    items = spark.createDataFrame([(1, item[:62], item[62:]), (2, None, ""), (3, item[:62], item[62:])], "item_id long, question string, answer string")
    rows = ODD + [(20, f"{LONG} {item.upper()} {LONG}", "a"), (21, item[:62], "a"), (21, item, None)]
    got = Counter((r.doc_id, r.item_id) for r in bm25.find_leaks(docs(spark, rows), items).collect())
    assert got == Counter({(20, 1): 1, (20, 3): 1, (21, 1): 1, (21, 3): 1})
    assert bm25.without_leaks(docs(spark, rows), items).count() == len(rows) - 2
    assert bm25.find_leaks(docs(spark, rows), items.limit(0)).count() == 0 and bm25.find_leaks(docs(spark, []), items).count() == 0


def test_edited_copies_are_leaks(spark):
    benchmark = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").where("item_id < 40")
    items = benchmark_items(benchmark)
    rows, expected = [], set()
    for r in items.collect():
        question, answer = bm25.words_of(r.question), bm25.words_of(r.answer)
        whole = question + answer
        copies = [whole[:k] + ["changed"] + whole[k + 1 :] for k in range(len(whole))]
        copies += [[f"changed{k}" if k % 10 == 4 else w for k, w in enumerate(whole)]]
        copies += [question] if len(answer) <= 0.3 * len(whole) else []
        for words in copies:
            expected.add((len(rows), r.item_id))
            rows.append((len(rows), " ".join(["before", *words, "after"]), "a"))
    assert len(expected) > 1000
    assert {(r.doc_id, r.item_id) for r in bm25.find_leaks(docs(spark, rows), items).collect()} == expected
    assert bm25.without_leaks(docs(spark, rows), items).count() == 0


def test_leaks_do_not_depend_on_how_the_items_are_cut(spark, monkeypatch):
    benchmark = benchmark_items(spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").where("item_id < 60"))
    rows = []
    for r in benchmark.orderBy("item_id").collect():
        words = bm25.words_of(r.question) + bm25.words_of(r.answer)
        rows += [(len(rows) + i, " ".join(["before", *part, "after"]), "a") for i, part in enumerate((words, words[: len(words) * 2 // 3], words[len(words) // 3 :], words[::2]))]

    def found():
        got = bm25.find_leaks(docs(spark, rows), benchmark, threshold=0.3, question_overlap=0.2, answer_overlap=0.2).collect()
        return sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in got), bm25.without_leaks(docs(spark, rows), benchmark).count()

    whole = found()
    monkeypatch.setattr(bm25, "ITEMS_PER_INDEX", 7)
    assert len(list(bm25.indexes(benchmark))) > 5
    assert found() == whole and len(whole[0]) > 60


@pytest.mark.parametrize("length", [3, 4, 6, 7, 12])
def test_one_changed_word_leaves_enough_of_a_short_item(length):
    item, filler = [f"w{i}" for i in range(length)], [f"f{i}" for i in range(100)]
    for k in range(length):
        assert bm25._whole(item, filler + item[:k] + ["changed"] + item[k + 1 :] + filler) >= bm25.WHOLE_OVERLAP
    assert bm25._whole(item, [w for i in item for w in (i, *filler)]) < bm25.WHOLE_OVERLAP


def test_preferences(spark):
    kind = "pair_id long, turn int, role string, text string, part string"
    chosen = spark.createDataFrame([(1, 0, "user", "hi", "z"), (1, 1, "assistant", "good", "z"), (2, 0, "user", None, "z"), (3, 0, None, "x", "z"), (None, 0, "user", "q", "z")], kind)
    rejected = spark.createDataFrame([(1, 0, "user", "hi", "z"), (1, 1, "assistant", "bad", "z"), (1, 2, "user", "oh", "z"), (2, 0, "user", None, "z")], kind)
    got = {(r.pair_id, r.part, r.position): (r.rendered, r.start, r.masked) for r in preference.format_preferences(chosen, rejected).collect()}
    assert got == {
        (1, "prompt", 1): ("<|user|>\nhi<|end|>\n", 0, True), (1, "chosen", 2): ("<|assistant|>\ngood<|end|>\n", 0, False),
        (1, "rejected", 2): ("<|assistant|>\nbad<|end|>\n", 0, False), (1, "rejected", 3): ("<|user|>\noh<|end|>\n", 25, True),
        (2, "prompt", 1): ("<|user|>\n<|end|>\n", 0, True), (3, "chosen", 1): ("<||>\nx<|end|>\n", 0, True),
    }
    assert preference.format_preferences(chosen.limit(0), rejected.limit(0)).count() == 0


@pytest.mark.parametrize("length", [3, 5, 8])
def test_column_bwt_core(length):
    r = random.Random(length)
    for _ in range(25):
        texts = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 30))) for _ in range(r.randint(1, 12))]
        seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
        expected = [[i for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1] for t in texts]
        assert [x.tolist() for x in column_bwt.repeated_starts(texts, length)] == expected


@pytest.mark.parametrize("crowd", [8192, 1])
def test_repeats_odd_rows(spark, monkeypatch, crowd):
    monkeypatch.setattr(column_bwt, "CROWD", crowd)
    r = random.Random(2)
    passage = "".join(r.choices("abcdé ", k=450))
    other = lambda n: "".join(r.choices("fghijü ", k=n))
    rows = [(1, None), (2, ""), (3, "short"), (4, "x" * 1500), (5, other(90) + passage + other(300)), (6, passage[:300] + other(20) + passage[300:]), (7, other(200) + passage[40:]), (8, other(700)), (9, "ab" * 99 + "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1))
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in column_bwt.remove_repeats(frame).collect()}
    assert got == brute_repeats(rows)
    same = spark.createDataFrame([(1, passage), (1, passage), (None, other(400)), (None, other(400))], "doc_id long, text string")
    assert Counter((x.doc_id, x.n_removed > 0) for x in column_bwt.remove_repeats(same).collect()) == Counter({(1, True): 2, (None, False): 2})
    assert column_bwt.remove_repeats(frame.limit(0)).count() == 0


def test_long_texts_in_pieces(spark, monkeypatch):
    text = "".join(random.Random(4).choices("abcdefgh ", k=6000))
    rows = [(1, text[:4000]), (2, text[3000:])]
    whole = brute_repeats(rows)
    data = np.frombuffer(text.encode(), np.uint8)
    assert len(column_bwt.windows(data, column_bwt.Hashes(data, *column_bwt.powers_for(len(data))))[0]) > 20
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in column_bwt.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == whole


def test_mix_odd_rows(spark):
    rows = ODD + [(100 + i, "w " * (i % 7), f"s{i % 4}") for i in range(300)]
    got = mix.mix_sources(docs(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    again = mix.mix_sources(docs(spark, list(reversed(rows)))).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    taken, target, longest = Counter(), {}, Counter()
    for r in mix.with_times(docs(spark, rows)).select("source", "_mix.*").collect():
        taken[r.source] += r.times * r.size
        target[r.source] = r.target
        longest[r.source] = max(longest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in target)
    repeated = mix.repeat_mixed(docs(spark, rows))
    assert repeated.columns == docs(spark, rows).columns and repeated.count() == sum(r.times for r in got)
    assert mix.mix_sources(docs(spark, [])).count() == 0
    odd = docs(spark, [(i, "a b", "s") for i in range(50)] + [(90, "c d", "t")])
    weights = F.when(F.col("doc_id") % 3 == 0, F.lit(None)).when(F.col("doc_id") % 3 == 1, F.lit(-1.0)).otherwise(F.lit(float("nan")))
    assert mix.mix_sources(odd, quality=weights).count() == 51


def test_targets_stop_at_the_limit(spark):
    sources = spark.createDataFrame([("a", 900, 1.0), ("b", 10, 2.0), ("c", 90, 3.0)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in mix.source_targets(sources, 3).collect()}
    assert got == {"b": 30.0, "c": 270.0, "a": 700.0}


def test_zip_directories_read_what_others_write():
    for force in (False, True):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            z.comment = b"a comment with PK\x05\x06 in it"
            for name, body in (("one", b"abc" * 50), ("two/é", b"")):
                with z.open(name, "w", force_zip64=force) as f:
                    f.write(body)
        raw = data.getvalue()
        found = zip_warc.ZipDirectory(lambda n, at: raw[at : at + n], len(raw))
        at, n = found.locate("one")
        assert raw[at : at + n] == b"abc" * 50 and found.locate("two/é")[1] == 0
    out = io.BytesIO()
    w = zip_warc.ZipWriter(out)
    for name, body in (("a", b"12345"), ("b", b"")):
        w.start(name)
        w.write(body)
        w.end()
    w.close()
    raw = out.getvalue()
    found = zip_warc.ZipDirectory(lambda n, at: raw[at : at + n], len(raw))  # all sizes are ZIP64 here
    assert raw[slice(found.locate("a")[0], sum(found.locate("a")))] == b"12345"
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and z.read("a") == b"12345"


def test_warc_odd_rows(spark):
    kind = "page_id long, url string, html string, sha1 string"
    rows = [(1, "http://a/", "same", "x"), (2, "b\r\nc", "same", "x"), (2, None, "same", "x"), (3, "u", None, "x"), (4, "u", "", "x"), (None, "u", "same", "x"), (None, "u", "alone é" * 9000, "x")]
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in zip_warc.archive_round_trip(spark.createDataFrame(rows, kind)).collect())
    assert got == Counter({(1, 4, "response", None): 1, (2, 4, "revisit", 1): 2, (3, 0, "response", None): 1, (4, 0, "revisit", 3): 1, (None, 4, "revisit", 1): 1, (None, 72000, "response", None): 1})
    few = zip_warc.archive_round_trip(spark.createDataFrame(rows, kind), min_bytes=5).collect()
    assert {r.record_type for r in few} == {"response"} and len(few) == 7
    assert zip_warc.archive_round_trip(spark.createDataFrame([], kind)).count() == 0


def test_cover_tree_prunes_clusters_and_stays_exact():
    r = np.random.default_rng(1)
    centres = r.integers(-2000, 2000, (12, 6))
    points = np.concatenate([c + r.integers(-20, 20, (300, 6)) for c in centres])
    ids = np.arange(len(points))
    queries = ids[::40]
    search = cover_tree.DualTreeSearch(points[queries], queries, points, ids, 5)
    search.run()
    assert search.pruned > 0
    for row, q in enumerate(queries):
        s = points @ points[q]
        best = [j for j in np.lexsort((ids, -s)) if j != q][:5]
        assert search.best[row].tolist() == best and search.score[row].tolist() == s[best].tolist()


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (3, None, "x"), (4, [nan, 1.0], "x"), (5, [inf, 1.0], "x"), (6, [None, 1.0], "x"), (None, [1.0, 1.0], "x"), (50, [1.0], "x"), (7, [2.0, 0.0], "x"), (7, [2.0, 0.0], "x"), (100, [0.5, 0.0], "x"), (100, [0.5, 0.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = sorted(tuple(r) for r in cover_tree.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, 4).collect())
    assert got == [
        (0, 1, 7, 131072), (0, 2, 7, 131072), (0, 3, 1, 65536), (0, 4, 2, 65536),
        (100, 1, 7, 65536), (100, 2, 7, 65536), (100, 3, 0, 32768), (100, 4, 1, 32768),
    ]
    assert cover_tree.top_k(df.limit(0), "vec_id", "embedding", F.lit(True)).count() == 0


HELPER_NAMES = ["target", "source_size", "_last", "_epochs", "_source", "_mix", "_m", "_b", "_key", "_bucket", "_edge_bucket", "size", "row", "mixed"]


def test_mix_keeps_columns_that_clash(spark):
    plain = [(i, f"w{i} " * (i % 7 + 1), "ab"[i % 2]) for i in range(60)]
    base = spark.createDataFrame(plain, "doc_id long, text string, source string")
    want = Counter(tuple(r) for r in mix.repeat_mixed(base).collect())
    assert len(want) > 20
    clashing = base.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in HELPER_NAMES])
    got = mix.repeat_mixed(clashing)
    assert got.columns == clashing.columns
    rows = got.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in rows) == want
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in HELPER_NAMES)
    assert mix.mix_sources(clashing, size=F.lit(1)).count() == 60


def test_jaccard_fetches_rows_that_share_an_id_by_their_text(spark):
    one, two = "a b c d e f g h i j k l m n o p q r s t", "a b c d e f g h i j k l m n o p q r s u"
    rows = [(None, one)] * 30 + [(None, two)] * 30 + [(None, f"{x} other words that stand alone here") for x in range(40)] + [(7, one)]
    got = parity_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 50).collect()
    assert Counter(r.component_id for r in got) == {7: 61, None: 40}


def test_wide_sketch_words_meet_only_where_shingles_are_equal():
    rng = np.random.default_rng(0)
    plan = parity_join.bands(80)
    starts = [b.start for b in plan]
    sets = [np.unique(rng.integers(0, 2**63, 300).astype(np.uint64) * np.uint64(2)) for _ in range(400)]
    keys = Counter(k for s in sets for _, _, ks in parity_join.bucket_keys(s, plan, starts) for k in ks.tolist())
    assert max(keys.values()) == 1


def test_workers_hold_a_small_part_of_a_batch():
    import tracemalloc

    import pyarrow as pa

    from tablewatch.llm import token_records
    from tablewatch.llm.common import slices
    from tablewatch.llm.queries import tokenizer_path

    text = " ".join(["some", "of", "few", "words"] * 500)
    batch = pa.record_batch({"doc_id": pa.array(range(1_000), pa.int64()), "text": pa.array([text] * 1_000)})
    encoder = token_records._encoder(tokenizer_path())
    encoder.encode([text])
    tracemalloc.start()
    rows = sum(len(encoder.encode_all(group.column(1))[1]) for group in token_records._groups(batch))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == 1_000 and peak < 40 << 20
    parts = list(slices(iter([batch, batch.slice(0, 0), batch.slice(0, 3)])))
    assert [p.num_rows for p in parts] == [512, 488, 3] and pa.Table.from_batches(parts).num_rows == 1_003


def test_token_records_encode_a_word_once(monkeypatch):
    import itertools

    import pyarrow as pa

    from tablewatch.llm import token_records
    from tablewatch.llm.queries import tokenizer_path

    encoder = token_records.WordCachedEncoder(tokenizer_path())
    words = ["".join(w) for w in itertools.islice(itertools.product("bcdfghjklmnpqrstvwxz", repeat=5), 500_000)]
    groups = [pa.array([" ".join(words[i : i + 25_000])]) for i in range(0, len(words), 25_000)]
    encoder.encode(["x"])  # and the empty mark after it
    sent, encode = [], encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda text: sent.append(text.count("|") + 1) or encode(text))
    first = [encoder.encode_all(g)[0].tolist() for g in groups]
    assert sum(sent) == len(words)
    marked = [pa.array([g[0].as_py().upper().replace(" ", ", ")]) for g in groups[:2]]
    assert [encoder.encode_all(g)[0].tolist() for g in groups] == first and sum(sent) == len(words)
    comma = encode(",")[0]
    sent.clear()
    assert [[i for i in encoder.encode_all(g)[0].tolist() if i != comma] for g in marked] == first[:2]
    assert sent == [1]


def test_word_cache_stays_within_bounds():
    import numpy as np
    import pyarrow as pa

    from tablewatch.llm import token_records

    cache = token_records.WordCache(100, 20_000)
    for turn in range(30):
        words = pa.array([f"w{turn}-{i}" for i in range(30)] + ["x" * 100 + str(turn)])
        assert (cache.find(words) < 0).all()
        sizes = np.arange(31) % 4
        cache.add(words, np.repeat(np.arange(31), sizes).astype(np.uint32), sizes)
        places = cache.find(words)
        for i in (0, 3, 30):
            at = cache.starts[places[i]]
            assert cache.ids[at : at + cache.sizes[places[i]]].tolist() == [i] * (i % 4)
        cache.tidy()
        assert len(cache.words) <= 100 and cache.words.nbytes + cache.ids.nbytes <= 20_000
    assert (cache.find(pa.array(["w29-0", "w29-29"])) >= 0).all() and cache.find(pa.array(["w0-0"]))[0] == -1
    at = cache.find(pa.array(["w29-7"]))[0]
    assert cache.ids[cache.starts[at] : cache.starts[at] + cache.sizes[at]].tolist() == [7, 7, 7]
