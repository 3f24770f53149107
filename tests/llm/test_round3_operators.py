"""Spelling variants, collocations and secret scans on small made rows: nulls, ties, repeats, empty tables,
extra columns, and the paths beyond the bounded broadcasts."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tablewatch.llm import collocations, spelling

SCHEMA = "doc_id bigint, text string, lang string, source string, word string, n bigint"


def docs_of(spark, texts, langs=None):
    rows = [(i, t, (langs or ["en"] * len(texts))[i], "s", "extra", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# ------------------------------------------------------------------------------------- spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, divisor=97):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % divisor == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 5:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 3}
    out = {}
    for w in n:
        near = sorted((-n[x], x) for x in n if one_edit(w, x))
        form = near[0][1] if near and -near[0][0] >= 2 * n[w] else None
        out[w] = [form, n[w], len(near), n[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row.insert(1, root)
    return {w: tuple(r) for w, r in out.items()}


def made_texts(seed, n_docs=60):
    rng = random.Random(seed)
    parts = ["th", "er", "on", "an", "é", "ç×", "st", "Re", "in"]
    words = ["".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(150)]
    out = []
    for _ in range(n_docs):
        w = rng.choices(words, k=rng.randint(0, 120))
        w = [x if rng.random() > 0.1 else x[: (k := rng.randrange(len(x)))] + rng.choice(["", "a", "zé"]) + x[k + 1 :] for x in w]
        out.append(rng.choice([" ", ", ", "1"]).join(w))
    return out + [None, "", "ab cd", out[0], out[0], "eeeee " * 500]


@pytest.mark.parametrize("crowd", [spelling.CROWD, 1])
def test_spelling_variants_equal_brute_force(spark, crowd):
    texts = made_texts(5)
    df = docs_of(spark, texts)
    df = df.unionByName(df.where("doc_id = 3").selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "word", "n"))
    rows = [*enumerate(texts), (None, texts[3])]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df, divisor=7, crowd=crowd).collect()}
    assert got == brute_variants(rows, 7) and len(got) > 50
    assert sum(r[0] is not None for r in got.values()) > 10


def test_spelling_of_no_words(spark):
    assert spelling.spelling_variants(docs_of(spark, [None, "", "a b"])).collect() == []
    assert spelling.spelling_variants(docs_of(spark, ["x"]).limit(0)).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_signatures_are_shared_by_all_words_one_edit_apart():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(5, 9))) for _ in range(300)]
    sig, _ = spelling.signatures(words)
    for i in range(300):
        for j in range(i):
            if one_edit(words[i], words[j]):
                assert set(sig[i]) & set(sig[j])


def test_long_chains_of_forms_reach_their_root(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)], "word string, form string")
    assert {tuple(r) for r in spelling.roots(chain).collect()} == {(f"w{i}", "w37") for i in range(37)}


# -------------------------------------------------------------------------------- collocations


def brute_collocations(rows, min_count, top=2000, scale=2_000_000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = {}
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((scale * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out[lang, rank] = (p.decode(), -a, left, right, n[lang], -s)
    return out


@pytest.mark.parametrize("tiling", [{}, {"head_units": 6}, {"head_units": 31}, {"head_units": 1, "filter_bits": 64}, {"head_bytes": 40}])
def test_collocations_equal_brute_force(spark, tiling):
    rng = random.Random(9)
    vocabulary = ["the", "The", "of", "é x", "a-b", "and", "x" * 30, "it", "\x1cq", "zu"]
    texts = []
    for _ in range(120):
        w = []
        while len(w) < rng.randint(0, 60):
            w += rng.choice([rng.choices(vocabulary, k=2), ["new", "york", "city"], ["a", "b", "c", "d", "e"]])
        texts.append("".join(x + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " \x0b"]) for x in w))
    texts += [None, "", " ", ";;", texts[0], texts[0]]
    langs = [rng.choice(["en", "de", None, ""]) for _ in texts]
    got = {
        (r.lang, r.rank): (r.phrase, r.a, r.l, r.r, r.n, r.score)
        for r in collocations.collocations(docs_of(spark, texts, langs), min_count=8, top=40, **tiling).collect()
    }
    assert got == brute_collocations(zip(langs, texts), 8, 40) and len(got) > 30


def test_tiles_count_every_cell():
    rng = np.random.default_rng(2)
    rows = np.r_[rng.integers(0, 40, 200_000), rng.integers(0, 5_000, 3_000)]
    columns = np.r_[rng.integers(0, 40, 200_000), rng.integers(0, 90_000, 3_000)]
    got = {(int(a), int(b)): int(c) for a, b, c in zip(*collocations.count_cells(rows, columns))}
    assert got == Counter(zip(rows.tolist(), columns.tolist()))


def test_cells_beyond_32_bits():
    """A buffer of 32-bit word numbers whose cells' addresses need more."""
    heads = [collocations.Head({"en": [b"w%d" % i for i in range(100_000)]})]
    codes = np.array([99_990 + i % 7 for i in range(3000)] + [-1], np.int32)
    got = collocations._count_buffer(collocations._Numbers("en", heads), codes).to_pydict()
    want = Counter(f"w{a} w{b}" for a, b in zip(codes[:-2].tolist(), codes[1:-1].tolist()))
    assert dict(zip(got["phrase"], got["a"])) == want


def test_ranked_phrases_travel_as_numbers(spark):
    """Rows of ranked units and words hold no text until they are summed; the others do."""
    heads = [
        collocations.Head({"de": [b"b", b"a"], "en": [b"a", "é".encode()]}, table=b"\xff" * 8),
        collocations.Head({"en": ["a é".encode(), b"a a"]}, table=b"\xff" * 8),
    ]
    heads[0].hashes = {x: np.array([collocations._word_hash(x, w) for w in words], np.uint64) for x, words in heads[0].ranked.items()}
    heads[1].address(heads[:1])
    texts = [("en", "A é a é a, a a a z a"), ("de", "a b a b"), ("fr", "a b a b"), ("en", "a é a é")] * 40
    rows = spark.createDataFrame([(lang, text.encode()) for lang, text in texts], "lang string, text binary")

    class Tap:
        def mapInArrow(self, function, schema):
            self.function = function
            return rows.mapInArrow(function, schema)

    for level in (1, 2):
        want = Counter()
        for lang, text in texts:
            for piece in text.replace("A", "a").split(","):
                w = piece.split()
                want.update((lang, " ".join(w[i : i + level + 1])) for i in range(len(w) - level))
        tap, shared = Tap(), spark.sparkContext.broadcast(heads[:level])
        for least in (1, 80):
            got = [tuple(r) for r in collocations.longer_counts(tap, shared, least).collect()]
            assert len(got) == len(set(r[:2] for r in got)) and {r[:2]: r[2] for r in got} == {k: n for k, n in want.items() if n >= least}
        sent = pa.Table.from_batches(tap.function(iter(rows.toArrow().to_batches())))
        numbered = sent.filter(pc.is_valid(sent["cell"]))
        assert numbered["phrase"].null_count == numbered.num_rows == (5 if level == 1 else 2)
        assert pc.sum(sent["a"]).as_py() == sum(want.values())


def test_words_of_one_text_are_looked_up_once(monkeypatch):
    numbers = collocations._Numbers("en", [collocations.Head({"en": [b"a"]}, table=bytes(8), hashes={"en": np.zeros(1, np.uint64)})])
    hashed, one = [], collocations._word_hash
    monkeypatch.setattr(collocations, "_word_hash", lambda lang, word: hashed.append(word) or one(lang, word))
    assert numbers.codes([b" a b. c A", b"", b"c b;;a"]).tolist() == [-1, 0, -1, -1, -1, 0, -1, -1, -1, -1, -1, -1, 0, -1, -1]
    assert sorted(hashed) == [b"b", b"c"]


def test_products_beyond_64_bits(spark):
    # 2,000,000 * a passes 2**63 for a over 4.6e12
    expr = "CAST(2000000 AS DECIMAL(18,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"
    a, left, right = 9 * 10**12 + 7, 10**13 + 1, 3 * 10**13
    got = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint").selectExpr(expr).first()[0]
    assert got == 2_000_000 * a // (left + right)


def test_collocations_of_no_documents(spark):
    empty = docs_of(spark, ["x"]).limit(0)
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(docs_of(spark, [None, ""])).collect() == []


# -------------------------------------------------------------------------------- secret scans


def brute_base(text):
    """(start, kind, end) in code points, straight from the contract's patterns."""
    text = text or ""
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def secret_texts():
    rng = random.Random(4)
    hexed = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    mixed = lambda n: "".join(rng.choices("ABCDEFGHJKMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789", k=n))
    plain = lambda: " ".join("".join(rng.choices("aeéinrst", k=rng.randint(2, 8))) for _ in range(rng.randint(1, 30)))
    texts = []
    for _ in range(900):
        kind = rng.randrange(6)
        middle = [
            f'{rng.choice(["token", "Secret", "API_KEY", "passwd"])}{rng.choice([" = ", ":", "=", ": "])}"{mixed(rng.randint(12, 40))}"',
            f"AKIA{''.join(rng.choices('ABCDEFG0123456789', k=16))}", hexed(40),
            f"{''.join(rng.choices('aeinrst', k=6))}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com",
            f"version-{rng.randint(1, 9)}.{rng.randint(0, 99)}.release", "",
        ][kind]
        texts.append(f"{plain()} {middle} {plain()}")
    odd = ["", None, "secret: token: abcdefgh", "token=short", "xAKIA" + "A" * 15, "AKIA" + "9" * 300, "f" * 23, "ſecret = abcdefgh", "toKen" + " " * 50 + "= 'é", "key " + mixed(4000) + " " + hexed(9000)]
    return texts + odd


@pytest.fixture(scope="module")
def secrets(spark):
    from tablewatch.llm import secret_scan

    texts = secret_texts()
    net = secret_scan.train(docs_of(spark, texts), sample=400)
    return texts, net


def test_secret_base_findings_equal_brute_force(spark, secrets):
    import hashlib

    from tablewatch.llm import secret_scan

    texts, net = secrets
    for model in (net, None):
        rows = secret_scan.with_digests(secret_scan.find_secrets(docs_of(spark, texts), model)).collect()
        assert len(rows) == len(texts)
        for r in rows:
            base = [f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in brute_base(texts[r.doc_id])]
            assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
            assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k + ":") for x in base) for k in secret_scan.KINDS]
            assert [x for x in r.spans.split(",") if x and not x.startswith("model:")] == base
            assert len([x for x in r.spans.split(",") if x]) == len(base) + r.n_model
            if model is None:
                assert r.n_model == 0


def test_secret_network_finds_what_the_patterns_miss(spark, secrets):
    from tablewatch.llm import secret_scan

    _, net = secrets
    assert 0 < net.threshold <= 1
    rng = random.Random(11)
    bare = ["".join(rng.choices("ABCDEFGHJKMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789", k=32)) for _ in range(60)]
    mails = [f"{''.join(rng.choices('aeinrst', k=6))}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com" for _ in range(60)]
    rows = secret_scan.find_secrets(docs_of(spark, [f'néw "{x}" here' for x in bare] + [f"write to {x} now" for x in mails]), net).collect()
    found = {r.doc_id: r.findings for r in rows}
    hit = sum(any(f.kind == "model" and (f.start, f.end) == (5, 37) for f in found[i]) for i in range(60))
    assert hit >= 50 and sum(bool(found[60 + i]) for i in range(60)) <= 3


def test_secret_scores_do_not_depend_on_chunks(secrets):
    from tablewatch.llm import secret_scan

    _, net = secrets
    raw = bytes(random.Random(3).choices(range(33, 120), k=1000))
    symbols, _ = secret_scan.encode([(raw, 24, 980)], chunk=1000)
    values, _ = net.maxima(symbols)
    whole = np.maximum(values[:, 0] + net.bias, 0).ravel() @ net.dense + net.offset
    assert abs(net.logits([(raw, 24, 980)])[0] - whole) < 1e-3


def test_secret_scan_without_labels_or_documents(spark):
    from tablewatch.llm import secret_scan

    plain = docs_of(spark, [None, "", "no secrets", "nothing 12345678a here"])
    assert secret_scan.train(plain) is None and secret_scan.train(plain.limit(0)) is None
    assert all(r.findings == [] for r in secret_scan.find_secrets(plain, None).collect())
    assert secret_scan.find_secrets(plain.limit(0), None).collect() == []


def test_secret_network_learns_from_and_is_judged_on_all_windows(spark, monkeypatch):
    import xxhash

    from tablewatch.llm import secret_scan

    rng = random.Random(8)
    hexed = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    mail = lambda n: f"{''.join(rng.choices('aeinrst', k=n))}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com"
    texts = [" ".join(f"sum {hexed(rng.choice([26, 40, 200]))} by {mail(rng.choice([6, 8, 150]))}" for _ in range(rng.randint(0, 30))) for _ in range(500)]
    windows = {
        (int(label), xxhash.xxh64_intdigest(w[0], w[1]) >> 1, w)
        for t in map(str.encode, texts)
        for (starts, ends) in [secret_scan.candidates(t)]
        for s, e, label in zip(starts.tolist(), ends.tolist(), secret_scan.covered(starts, ends, secret_scan.base_findings(t)))
        for w in [secret_scan.window(t, s, e)]
    }
    assert min(sum(label == k for label, _, _ in windows) for k in (0, 1)) > 6_000
    taken = secret_scan.all_windows(docs_of(spark, texts), "text").collect()
    assert {(r.label, r.h, (bytes(r.raw), r.s, r.e)) for r in taken} == windows and len(taken) == len(windows)
    net = secret_scan.train(docs_of(spark, texts), epochs=2, block=2_000)
    known = [w for label, h, w in windows if label and h % 5 == 4]
    assert any(len(w[0]) > secret_scan.CHUNK for w in known)
    scores = np.sort(net.probabilities(known))
    assert abs(net.threshold - scores[int(np.floor((1 - secret_scan.RECALL) * len(known)))]) < 1e-5
    rest = net.probabilities([w for label, h, w in windows if not label and h % 5 == 4])
    assert np.mean(rest >= net.threshold) < 0.02
    again = secret_scan.train(docs_of(spark, texts).repartition(5), epochs=2, block=2_000)
    assert np.array_equal(net.weights(), again.weights()) and net.threshold == again.threshold


def test_secret_rank_is_exact(spark):
    from tablewatch.llm import secret_scan

    rng = random.Random(2)
    values = [rng.choice([rng.uniform(-1e-9, 1e-9), rng.gauss(0, 1e3), 5.0, -0.25]) for _ in range(3_000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for place in (0, 1, 700, 1_499, 2_200, 2_999):
        assert secret_scan._ranked(rows, place) == sorted(values)[place]
