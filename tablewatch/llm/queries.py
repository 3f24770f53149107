"""The registered queries of this package and the SQL (DuckDB) they must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm import (
    bm25,
    collocations,
    column_bwt,
    cover_tree,
    mix,
    parity_join,
    preference,
    secret_scan,
    spelling,
    token_records,
    toxicity,
    url_trie,
    zip_warc,
)
from tablewatch.llm.common import table

# Fixed by the contract of op1: (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_trie.filter_urls(pages, "url", URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def quality_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, ...) with ``quality_weight``: 2 where labelled good, else 1."""
    good = labels.groupBy(F.col("doc_id").alias("_good_id")).agg(F.max("quality").alias("_quality"))
    weight = F.when(F.col("_quality") == 1, F.lit(2.0)).otherwise(F.lit(1.0))
    return docs.join(good, docs["doc_id"] == good["_good_id"], "left").withColumn("quality_weight", weight).drop("_good_id", "_quality")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mix.word_count(F.col("text")).alias("size"))
    weighted = quality_weights(docs, table(spark, sf_dir, "labels"))
    mixed = mix.mix_sources(weighted, size=F.col("size"), quality=F.col("quality_weight"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.token_digests(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)


def op3_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), n=3, percent=90)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, question, answer) of the ``benchmark`` table: the last sentence is the answer."""
    ends = F.regexp_extract(F.trim("text"), r"(?s)^(.*[.!?])\s+(.+)$", 1)
    last = F.regexp_extract(F.trim("text"), r"(?s)^(.*[.!?])\s+(.+)$", 2)
    return benchmark.select("item_id", F.when(ends != "", ends).otherwise(F.col("text")).alias("question"), last.alias("answer"))


def op5_bm25_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bm25.find_leaks(docs, benchmark_items(table(spark, sf_dir, "benchmark")))


REFUSAL = "I cannot help with that."


def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = preference.refusal_pairs(table(spark, sf_dir, "conversations"), REFUSAL)
    return preference.format_preferences(chosen, rejected).select(
        "pair_id", "part", "position", "role", F.md5(F.col("rendered").cast("binary")).alias("rendered_md5"), "start", "n_chars", "masked"
    )


def op7_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_bwt.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("removed")


def op9_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_warc.archive_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return cover_tree.top_k(vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5, scale=256)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.with_digests(secret_scan.find_secrets(docs, secret_scan.train(docs)))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_trie": op1_url_trie,
    "op2_token_records": op2_token_records,
    "op3_parity_join": op3_parity_join,
    "op4_toxicity": op4_toxicity,
    "op5_bm25_leaks": op5_bm25_leaks,
    "op6_preference": op6_preference,
    "op7_column_bwt": op7_column_bwt,
    "op9_zip_warc": op9_zip_warc,
    "op10_cover_tree": op10_cover_tree,
    "op8_mix": op8_mix,
    "op11_spelling": op11_spelling,
    "op12_secret_scan": op12_secret_scan,
    "op13_collocations": op13_collocations,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = {
    "op1_url_trie": f"""
        WITH rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
        parts AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'), '{_UPPER}', '{_LOWER}')
                            , '') AS host0,
                   coalesce(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1), '') AS path0,
                   coalesce(instr(url, '://'), 0) > 0 AS has
            FROM pages),
        urls AS (SELECT row_number() OVER () AS n, page_id,
                        CASE WHEN has THEN host0 ELSE '' END AS host, CASE WHEN has THEN path0 ELSE '' END AS path FROM parts),
        best AS (
            SELECT n, arg_max(rule_host || rule_path, length(rule_host) * 1000 + length(rule_path)) AS rule,
                   arg_max(r.verdict, length(rule_host) * 1000 + length(rule_path)) AS verdict
            FROM urls JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY n)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (n)
    """,
    "op6_preference": f"""
        WITH l AS (SELECT conv_id, max(turn) AS l FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
        c AS (SELECT conv_id, role, text, turn = l AND role IS NOT DISTINCT FROM 'assistant' AS answer,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position
              FROM conversations JOIN l USING (conv_id) WHERE turn <= l),
        r AS (SELECT conv_id, role, CASE WHEN answer THEN '{REFUSAL}' ELSE text END AS text,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                                        CASE WHEN answer THEN '{REFUSAL}' ELSE text END NULLS FIRST) AS position
              FROM (SELECT conversations.*, turn = l AND role IS NOT DISTINCT FROM 'assistant' AS answer
                    FROM conversations JOIN l USING (conv_id) WHERE turn <= l)),
        f AS (SELECT c.conv_id, min(CASE WHEN c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text THEN c.position END) AS first
              FROM c JOIN r ON c.conv_id = r.conv_id AND c.position = r.position GROUP BY c.conv_id),
        t AS (SELECT conv_id, CASE WHEN first IS NULL OR position < first THEN 'prompt' ELSE 'chosen' END AS part, position, role, text FROM c JOIN f USING (conv_id)
              UNION ALL SELECT conv_id, 'rejected', position, role, text FROM r JOIN f USING (conv_id) WHERE position >= first),
        x AS (SELECT *, '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS rendered FROM t)
        SELECT conv_id AS pair_id, part, position::INTEGER AS position, role, md5(rendered) AS rendered_md5,
               coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, part ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
               length(rendered)::BIGINT AS n_chars, part = 'prompt' OR role IS DISTINCT FROM 'assistant' AS masked
        FROM x
    """,
    "op8_mix": r"""
        WITH good AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
        d AS (
            SELECT documents.doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   -ln((('0x' || substr(md5('mix:' || coalesce(documents.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 1)::DOUBLE
                       / 4503599627370496.0) / CASE WHEN quality = 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS k
            FROM documents LEFT JOIN good ON documents.doc_id = good.doc_id),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
            FROM d GROUP BY source),
        r AS (
            SELECT *, 3.0::DOUBLE * source_size AS cap, row_number() OVER o AS n,
                   ((sum(source_size) OVER ())::DOUBLE - (sum(3.0::DOUBLE * source_size) OVER o - 3.0::DOUBLE * source_size))
                   / (sum(w) OVER (ORDER BY 3.0::DOUBLE * source_size / w DESC, source DESC NULLS FIRST)) AS lv
            FROM s WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST)),
        f AS (SELECT arg_min(lv, n) AS lv, min(n) AS n FROM r WHERE cap / w > lv),
        t AS (SELECT source, source_size, CASE WHEN f.n IS NULL OR r.n < f.n THEN cap ELSE w * f.lv END AS target FROM r, f),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
        p AS (
            SELECT doc_id, size, source_size, target, epochs,
                   sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
            FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
        SELECT doc_id, size, source_size, target,
               (size * (epochs + (2 * upto - size <= 2 * (target - epochs * source_size))::BIGINT))::BIGINT AS taken
        FROM p
    """,
    "op11_spelling": f"""
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
                       lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        runs AS (
            SELECT coalesce(doc_id::VARCHAR, 'null') AS id,
                   unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run
            FROM documents),
        kinds AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
        hashed AS (
            SELECT run, n, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(hex(encode(id || ':' || run))), 2),
                       lambda i: ('0x' || substr(hex(encode(id || ':' || run)), i, 2))::BIGINT)),
                       lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
            FROM kinds, crc_table),
        thinned AS (
            SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
            FROM hashed),
        w AS (SELECT word, sum(n)::BIGINT AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS form
                FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
        links AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.form = b.form AND a.i = b.i AND a.word <> b.word
            UNION SELECT cut.word, w.word, w.n FROM cut JOIN w ON cut.form = w.word
            UNION SELECT w.word, cut.word, cut.n FROM cut JOIN w ON cut.form = w.word),
        best AS (
            SELECT word, count(*) AS n_near, max(near_n) AS most FROM links GROUP BY word),
        pick AS (SELECT links.word, min(near) AS form FROM links JOIN best ON links.word = best.word AND near_n = most GROUP BY links.word),
        judged AS (
            SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
                   CASE WHEN most >= 2 * w.n THEN form END AS form, CASE WHEN most >= 2 * w.n THEN most END::BIGINT AS form_n
            FROM w LEFT JOIN best ON w.word = best.word LEFT JOIN pick ON w.word = pick.word),
        walk AS (
            SELECT word, word AS root, form AS next FROM judged
            UNION ALL SELECT walk.word, j.word, j.form FROM walk JOIN judged j ON walk.next = j.word)
        SELECT judged.word, judged.form, walk.root, n, n_near, form_n FROM judged JOIN walk ON walk.word = judged.word AND walk.next IS NULL
    """,
    "op13_collocations": f"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents WHERE text IS NOT NULL),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
        n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
        g AS (
            SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
            FROM w, (SELECT unnest(range(1, 5))::INT AS k) WHERE len(ws) >= k),
        f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
        c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
        cuts AS (
            SELECT lang, phrase, a, i, array_to_string(ws[1:i], ' ') AS first, array_to_string(ws[i + 1:], ' ') AS rest
            FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
        v AS (
            SELECT cuts.*, x.a AS l, y.a AS r, ((2000000::HUGEINT * cuts.a) // (x.a + y.a))::BIGINT AS score
            FROM cuts JOIN f x ON cuts.lang = x.lang AND first = x.phrase JOIN f y ON cuts.lang = y.lang AND rest = y.phrase),
        s AS (SELECT lang, phrase, a, l, r, score FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
        inside AS (
            SELECT lang, array_to_string(ws[b:b + m - 1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT *, unnest(range(1, k - m + 2)) AS b FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL)
        SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase)::INTEGER AS rank,
               s.phrase, s.a, l, r, n, score
        FROM s JOIN n ON s.lang = n.lang LEFT JOIN inside ON s.lang = inside.lang AND s.phrase = inside.phrase
        WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * s.a
        QUALIFY rank <= 2000
    """,
}
