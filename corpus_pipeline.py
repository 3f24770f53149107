"""The corpus pipeline: five stages over ``documents``, each applied to what the one before kept.

``run`` writes each stage's result to the shared folder and reads it back for the next, so a lost
executor costs a part of one stage. The last stage returns the token records' digest; the others
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm import bm25, mix, parity_join, token_records, toxicity
from tablewatch.llm.common import stored, table
from tablewatch.llm.queries import benchmark_items, tokenizer_path

TOXIC_FROM = 0.5
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC_FROM``; the model learns from the labelled ones."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word shingles."""
    return parity_join.one_of_each_group(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return bm25.without_leaks(docs, benchmark_items(table(spark, sf_dir, "benchmark")))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it (0 to 3 times). The sampling prefers
    longer documents: the weight grows with the words, up to 200."""
    words = mix.word_count(F.col("text"))
    return mix.repeat_mixed(docs, quality=F.least(words, F.lit(200)) / F.lit(200.0))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records; a document that the mix repeats is written as often."""
    return token_records.token_digests(docs, tokenizer_path(), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_to_weights),
    ("token_records", write_tokens),
]

# Classifier, sketches and tokenizer cannot be expressed in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
