"""Mixing sources to target weights: Efraimidis-Spirakis sampling with whole epochs first.

Every source gets a share of the budget by its weight. A target stops at ``max_epochs`` times the
source's size, and what is cut off goes to the other sources by weight until none is above its
limit. A source takes all its documents ``floor(target / size)`` times (complete epochs) and then a
fraction of them: each document draws an exponential key ``-ln(u) / weight`` (u from the md5 of its
id, so reruns agree), documents are sorted by key within the source, and the prefix whose summed
sizes come nearest the rest of the target is taken once more.

DataFrame functions only. Sizes and keys are computed in the pass that finds the cuts and again, as
cheaply as the texts are read, in the pass that applies them: the texts are never shuffled, as a join
with stored sizes would have to. The sort is not done per source (one source may hold a third of all rows): keys fall into
``KEY_BUCKETS`` ranges, sizes are summed per (source, range) with map-side partial sums, and only
the one range per source in which the target ends is sorted.

Defined results: null sources form a source of their own, ordered last. Null texts have size 0.
Sizes of 0 cost nothing, take nothing, and still get their ``times``. A null id hashes like the
text ``null``; equal ids tie and are ordered by size (equal rows are interchangeable). A null,
NaN or non-positive quality weight sorts behind all others. An empty table gives an empty result.
Extra columns of the input are kept by ``repeat_mixed``, whatever their names, and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import WORD_PATTERN, free_name, stored

KEY_BUCKETS = 4096
MOST_BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def sampling_key(doc_id: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight with u in (0, 1] from 52 bits of an md5; infinite for unusable weights."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long")
    u = (bits + F.lit(1)).cast("double") / F.lit(float(2**52))
    usable = weight.isNotNull() & ~F.isnan(weight) & (weight > 0)
    return F.when(usable, -F.log(u) / weight).otherwise(F.lit(float("inf")))


def source_targets(sources: DataFrame, max_epochs: int, budget: float = 1.0) -> DataFrame:
    """(source, source_size, weight) with ``target``: the water level over all sources. One row per
    source, so the windows without partition here hold the list of sources, never documents."""
    every = Window.partitionBy(F.lit(0))
    by_ratio = every.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = (F.col("source_size") * max_epochs).cast("double")
    total = F.sum("source_size").over(every).cast("double") * F.lit(budget)
    levels = (
        sources.withColumn("_cap", cap)
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_total", total)
        .withColumn("_rank", F.row_number().over(by_ratio))
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    )
    free = F.when(F.col("_ratio") > F.col("_level"), F.struct("_rank", "_level"))
    first_free = F.min(free).over(every)
    capped = F.col("_first").isNull() | (F.col("_rank") < F.col("_first._rank"))
    target = F.when(capped, F.col("_cap")).otherwise(F.col("weight") * F.col("_first._level"))
    return levels.withColumn("_first", first_free).select("source", "source_size", target.alias("target"))


def cycling_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights that repeat over the sources in code point order, null last."""
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    picks = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.withColumn("weight", F.get(picks, F.pmod(place, F.lit(len(cycle))).cast("int")))


def source_cuts(sized: DataFrame, cycle: tuple[int, ...], max_epochs: int, budget: float) -> DataFrame:
    """One row per source: (source, source_size, target, _epochs, _cut). ``sized``: doc_id, size,
    source, _key, _bucket. Rows up to ``_cut`` (key, id, size) are taken once more; null: none."""
    per_bucket = sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_size"))
    sources = cycling_weights(per_bucket.groupBy("source").agg(F.sum("_size").alias("source_size")), cycle)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = source_targets(sources, max_epochs, budget).withColumn("_epochs", epochs).withColumn("_rest", F.col("target") - epochs * F.col("source_size"))

    # The first range whose summed sizes reach the rest of the target, and the words before it.
    upto = Window.partitionBy("source").orderBy("_bucket")
    edges = (
        per_bucket.withColumn("_sum", F.sum("_size").over(upto)).alias("b")
        .join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .where(F.col("_sum") >= F.col("_rest"))
        .groupBy("b.source").agg(F.min(F.struct("_bucket", (F.col("_sum") - F.col("_size")).alias("_before"))).alias("_edge"), F.first("_rest").alias("_rest"))
    )
    inside = sized.alias("d").join(edges.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("_bucket") == F.col("_edge._bucket")))
    in_order = Window.partitionBy("d.source").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = F.col("_edge._before") + F.sum("size").over(in_order)
    # A document is taken if its middle lies within the rest, so the sum ends as near as can be.
    taken = inside.select("d.source", "_key", "doc_id", "size", ((ends * 2 - F.col("size")).cast("double") <= F.col("_rest") * 2).alias("_in"))
    last = taken.where("_in").groupBy("source").agg(F.max(F.struct("_key", "doc_id", "size")).alias("_last"))
    # If the range's first document is too long already, all ranges before it are taken whole.
    floor = edges.select("source", F.col("_edge._bucket").alias("_edge_bucket"))
    return (
        targets.alias("t")
        .join(last.alias("l"), F.col("t.source").eqNullSafe(F.col("l.source")), "left")
        .join(floor.alias("f"), F.col("t.source").eqNullSafe(F.col("f.source")), "left")
        .select(F.col("t.source").alias("_source"), "source_size", "target", "_epochs", "_last", F.coalesce("_edge_bucket", F.lit(KEY_BUCKETS + 1)).alias("_edge_bucket"))
    )


def with_times(
    docs: DataFrame,
    doc_id: str = "doc_id",
    size: Column | None = None,
    source: str = "source",
    quality: Column | None = None,
    cycle: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    budget: float = 1.0,
    seed: str = "mix",
    into: str = "_mix",
) -> DataFrame:
    """``docs`` with the column ``into``: a struct of size, source_size, target and times (how often it is taken).
    The caller's columns travel as one struct, so their names clash with none here; ``into`` must be free."""
    if into.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has a column {into!r} already")
    size = word_count(F.col("text")) if size is None else size
    weight = F.lit(1.0) if quality is None else quality.cast("double")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    drawn = docs.select(
        whole, F.col(doc_id).alias("doc_id"), size.alias("size"), F.col(source).alias("source"),
        sampling_key(F.col(doc_id), weight, seed).alias("_key"),
    )
    # exp(-key) lies in [0, 1): its ranges hold like shares of the documents whatever the keys' scale.
    keyed = drawn.withColumn("_bucket", F.floor((F.lit(1.0) - F.exp(-F.col("_key"))) * F.lit(KEY_BUCKETS)).cast("int"))
    sized = stored(keyed.drop("row"), "mix-sizes")
    cuts = stored(source_cuts(sized, cycle, max_epochs, budget), "mix-cuts", partitions=1)
    # One row per source: broadcast, unless sources are so many that they are a table of their own.
    cuts = F.broadcast(cuts) if cuts.count() <= MOST_BROADCAST_SOURCES else cuts
    joined = keyed.join(cuts, F.col("source").eqNullSafe(F.col("_source")))
    own = F.struct("_key", "doc_id", "size")
    extra = (F.col("_bucket") < F.col("_edge_bucket")) | ((F.col("_bucket") == F.col("_edge_bucket")) & F.coalesce(own <= F.col("_last"), F.lit(False)))
    times = (F.col("_epochs") + extra.cast("long")).cast("int")
    out = joined.select("row", F.struct("size", "source_size", "target", times.alias("times")).alias("mixed"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("mixed").alias(into))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per input row: (doc_id, size, source_size, target, times, taken); options of ``with_times``."""
    into = free_name(docs, "_mix")
    mixed = with_times(docs, doc_id, into=into, **options)
    return mixed.select(F.col(doc_id).alias("doc_id"), F.col(into).alias("m")).select(
        "doc_id", "m.*", (F.col("m.times") * F.col("m.size")).cast("long").alias("taken")
    )


def repeat_mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    into = free_name(docs, "_mix")
    mixed = with_times(docs, into=into, **options).where(F.col(into).getField("times") > 0)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return mixed.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col(into).getField("times"))).alias(into)).drop(into)
