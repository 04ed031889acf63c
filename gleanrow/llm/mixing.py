"""Mixing sources to target weights.

Words are counted per source; targets follow by water-filling: each source gets its weight's
part of the budget, at most ``max_rate`` times its own size, and what a full source cannot
take goes to the others by weight until none is above its cap. A document is emitted
floor(rate) times plus one Bernoulli copy with the fraction as its probability, drawn from
a hash of its id. Of ``SEEDS`` draws per document one is used, the same for a whole source:
the one whose words come nearest to the source's target. So reruns agree, and short
sources meet their targets too. The choice looks at the outcome, so a document's own probability
is the fraction only approximately, the more nearly the more documents its source has.

Edge cases: null text has size 0; the null source is one source, after all others; a
source without words has target 0 and rate 0; rows with the same id are drawn alike; an
empty table gives an empty result. Sources are meant to be far fewer than documents: one
row per source meets in one task for the ranks and running sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, all_of, own_prefix, stored

#: Weights in the order of the sources' names, repeating; share of all sizes; cap on a source's rate.
WEIGHTS, SHARE, MAX_RATE = (5, 2, 1), 1.5, 2
#: Draws per md5 (of 32 bits each) and md5s per document.
DRAWS, HASHES = 4, 8
SEEDS = DRAWS * HASHES


def count_words(text: Column) -> Column:
    """Number of words: starts of a run of anything but ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_rate: int = MAX_RATE) -> DataFrame:
    """From (source, size) rows: source, source_size, target double. Exact water-filling."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("_r", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.get(F.array(*(F.lit(float(x)) for x in weights)), (F.col("_r") % len(weights)).cast("int"))
    w = ranked.withColumn("_w", weight).withColumn("_cap", (F.col("source_size") * max_rate).cast("double"))
    # sources fill up in the order of cap / weight; _left and _weights: what is there for this one and those after it
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_r")
    caps = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    budget = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    left = w.withColumn("_left", budget - caps).withColumn("_weights",
        F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    full = F.col("_cap") * F.col("_weights") <= F.col("_left") * F.col("_w")
    level = left.withColumn("_level", F.when(~full, F.col("_left") / F.col("_weights")))
    # the first source that does not fill up sets the level for all after it
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    target = F.coalesce(F.first("_level", ignorenulls=True).over(upto) * F.col("_w"), F.col("_cap"))
    return level.select("source", "source_size", target.alias("target"))


def draws(doc_id: Column) -> list[Column]:
    """SEEDS numbers in [0, 1) of 32 bits from md5 of the id, which other engines can repeat."""
    key = F.coalesce(doc_id.cast("string"), F.lit("null"))
    out = []
    for k in range(HASHES):
        h = F.md5(F.concat(key, F.lit(f"|{k}")))
        out += [F.conv(F.substring(h, 1 + 8 * j, 8), 16, 10).cast("double") / float(2**32) for j in range(DRAWS)]
    return out


def plan(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_rate: int = MAX_RATE) -> DataFrame:
    """From (doc_id, source, size) rows: per source its target, rate and the seed to use."""
    # a table of one row per source: Spark broadcasts it if its size on disk is under the session's threshold
    t = stored(targets(sizes, weights, share, max_rate), "targets").withColumn("rate",
        F.when(F.col("source_size") > 0, F.least(F.lit(float(max_rate)), F.col("target") / F.col("source_size"))).otherwise(0.0))
    rated = sizes.join(t.select(F.col("source").alias("_s"), "rate"), F.col("source").eqNullSafe(F.col("_s")))
    fraction = F.col("rate") - F.floor("rate")
    sums = [F.sum(F.when(d < fraction, F.col("size")).otherwise(0)).alias(f"_s{i}") for i, d in enumerate(draws(F.col("doc_id")))]
    won = rated.groupBy("source").agg(*sums)
    tt = t.join(won.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    extra = F.col("target") - F.floor("rate") * F.col("source_size")
    best = F.least(*(F.struct(F.abs(F.col(f"_s{i}") - extra).alias("gap"), F.lit(i).alias("i")) for i in range(SEEDS)))["i"]
    return tt.select("source", "source_size", "target", "rate", best.alias("seed"))


def sized(docs: DataFrame) -> DataFrame:
    """docs' doc_id, source, size, kept as a table: the sums and the draws read it, not the texts."""
    return stored(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")), "sizes")


def copies(doc_id: Column, rate: Column, seed: Column) -> Column:
    drawn = F.get(F.array(*draws(doc_id)), seed)
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mix_report(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_rate: int = MAX_RATE) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words, repeats counted) of every document."""
    sizes = sized(docs)
    p = stored(plan(sizes, weights, share, max_rate), "mix").withColumnRenamed("source", "_s")
    out = sizes.join(p, F.col("source").eqNullSafe(F.col("_s")), "left")
    taken = F.col("size") * copies(F.col("doc_id"), F.col("rate"), F.col("seed"))
    return out.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_rate: int = MAX_RATE) -> DataFrame:
    """The mixed documents, repeats as rows, with docs' columns."""
    p = own_prefix(docs)
    source, rate, seed, copy = (p + x for x in ("source", "rate", "seed", "copy"))
    how = stored(plan(sized(docs), weights, share, max_rate), "mix")
    how = how.select(F.col("source").alias(source), F.col("rate").alias(rate), F.col("seed").alias(seed))
    out = docs.join(how, F.col("source").eqNullSafe(F.col(source)), "left")
    n = copies(F.col("doc_id"), F.col(rate), F.col(seed))
    times = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return out.withColumn(copy, F.explode(times)).select(*all_of(docs))
