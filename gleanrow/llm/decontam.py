"""Benchmark decontamination by a broadcast hash set of test n-grams, DataFrame functions only.

Items and documents become lower-cased words. An item's windows are its runs of ``n`` words; a
shorter item with at least one word is one window of its own.

One way for benchmarks of any size. The first ``PROBE`` words of each window (all of a shorter
one) are hashed into a set of ``SLOTS`` bits, a table of 64-bit words that is broadcast: it never
has more than ``SLOTS / 64`` rows. Every position of every text is looked up in it inside the
scan, without a shuffle. Where it hits, the whole windows that start there are compared with the
item windows by 128-bit digests of their words, so a probe never decides alone. That table is
broadcast up to ``broadcast_rows`` windows; beyond, digests of the hits (never texts) are shuffled.
Hits are gathered per distinct text, and documents take those of their text.

A text is identified and split once, into blocks of ``STEP`` words that overlap by a window; what is
carried beside a hit is its block, so a very long text made of benchmark passages costs its words.

Edge cases: null or empty texts have no words and no hits; items without words are ignored; the
windows of an item with a null id count as hits but name no item; repeated rows are each judged;
very long texts are judged whole; empty tables give empty or all-clean results; columns of any
other name pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import all_of, ascii_lower, own_prefix, stored

#: What is between words, before A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: Words of a window that are looked up first, and bits of the set: at most SLOTS / 64 rows of 16 bytes.
PROBE, SLOTS = 3, 1 << 26
#: Words of a block. A hit carries its block, never its text, so hits cost the same in texts of any length.
STEP = 64
#: Item windows, or texts with hits, that are broadcast; more are joined by a shuffle of their keys.
BROADCAST_ROWS = 200_000
FOUND = "text_id binary, n_words long, hits array<struct<start:int,len:int>>, items array<string>, n_hit long"


def _pieces(text: Column) -> Column:
    """The words, and an empty piece before or after them where the text does not begin or end with one."""
    return F.split(F.coalesce(text, F.lit("")), BETWEEN, -1)


def _blank_first(pieces: Column) -> Column:
    return (F.get(pieces, F.lit(0)) == "").cast("int")


def _count(pieces: Column) -> Column:
    last = (F.size(pieces) > 1) & (F.get(pieces, F.size(pieces) - 1) == "")
    return (F.size(pieces) - _blank_first(pieces) - last.cast("int")).cast("long")


def words(text: Column) -> Column:
    return F.filter(_pieces(ascii_lower(text)), lambda w: w != "")


def text_id() -> Column:
    """128 bits of the text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _digest(win: Column) -> Column:
    return F.unhex(F.md5(win))


def _slot(*some: Column) -> Column:
    """A bit of the set by the words given; nulls are words past the end.

    lower() changes more letters than A-Z, so it joins more words than are equal: the digest decides.
    """
    return F.xxhash64(*(F.lower(w) for w in some)).bitwiseAND(F.lit(SLOTS - 1))


def item_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """len, slot, digest, items (sorted ids as strings) of every distinct window."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.lit(n), F.size("w"))
    at = F.sequence(F.lit(1), F.size("w") - size + 1)
    wins = w.select("item", size.alias("len"), F.explode(F.transform(at, lambda i: F.slice("w", i, size))).alias("v"))
    some = [F.when(F.col("len") > j, F.get("v", F.lit(j))) for j in range(PROBE)]
    rows = wins.select("item", "len", _slot(*some).alias("slot"), _digest(F.array_join("v", " ")).alias("digest"))
    return rows.groupBy("len", "slot", "digest").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _bits(wins: DataFrame) -> DataFrame:
    """The set: at most SLOTS / 64 rows (place, bits)."""
    return wins.groupBy(F.shiftright("slot", 6).alias("place")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))


def covered(hits: Column) -> Column:
    """How many word positions lie in any of the hits."""
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(acc, x):
        end = x["start"] + x["len"]
        fresh = F.greatest(F.lit(0), end - F.greatest(acc["end"], x["start"]))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.sort_array(hits), begin, step, lambda acc: acc["n"]).cast("long")


def _gaps(hits: Column, n_words: Column) -> Column:
    """array<struct<start, end>>: the runs of words outside all hits (sorted by start), in one pass over them."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, x):
        gap = F.array(F.struct(acc["end"].alias("start"), x["start"].cast("int").alias("end")))
        gaps = F.when(x["start"] > acc["end"], F.concat(acc["gaps"], gap)).otherwise(acc["gaps"])
        return F.struct(gaps.alias("gaps"), F.greatest(acc["end"], x["start"] + x["len"]).cast("int").alias("end"))

    last = F.array(F.struct(n_words.cast("int").alias("start"), F.lit(0).alias("len")))
    return F.aggregate(F.concat(hits, last), F.struct(none.alias("gaps"), F.lit(0).alias("end")), step, lambda acc: acc["gaps"])


def found(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """FOUND of every distinct text with a hit, as a table."""
    wins = stored(item_windows(benchmark, n), "windows")
    per_len = {r["len"]: r["count"] for r in wins.groupBy("len").count().collect()}  # at most n rows
    if not per_len:
        return docs.sparkSession.createDataFrame([], FOUND)
    text = docs.select(F.col("text").cast("string").alias("text"))
    per_text = text.select(text_id().alias("text_id"), _pieces(F.col("text")).alias("w"))
    # The outer forms: from the inner ones the optimizer infers filters that split each text once more.
    # No lambda from here to the digests: generated code then goes through a text's hits without keeping rows of words.
    begins = F.explode_outer(F.sequence(F.lit(0), F.size("w") - 1, F.lit(STEP))).alias("b")
    counted = per_text.select("text_id", "w", _count(F.col("w")).alias("n_words"), _blank_first(F.col("w")).alias("blank"), begins)
    reach = F.slice("w", F.col("b") + 1, STEP + max(n, PROBE) - 1).alias("w")
    at = counted.select("text_id", "n_words", (F.col("b") - F.col("blank")).alias("start"), reach)
    at = at.select("*", F.posexplode_outer(F.slice("w", 1, STEP)).alias("i", "first"))
    # a window shorter than PROBE has a slot of its own number of words
    ahead = [F.col("first"), *(F.get("w", F.col("i") + j) for j in range(1, PROBE))]
    none = F.lit(None).cast("string")
    slots = [_slot(*ahead[:k], *[none] * (PROBE - k)) for k in sorted({min(k, PROBE) for k in per_len})]
    at = at.withColumn("slot", slots[0] if len(slots) == 1 else F.explode(F.array_distinct(F.array(*slots))))
    near = at.join(F.broadcast(_bits(wins)), F.shiftright("slot", 6) == F.col("place"))
    near = near.where(F.expr("shiftright(bits, cast(slot & 63 as int)) & 1") == 1)
    near = near.select("*", F.explode(F.array(*(F.lit(k) for k in sorted(per_len)))).alias("len"))
    near = near.where(F.col("i") + F.col("len") <= F.size("w"))
    win = ascii_lower(F.array_join(F.slice("w", F.col("i") + 1, F.col("len")), " "))
    near = near.select("text_id", "n_words", (F.col("start") + F.col("i")).alias("i"), "len", _digest(win).alias("digest"))
    keys = wins.select("len", "digest", "items")
    hits = near.join(F.broadcast(keys) if sum(per_len.values()) <= broadcast_rows else keys, ["len", "digest"])
    hit = F.struct(F.col("i").alias("start"), "len")
    per = hits.groupBy("text_id", "n_words").agg(F.collect_set(hit).alias("hits"), F.collect_set("items").alias("items"))
    items = F.array_sort(F.array_distinct(F.flatten("items")))
    return stored(per.select("text_id", "n_words", F.sort_array("hits").alias("hits"), items.alias("items"),
        covered(F.col("hits")).alias("n_hit")), "hits")


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def _joined(docs: DataFrame, per: DataFrame, how: str, broadcast_rows: int) -> DataFrame:
    """docs with per (text_id, ...) of their texts; per's columns get a prefix of their own."""
    p = own_prefix(docs)
    per = per.select(*(F.col(c).alias(p + c) for c in per.columns))
    if per.count() <= broadcast_rows:
        per = F.broadcast(per)
    return docs.join(per, text_id() == F.col(f"{p}text_id"), how)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """docs without the contaminated documents; same columns."""
    bad = found(docs, benchmark, n, broadcast_rows).where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select("text_id")
    return _joined(docs, bad, "left_anti", broadcast_rows)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """docs with clean_words: the document's words without those inside a hit."""
    p = own_prefix(docs)
    out = _joined(docs, found(docs, benchmark, n, broadcast_rows).select("text_id", "hits"), "left", broadcast_rows)
    w = words(F.col("text").cast("string"))
    hits = F.coalesce(F.col(f"{p}hits"), F.array().cast("array<struct<start:int,len:int>>"))
    clean = F.flatten(F.transform(_gaps(hits, F.size(w)), lambda g: F.slice(w, g["start"] + 1, g["end"] - g["start"])))
    return out.select(*all_of(docs), clean.alias("clean_words"))


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted as strings), contaminated."""
    per = found(docs, benchmark, n, broadcast_rows).select("text_id", "n_hit", "items")
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    narrow = narrow.select("doc_id", text_id().alias("id"), _pieces(F.col("text")).alias("w"))
    narrow = narrow.select("doc_id", "id", _count(F.col("w")).alias("n_words"))
    out = narrow.join(F.broadcast(per) if per.count() <= broadcast_rows else per, F.col("id") == F.col("text_id"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), items.alias("items"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"))
