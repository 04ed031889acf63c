"""SimHash near-duplicates by a binary trie self-join.

A fingerprint's bit is 1 if it is set in over half of its shingles' XXH64 values. Two
fingerprints are linked when at most ``budget`` bits differ; components of links get the
least doc_id in them.

Distinct fingerprints are joined, so copies cost nothing. If at most 3 of 64 bits differ,
one of 4 blocks is equal: each fingerprint goes to 4 buckets, one per block, with that
block moved to the front. A bucket of more than ``BUCKET_ROWS`` is split the same way over the
bits that are not yet equal, until it is small (the join of unrelated fingerprints costs their
square, a split four rows each); nothing is capped. In a bucket the sorted fingerprints are a
binary trie whose nodes are ranges. Pairs of nodes go down together, one bit a level, at most
``FRONTIER`` of them at a time; where they part they spend one bit of the budget and are dropped
when it is exceeded. Budgets 1, 2, 3 are run in turn, and pairs whose fingerprints are already
connected are dropped as well, so a bucket of near copies costs its links, not its pairs.
A bucket returns a spanning forest of its links; components are then joined across buckets.

keep_one() is for the corpus pipeline, whose near copies are texts of five-word similarity 0.8 or
more. At 0.8 a bit differs with probability 0.15 (the angle of the two shingle sets over pi), so
64 bits are too few to tell 0.8 from 0.6, and no block of bits is sure to be equal. It takes 512
bits of the distinct shingles and a budget of ``WIDE_BUDGET`` in the same trie join. Buckets are
made of shared shingles instead of equal bits: a text goes to ``KEYS`` buckets, one for its least
shingle in each of as many orders, of which texts of similarity 0.8 share none with probability
0.2^KEYS. A bucket over ``WIDE_ROWS`` is dealt again by a second shared shingle, and a third, unless
it is a crowd of near copies: that one is joined by one task, in slices of bounded memory.

Edge cases: null and empty texts have fingerprint zero and are linked like any other; a
null doc_id takes part but is never a component's id (only a component of nulls has a null
one); repeated rows are each returned; an empty table gives an empty result; doc_id is an
integer. keep_one() tells rows apart by doc_id and text, so unrelated texts of one id, or of
none, all stay, with their columns of any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components, joined_labels
from .common import keep_first, stored, text_key

SHINGLE, SEED, BUDGET = 3, 42, 3
#: keep_one(): words of a shingle, bits (in words of 64) that may differ, orders, rows of a bucket that is not dealt again, and times that it is.
WIDE_SHINGLE, WIDE_WORDS, WIDE_BUDGET, KEYS, WIDE_ROWS, LEVELS = 5, 8, 90, 10, 1 << 15, 2
#: Rows of a bucket that is not split again, and rows that are joined at a time.
BUCKET_ROWS, CHUNK_ROWS = 1 << 10, 1 << 18
#: Pairs of nodes that go down the trie together, and of rows that are compared at once: they bound a task's memory.
FRONTIER, COMPARED = 1 << 18, 1 << 21
#: Shingles whose bits are counted at once.
COUNTED = 1 << 14


def shingle_digests(text: str | None, k: int) -> np.ndarray:
    """The XXH64 values of the text's k-word shingles, big-endian, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, ">u8")
    line = b" ".join(words)
    if len(words) <= k:
        return np.frombuffer(xxhash.xxh64_digest(line, SEED), ">u8")
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - k] + 1).tolist()]
    ends = [*gaps[k - 1 :].tolist(), len(line)]
    h = xxhash.xxh64_digest
    return np.frombuffer(b"".join([h(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)]), ">u8")


def majority(hashes: np.ndarray) -> bytes:
    """The bits that are set in over half of the rows of (n, words) big-endian hashes; none: zero."""
    ones = np.zeros(64 * hashes.shape[1], np.int64)
    for i in range(0, len(hashes), COUNTED):
        part = np.ascontiguousarray(hashes[i : i + COUNTED]).view(np.uint8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes)).tobytes()


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """64 bits, unsigned."""
    return int.from_bytes(majority(shingle_digests(text, k).reshape(-1, 1)), "big")


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """Another 64 bits of each 64 bits, by seed."""
    with np.errstate(over="ignore"):
        z = x + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def wide_fingerprint(text: str | None, k: int = WIDE_SHINGLE) -> tuple[bytes, np.ndarray]:
    """(WIDE_WORDS words of bits of the distinct shingles, KEYS keys); a text without words has no keys."""
    h = np.unique(shingle_digests(text, k).astype(np.uint64))
    if not len(h):
        return bytes(8 * WIDE_WORDS), np.zeros(0, np.int64)
    bits = np.stack([mixed(h, i) for i in range(1, WIDE_WORDS + 1)], axis=1)
    least = np.array([mixed(h, 100 + i).min() for i in range(KEYS)], np.uint64)
    return majority(bits.astype(">u8")), mixed(least, 99).view(np.int64)


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), k) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints)], ["doc_id", "txt", "fp"])

    return run


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, txt (the text's text_key()), fp long (the 64 bits, signed) of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key().alias("txt"))
    return rows.mapInArrow(_fingerprints(k), "doc_id long, txt long, fp long")


def _turned(bits: Column, fixed: int, by: int) -> Column:
    """bits with those after the first ``fixed`` rotated left by ``by``."""
    left = 64 - fixed
    if not by:
        return bits
    low = F.lit((1 << left) - 1 if left < 64 else -1).cast("long")
    head = bits.bitwiseAND(F.bitwise_not(low))
    rest = bits.bitwiseAND(low)
    turned = F.shiftleft(rest, by).bitwiseOR(F.shiftrightunsigned(rest, left - by)).bitwiseAND(low)
    return head.bitwiseOR(turned)


def _split(rows: DataFrame, fixed: int, budget: int) -> tuple[DataFrame, int]:
    """Each row into budget + 1 buckets: one block more of its bits is equal in a bucket."""
    size = max(1, (64 - fixed) // (budget + 1))
    turns = F.array(*(F.struct(F.lit(q).alias("q"), _turned(F.col("bits"), fixed, q * size).alias("bits")) for q in range(budget + 1)))
    out = rows.select("fp", "key", F.explode(turns).alias("t"))
    block = F.shiftrightunsigned(F.col("t.bits"), 64 - fixed - size)
    return out.select("fp", F.xxhash64("key", "t.q", block).alias("key"), F.col("t.bits").alias("bits")), fixed + size


def buckets(prints: DataFrame, budget: int = BUDGET, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """From distinct fp: (key, bits, fp); every pair within the budget shares a key, keys are small enough."""
    rows, fixed = _split(prints.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("bits")), 0, budget)
    done = None
    while fixed < 64 - budget:
        large = rows.groupBy("key").count().where(F.col("count") > bucket_rows).select("key")
        large = stored(large, "large")
        if large.isEmpty():
            break
        fits = rows.join(large, "key", "left_anti")
        done = fits if done is None else done.unionByName(fits)
        rows, fixed = _split(rows.join(large, "key", "left_semi"), fixed, budget)
        rows = stored(rows, "buckets")
    return rows if done is None else done.unionByName(rows)


def trie_forest(bits: np.ndarray, bounds: np.ndarray, budgets: Sequence[int] = range(1, BUDGET + 1)) -> np.ndarray:
    """For (n, words) bits, sorted and distinct within each bucket [bounds[k], bounds[k + 1]):
    the label of each row, the first row of its component of links within its bucket.
    """
    labels = np.arange(len(bits))
    for allowed in budgets:
        lo, hi = bounds[:-1], bounds[1:]
        some = hi - lo > 1
        left = [(0, np.stack([lo[some], hi[some], lo[some], hi[some], np.zeros(some.sum(), np.int64)]))]
        while left:
            depth, pairs = left.pop()
            if pairs.shape[1] > FRONTIER:
                left += [(depth, pairs[:, FRONTIER:]), (depth, pairs[:, :FRONTIER])]
                continue
            pairs = _still_apart(pairs, labels)
            pairs, labels = _settle(pairs, bits, allowed, labels)
            pairs = _descend(pairs, bits, depth, allowed)
            if pairs.shape[1]:
                left.append((depth + 1, pairs))
    return labels


def _still_apart(pairs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Without the pairs of nodes whose rows are all in one component."""
    if not pairs.shape[1]:
        return pairs
    turns = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])  # where labels change along the rows
    a, b, c, d, _ = pairs
    one = (turns[a] == turns[b - 1]) & (turns[c] == turns[d - 1]) & (labels[a] == labels[c])
    return pairs[:, ~one]


def _settle(pairs: np.ndarray, bits: np.ndarray, allowed: int, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compares the rows of small pairs of nodes at once, COMPARED at a time; (the other pairs, labels after that)."""
    count = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
    small = count <= 16 * bits.shape[1] ** 2
    todo, rest = pairs[:, small], pairs[:, ~small]
    blocks = np.cumsum(count[small]) // COMPARED
    for block in np.split(np.arange(todo.shape[1]), np.flatnonzero(np.diff(blocks)) + 1) if todo.shape[1] else ():
        a, b, c, d, _ = _still_apart(todo[:, block], labels)
        n = (b - a) * (d - c)
        at = np.repeat(np.arange(len(a)), n)
        k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        i, j = a[at] + k // (d - c)[at], c[at] + k % (d - c)[at]
        own = i < j
        i, j = i[own], j[own]
        near = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64) <= allowed
        if near.any():
            labels = joined_labels(labels, i[near], j[near])
    return rest, labels


def _descend(pairs: np.ndarray, bits: np.ndarray, depth: int, allowed: int) -> np.ndarray:
    """The pairs of children; those that part at this bit spend one bit more."""
    if not pairs.shape[1]:
        return pairs
    here = (bits[:, depth >> 6] >> np.uint64(63 - (depth & 63))) & np.uint64(1)
    ones = np.concatenate([[0], np.cumsum(here).astype(np.int64)])
    a, b, c, d, e = pairs
    am, cm = b - (ones[b] - ones[a]), d - (ones[d] - ones[c])
    other = a != c
    parts = [
        np.stack([a, am, c, cm, e]),
        np.stack([am, b, cm, d, e]),
        np.stack([a, am, cm, d, e + 1]),
        np.stack([am, b, c, cm, e + 1])[:, other],
    ]
    out = np.concatenate(parts, axis=1)
    a, b, c, d, e = out
    return out[:, (b > a) & (d > c) & (e <= allowed) & ~((a == c) & (b - a == 1))]


def _forest(budgets: Sequence[int], chunk_rows: int, words: int = 1):
    """From rows key, bits, fp (or key and fp, which are the bits), sorted by key: a spanning forest of each key's links, whole keys at a time."""

    def as_words(column: pa.ChunkedArray) -> np.ndarray:
        if words == 1:
            return column.to_numpy().view(np.uint64).reshape(-1, 1)
        return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, words)

    def links(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key, bits = rows.column(0).to_numpy(), as_words(rows.column(1))
        order = np.lexsort((*bits.T[::-1], key))
        key, bits = key[order], bits[order]
        first = np.append(True, (key[1:] != key[:-1]) | (bits[1:] != bits[:-1]).any(axis=1))
        order, key, bits = order[first], key[first], bits[first]
        bounds = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]).astype(np.int64)
        labels = trie_forest(bits, bounds, budgets)
        to = np.flatnonzero(labels != np.arange(len(labels)))
        fp = rows.column(rows.num_columns - 1)
        out = pa.table({"a": fp.take(pa.array(order[to])), "b": fp.take(pa.array(order[labels[to]]))})
        yield from out.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= chunk_rows:
                x = pa.Table.from_batches(held)
                key = x.column(0).to_numpy()
                before = np.flatnonzero(key != key[-1])
                at = int(before[-1]) + 1 if len(before) else 0
                if at:
                    yield from links(x.slice(0, at))
                held, rows = x.slice(at).to_batches(), x.num_rows - at
        if rows:
            yield from links(pa.Table.from_batches(held))

    return run


def link_forest(prints: DataFrame, budget: int = BUDGET, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """From distinct fp: edges (a, b) that connect exactly the fingerprints that links connect."""
    rows = buckets(prints, budget, bucket_rows).select("key", "bits", "fp")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_forest(range(1, budget + 1), CHUNK_ROWS), "a long, b long")


def components(prints: DataFrame, budget: int = BUDGET, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """From (doc_id, fp) rows, which are read several times: fp, root (the same in a component only), component_id of every distinct fp."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    linked = connected_components(link_forest(distinct.select("fp"), budget, bucket_rows))
    linked = linked.select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = distinct.join(linked, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, budget: int = BUDGET, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp, component_id of every document."""
    prints = stored(fingerprints(docs, k), "fingerprints")
    return prints.join(components(prints, budget, bucket_rows), "fp").select("doc_id", "fp", "component_id")


def _wide(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                fps, keys = zip(*(wide_fingerprint(t.as_py(), k) for t in part.column(2)), strict=True)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps, pa.binary()), lists],
                    ["doc_id", "txt", "fp", "keys"])

    return run


def shingle_buckets(prints: DataFrame, wide_rows: int = WIDE_ROWS) -> DataFrame:
    """From (fp, keys): (key, fp). A bucket over wide_rows is dealt by one more of its rows' keys, LEVELS times.

    A bucket most of whose rows share half of all keys stays as it is: that is a crowd of near copies, which
    dealing would copy and not divide, and in which the join prunes what is connected.
    """
    rows = prints.select(F.explode("keys").alias("key"), "keys", "fp").withColumn("used", F.array("key"))
    done = None
    for _ in range(LEVELS):
        large = stored(rows.groupBy("key").count().where(F.col("count") > wide_rows), "large")
        if large.isEmpty():
            break
        others = F.explode(F.array_except("keys", "used")).alias("other")
        shared = rows.join(large, "key").select("key", "count", others).groupBy("key", "count", "other").agg(F.count("*").alias("n"))
        crowds = shared.where(F.col("n") * 2 > F.col("count")).groupBy("key").agg(F.count("*").alias("common")).where(F.col("common") >= KEYS // 2)
        dealt = stored(large.join(crowds, "key", "left_anti").select("key"), "dealt_keys")
        fits = rows.join(dealt, "key", "left_anti")
        done = fits if done is None else done.unionByName(fits)
        more = rows.join(dealt, "key", "left_semi").select("keys", "fp", "used", others)
        more = more.select("keys", "fp", F.array_sort(F.concat("used", F.array("other"))).alias("used"))
        rows = stored(more.select(F.xxhash64("used").alias("key"), "keys", "fp", "used").distinct(), "dealt")
    rows = rows if done is None else done.unionByName(rows)
    return rows.select("key", "fp")


def near_roots(docs: DataFrame, k: int = WIDE_SHINGLE, budget: int = WIDE_BUDGET, wide_rows: int = WIDE_ROWS) -> DataFrame:
    """doc_id, txt (text_key() of the text), root of every row: rows of one root are near copies, directly or in a chain."""
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("txt"), F.col("text").cast("string"))
    rows = stored(rows.mapInArrow(_wide(k), "doc_id long, txt long, fp binary, keys array<long>"), "fingerprints")
    buckets_ = shingle_buckets(rows.select("fp", "keys").distinct(), wide_rows).repartition("key").sortWithinPartitions("key")
    budgets = [max(1, budget * part // 9) for part in (1, 3, 6, 9)]
    edges = buckets_.mapInArrow(_forest(budgets, CHUNK_ROWS, WIDE_WORDS), "a binary, b binary")
    linked = connected_components(edges).select(F.col("node").alias("fp"), "component")
    return rows.join(linked, "fp", "left").select("doc_id", "txt", F.coalesce("component", "fp").alias("root"))


def keep_one(docs: DataFrame, k: int = WIDE_SHINGLE, budget: int = WIDE_BUDGET, wide_rows: int = WIDE_ROWS) -> DataFrame:
    """docs with one row of each root: that of the least doc_id (null ids last), then of the least text_key()."""
    return keep_first(docs, stored(near_roots(docs, k, budget, wide_rows), "found"))


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
