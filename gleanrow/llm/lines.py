"""Line dedup by a sharded minimal perfect hash instead of a join of lines.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at
least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines
except in the largest doc_id holding them.

Keys are counted as 128-bit hashes, summed per task before they are shuffled. The keys of two or
more documents (those of one can be repeated nowhere) are dealt into shards of about
``SHARD_KEYS``; each shard becomes a minimal perfect hash (levels of bit arrays with ranks) that
indexes arrays of a 64-bit fingerprint, a document count and the largest doc_id. Documents probe
the arrays: hash, index, compare the fingerprint, then the count with ``min_docs``. Arrays of up
to ``max_broadcast`` bytes go to every worker; larger ones stay in tables, and hashes of lines are
dealt to the shards and probed there in streams, with the same result. There a shard is split over
one task for each ``TASK_LINES`` of the lines that its own counts say will come.

Edge cases: null and empty texts are one empty line; every row counts as a document, so
repeated rows of one doc_id each count and each keep their lines if that id is the largest;
a null doc_id is smaller than all others; empty tables give an empty result; doc_id is an
integer, and other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_CHARS, MIN_DOCS = 40, 5
SHARD_KEYS = 1 << 16
MAX_BROADCAST = 48 << 20
#: Bytes of a key in the arrays, the bits of its index included.
KEY_BYTES = 24
#: Keys that a task counts before it hands them on.
COUNTED = 1 << 18
NO_DOC = -(1 << 63)
#: Counts stop here, far above any threshold.
MOST_COUNTED = 2**32 - 1
#: Lines of a shard that one task probes.
TASK_LINES = 1 << 22


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> tuple[list[bytes], list[int], list[bytes]]:
    """(lines, numbers of those long enough to be keys, their 16-byte hashes)."""
    lines = (text or "").encode().split(b"\n")
    at, hashes = [], []
    for i, line in enumerate(lines):
        key = line.strip()  # bytes: ASCII white space only
        if len(key) >= min_chars and (key.isascii() or len(key.decode(errors="replace")) >= min_chars):
            at.append(i)
            hashes.append(xxhash.xxh3_128_digest(key.lower()))
    return lines, at, hashes


def _halves(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
    return x[:, 0], x[:, 1]


def _count(min_chars: int):
    def out(seen: dict[bytes, list[int]]) -> pa.RecordBatch:
        h, g = _halves(list(seen))
        n, most = np.array(list(seen.values()), np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (h, g, n, most)], ["h", "g", "n", "most"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc = NO_DOC if doc is None else doc
                for key in set(line_keys(text.as_py(), min_chars)[2]):
                    was = seen.get(key)
                    if was is None:
                        seen[key] = [1, doc]
                    else:
                        was[0] += 1
                        was[1] = max(was[1], doc)
                if len(seen) >= COUNTED:
                    yield out(seen)
                    seen = {}
        if seen:
            yield out(seen)

    return run


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """h, g (the key's hash), n documents, most: the largest doc_id, of the keys in two or more documents."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = rows.mapInArrow(_count(min_chars), "h long, g long, n long, most long")
    return counted.groupBy("h", "g").agg(F.sum("n").alias("n"), F.max("most").alias("most")).where("n > 1")


# -- the minimal perfect hash -------------------------------------------------------------


def _mixed(x: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit mix of x that differs by level."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class LineIndex:
    """One shard. Level k holds a bit for each of its slots that exactly one of the keys left hashes to."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray, prints: np.ndarray, counts: np.ndarray, most: np.ndarray):
        self.sizes, self.bits, self.ranks, self.prints, self.counts, self.most = sizes, bits, ranks, prints, counts, most

    @classmethod
    def build(cls, h: np.ndarray, g: np.ndarray, n: np.ndarray, most: np.ndarray) -> LineIndex:
        """h: distinct keys' hashes, g: their fingerprints. Keys with equal h are told apart by mixing in g."""
        key = h.view(np.uint64) ^ _mixed(g.view(np.uint64), 99)
        left, sizes, levels = np.arange(len(key)), [], []
        order = []
        while len(left):
            if len(sizes) > 200:
                raise ValueError("equal keys in a line index")
            size = max(64, -(-len(left) * 3 // 128) * 64)
            slot = (_mixed(key[left], len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            mine = alone[slot]
            order.append(left[mine][np.argsort(slot[mine])])
            levels.append(alone)
            sizes.append(size)
            left = left[~mine]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        order = np.concatenate(order) if order else np.zeros(0, np.int64)
        words = bits.reshape(-1, 64)
        ranks = np.concatenate([[0], np.cumsum(words.sum(axis=1))])[:-1].astype(np.uint32)
        return cls(np.array(sizes, np.int64), np.packbits(bits), ranks, g[order], np.minimum(n[order], MOST_COUNTED).astype(np.uint32),
            most[order])

    def find(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """The index of each key in the arrays, -1 for keys that are not there."""
        key = h.view(np.uint64) ^ _mixed(g.view(np.uint64), 99)
        out, left, base = np.full(len(key), -1), np.arange(len(key)), 0
        for level, size in enumerate(self.sizes):
            at = base + (_mixed(key[left], level) % np.uint64(size)).astype(np.int64)
            hit = (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
            spot, word = left[hit], at[hit] >> 6
            block = self.bits.reshape(-1, 8)[word].copy().view(">u8").ravel().astype(np.uint64)
            before = (at[hit] & 63).astype(np.uint64)
            ahead = np.where(before > 0, block >> (np.uint64(64) - np.maximum(before, np.uint64(1))), np.uint64(0))
            out[spot] = self.ranks[word].astype(np.int64) + np.bitwise_count(ahead)
            left, base = left[~hit], base + size
        there = out >= 0
        there[there] = self.prints[out[there]] == g[there]
        return np.where(there, out, -1)

    def gone(self, h: np.ndarray, g: np.ndarray, doc: np.ndarray, min_docs: int) -> np.ndarray:
        """Which lines go: in min_docs documents at least, of which their own is not the largest."""
        at = self.find(h, g)
        there = at >= 0
        own = at[there]
        there[there] = (self.counts[own] >= min_docs) & (self.most[own] != doc[there])
        return there

    def dump(self) -> bytes:
        f = io.BytesIO()
        np.savez(f, sizes=self.sizes, bits=self.bits, ranks=self.ranks, prints=self.prints, counts=self.counts, most=self.most)
        return f.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> LineIndex:
        with np.load(io.BytesIO(blob)) as z:
            return cls(*(z[k] for k in ("sizes", "bits", "ranks", "prints", "counts", "most")))


def _build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    h, g, n, most = (table.column(c).to_numpy() for c in ("h", "g", "n", "most"))
    blob = LineIndex.build(h, g, n, most).dump()
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "blob": pa.array([blob], pa.binary())})


def build_shards(shared: DataFrame, shards: int) -> DataFrame:
    """shard, blob: each shard's index, built where its keys meet (SHARD_KEYS of them on average)."""
    dealt = shared.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(_build, "shard int, blob binary")


def _dropped(index: dict[int, LineIndex], shards: int, h: np.ndarray, g: np.ndarray, doc: np.ndarray, min_docs: int) -> np.ndarray:
    """Which lines go, each by the index of its shard."""
    gone, shard = np.zeros(len(h), bool), np.mod(h, shards)
    for s in np.unique(shard):
        own = index.get(int(s))
        if own is not None:
            at = np.flatnonzero(shard == s)
            gone[at] = own.gone(h[at], g[at], doc[at], min_docs)
    return gone


def _rewritten(doc, lines: list[bytes], gone: list[int]):
    lost = set(gone)
    kept = b"\n".join([x for i, x in enumerate(lines) if i not in lost] if lost else lines)
    return doc, kept.decode(), len(lines), len(gone)


OUT = "doc_id long, kept string, n_lines long, n_dropped long"
_OUT = pa.schema([("doc_id", pa.int64()), ("kept", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])


def _as_batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(_OUT)], schema=_OUT)


def _probe(blobs, shards: int, min_chars: int, min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {s: LineIndex.load(b) for s, b in blobs.value}
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                docs = part.column(0).to_pylist()
                keys = [line_keys(t.as_py(), min_chars) for t in part.column(1)]
                owner = np.repeat(np.arange(len(docs)), [len(k[1]) for k in keys])
                at = np.array([i for k in keys for i in k[1]], np.int64)
                ids = np.array([NO_DOC if d is None else d for d in docs], np.int64)
                gone = _dropped(index, shards, *_halves([x for k in keys for x in k[2]]), ids[owner], min_docs)
                lost: dict[int, list[int]] = {}
                for i in np.flatnonzero(gone):
                    lost.setdefault(int(owner[i]), []).append(int(at[i]))
                yield _as_batch([_rewritten(d, k[0], lost.get(i, [])) for i, (d, k) in enumerate(zip(docs, keys, strict=True))])

    return run


def _hashed(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                keys = [line_keys(t.as_py(), min_chars) for t in part.column(2)]
                n = [len(k[1]) for k in keys]
                h, g = _halves([x for k in keys for x in k[2]])
                doc = np.array([NO_DOC if d is None else d for d in part.column(1).to_pylist()], np.int64)
                line = np.array([i for k in keys for i in k[1]], np.int64)
                uid = np.repeat(part.column(0).to_numpy(), n)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (uid, np.repeat(doc, n), line, h, g)],
                    ["uid", "doc_id", "line", "h", "g"])

    return run


def _probe_stream(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """uid and line of the lines that go. Rows come sorted by shard, each shard's index before its lines."""
        index = None
        for batch in batches:
            blobs = batch.column(5)
            marks = np.flatnonzero(blobs.is_valid().to_numpy(zero_copy_only=False)).tolist()
            for a, b in zip([-1, *marks], [*marks, batch.num_rows], strict=True):
                if a >= 0:
                    index = LineIndex.load(blobs[a].as_py())
                if index is None or b - a < 2:
                    continue
                uid, doc, line, h, g = (batch.column(i).slice(a + 1, b - a - 1).to_numpy() for i in range(5))
                gone = index.gone(h, g, doc, min_docs)
                yield pa.RecordBatch.from_arrays([pa.array(uid[gone]), pa.array(line[gone])], ["uid", "line"])

    return run


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 1000):
            part = batch.slice(i, 1000)
            rows = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)
            yield _as_batch([_rewritten(doc, (text or "").encode().split(b"\n"), gone or []) for doc, text, gone in rows])


def _drop_dealt(rows: DataFrame, shared: DataFrame, shards: int, min_chars: int, min_docs: int) -> DataFrame:
    """For indexes of any size: lines' hashes are dealt to their shard, a hot shard to several tasks."""
    shard = F.pmod("h", F.lit(shards)).cast("int").alias("shard")
    tasks = F.ceil(F.sum("n") / F.lit(TASK_LINES)).cast("int").alias("tasks")
    deal = stored(shared.groupBy(shard).agg(tasks), "deal")
    built = build_shards(shared, shards)
    base = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "texts").select("uid", "doc_id", "text")
    lines = base.mapInArrow(_hashed(min_chars), "uid long, doc_id long, line long, h long, g long").select(shard, "uid", "doc_id", "line",
        "h", "g")
    # 8 bytes a shard; lines of a shard without keys cannot go
    lines = lines.join(F.broadcast(deal) if shards <= 1 << 20 else deal, "shard")
    salt = F.pmod(F.xxhash64("uid", "line"), F.col("tasks")).cast("int").alias("salt")
    lines = lines.select("shard", salt, F.lit(1).alias("kind"), "uid", "doc_id", "line", "h", "g", F.lit(None).cast("binary").alias("blob"))
    none = [F.lit(0).cast("long").alias(c) for c in ("uid", "doc_id", "line", "h", "g")]
    marks = built.join(deal, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"),
        F.lit(0).alias("kind"), *none, "blob")
    dealt = lines.unionByName(marks).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    gone = dealt.select("uid", "doc_id", "line", "h", "g", "blob").mapInArrow(_probe_stream(min_docs), "uid long, line long")
    per = gone.groupBy("uid").agg(F.collect_list("line").alias("gone"))
    return base.join(per, "uid", "left").select("doc_id", "text", "gone").mapInArrow(_rewrite, OUT)


def drop_repeated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """doc_id, kept (the text without the dropped lines), n_lines, n_dropped of every document. min_docs: 2 or more."""
    spark = docs.sparkSession
    shared = stored(shared_lines(docs, min_chars), "lines")
    n = shared.count()
    shards = max(1, -(-n // SHARD_KEYS))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if n * KEY_BYTES <= max_broadcast:
        built = build_shards(shared, shards)
        blobs = spark.sparkContext.broadcast([(r["shard"], bytes(r["blob"])) for r in built.collect()])
        return rows.mapInArrow(_probe(blobs, shards, min_chars, min_docs), OUT)
    return _drop_dealt(rows, shared, shards, min_chars, min_docs)
