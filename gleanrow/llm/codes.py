"""Vector codes: product quantisation with codebooks trained by Yinyang Lloyd rounds.

Components become integers, vectors are cut into parts, and each part position has a codebook. A
codebook's entries are put into groups once; every vector keeps, per part, its code and one lower
bound per group: no entry of that group but its own is nearer. When entries have moved, the bounds
are lowered by how far the group's fastest entry went, and only groups whose bound is not above the
exact distance to the vector's own entry are looked at again.

Bounds are only ever rounded down and a group is passed over only if its bound is strictly above, so
every entry that could be as near is compared. Comparisons are of exact integers: squared distances
are sums of products below 2^53 in double precision where the components allow it, and of 64-bit
integers else; ties go to the lower index.

A round is one Spark job without a shuffle of vectors: each task reads its vectors with their codes
and bounds, assigns them, and writes them again, and beside them one table of counts and sums; those
are added up by Spark to at most parts x entries rows, from which the driver gets the next codebooks.
The tables of a round are removed when the next one stands.

Edge cases: rows whose vector is null or has null, NaN or infinite components are dropped, and so are
empty vectors and those whose length is not that of the row with the least id; if the length is no
multiple of the parts, vectors are filled up with zeros; null ids come last, and rows of one id are
told apart by their vectors; repeated rows are each coded; fewer rows than entries give smaller
codebooks; null labels are one label; an empty table gives an empty result; columns of other names
are ignored. Components beyond ``MOST`` in size are an error, as their distances are beyond a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, new_path, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Groups of the entries of a codebook: each costs two bytes a vector and part.
GROUPS = 16
#: Largest integer component, in size.
MOST = 1 << 26
#: Rows assigned at a time, and labels whose sums are broadcast.
SLICE, BROADCAST_LABELS = 4096, 200_000
ROW = "vec_id long, label {label}, x binary, code binary, low binary, sums array<struct<part:int,entry:int,n:bigint,s:array<bigint>>>"


def components(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v array<long>: floor(scale * component) of the rows that are kept."""
    v = F.col("embedding").cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v")).where(F.size("v") > 0).where(sound)
    whole = F.transform("v", lambda x: F.floor(x * scale).cast("long"))
    big = F.exists("v", lambda x: F.abs(x * scale) > MOST)
    refused = F.raise_error(F.lit(f"a component times {scale} is over {MOST}")).cast("array<bigint>")
    return rows.select("vec_id", "label", F.when(big, refused).otherwise(whole).alias("v"))


def first_entries(rows: DataFrame, entries: int, parts: int) -> list[np.ndarray]:
    """Codebooks of the rows with the least ids: entries rows at most come to the driver."""
    found = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    return cut(np.array([r["v"] for r in found], np.int64), parts)


def cut(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    """Columns of each part; zeros are added where the length is no multiple."""
    vectors = np.pad(vectors, ((0, 0), (0, -vectors.shape[1] % parts)))
    return np.split(vectors, parts, axis=1)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, entries) of integers, as integers or as doubles that hold them exactly."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if int(most) ** 2 * 4 * max(1, x.shape[1]) < 1 << 53:
        a, b = x.astype(float), entries.astype(float)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    out = np.empty((len(x), len(entries)), np.int64)
    for j, e in enumerate(entries):
        out[:, j] = ((x - e) ** 2).sum(1)
    return out


def grouped(entries: np.ndarray, groups: int = GROUPS, rounds: int = 5) -> np.ndarray:
    """The group of each entry, by a few plain rounds over the codebook itself."""
    groups = max(1, min(groups, len(entries)))
    centres = entries[np.linspace(0, len(entries) - 1, groups).astype(int)].astype(float)
    for _ in range(rounds):
        at = ((entries[:, None, :] - centres) ** 2).sum(2).argmin(1)
        for g in range(groups):
            if (at == g).any():
                centres[g] = entries[at == g].mean(0)
    return at


def rounded_down(x: np.ndarray) -> np.ndarray:
    """The upper 16 bits of numbers x >= 0 in single precision: never above x, and never more than a hundredth below."""
    return (np.minimum(x * (1 - 1e-7), 3e38).astype(np.float32).view(np.uint32) >> 16).astype(np.uint16)


def bounds(low: np.ndarray) -> np.ndarray:
    """The numbers behind rounded_down()."""
    return (low.astype(np.uint32) << 16).view(np.float32).astype(float)


class Codebook:
    """The entries of one part position, their groups, and how far each group has moved at most since the last round."""

    def __init__(self, entries: np.ndarray, group: np.ndarray, drift: np.ndarray | None = None):
        self.entries, self.group = entries, group
        self.members = [np.flatnonzero(group == g) for g in range(group.max(initial=0) + 1)]
        self.drift = drift if drift is not None else np.zeros(len(self.members))

    def moved(self, counts: np.ndarray, sums: np.ndarray) -> Codebook:
        """The codebook of the next round: floored means, unused entries as they are."""
        used = counts > 0
        entries = self.entries.copy()
        entries[used] = sums[used] // counts[used][:, None]
        far = np.sqrt(((entries - self.entries).astype(float) ** 2).sum(1)) * (1 + 1e-12)
        return Codebook(entries, self.group, np.array([far[m].max(initial=0) for m in self.members]))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code, squared distance and lower bounds of vectors that have none yet."""
        d = squared(x, self.entries)
        code = d.argmin(1)  # the first of equals
        at = np.arange(len(x))
        best = d[at, code]
        d = d.astype(float)
        d[at, code] = np.inf
        low = np.stack([d[:, m].min(1, initial=np.inf) for m in self.members], axis=1)
        return code, best, rounded_down(np.sqrt(low) * (1 - 1e-12))

    def again(self, x: np.ndarray, code: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The same from the last round's codes and bounds; last, how many distances were taken."""
        own = self.entries[code]
        start = ((x - own) ** 2).sum(1)
        low = np.maximum(bounds(low) - self.drift, 0.0) * (1 - 1e-12)
        open_ = low <= np.sqrt(start.astype(float))[:, None] * (1 + 1e-12)
        best, now, taken = start.copy(), code.copy(), len(x)
        seen: list[tuple[int, np.ndarray, np.ndarray]] = []
        for g, m in enumerate(self.members):
            rows = np.flatnonzero(open_[:, g])
            if not len(rows) or not len(m):
                continue
            d = squared(x[rows], self.entries[m])
            taken += d.size
            k = d.argmin(1)
            least, entry = d[np.arange(len(rows)), k].astype(np.int64), m[k]
            better = (least < best[rows]) | ((least == best[rows]) & (entry < now[rows]))
            best[rows[better]], now[rows[better]] = least[better], entry[better]
            seen.append((g, rows, d))
        # a group's bound leaves out the own entry: of groups that were looked at it is taken anew
        for g, rows, d in seen:
            m = self.members[g]
            d = d.astype(float)
            mine = self.group[now[rows]] == g
            d[np.flatnonzero(mine), np.searchsorted(m, now[rows[mine]])] = np.inf
            low[rows, g] = np.sqrt(d.min(1, initial=np.inf)) * (1 - 1e-12)
        left = np.flatnonzero(now != code)  # the entry that was left counts again in its group
        g = self.group[code[left]]
        low[left, g] = np.minimum(low[left, g], np.sqrt(start[left].astype(float)) * (1 - 1e-12))
        return now, best, rounded_down(low), taken


def _encoded(x: list[np.ndarray]) -> pa.Array:
    whole = np.ascontiguousarray(np.concatenate(x, axis=1))
    return pa.array([r.tobytes() for r in whole], pa.binary())


def _decoded(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _round(books, last: bool):
    """A task's part of a round: its rows with new codes and bounds, then one row of sums (last: distances instead)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[Codebook] = books.value
        width = [b.entries.shape[1] for b in some]
        ends = np.cumsum(width)[:-1]
        groups = np.cumsum([len(b.members) for b in some])[:-1]
        counts = [np.zeros(len(b.entries), np.int64) for b in some]
        sums = [np.zeros_like(b.entries) for b in some]
        label = None
        for big in batches:
            for at in range(0, big.num_rows, SLICE):
                batch = big.slice(at, SLICE)
                label = batch.schema.field("label").type
                x = np.split(_decoded(batch.column("x"), np.int32).astype(np.int64), ends, axis=1)
                fresh = batch.column("code").null_count > 0
                if fresh:
                    found = [b.assign(part) for b, part in zip(some, x, strict=True)]
                else:
                    code = _decoded(batch.column("code"), np.uint8).astype(int)
                    low = np.split(_decoded(batch.column("low"), np.uint16), groups, axis=1)
                    found = [b.again(part, code[:, p], low[p])[:3] for p, (b, part) in enumerate(zip(some, x, strict=True))]
                codes = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
                head = [batch.column("vec_id"), batch.column("label")]
                if last:
                    error = sum(f[1].astype(np.int64) for f in found)
                    yield pa.RecordBatch.from_arrays([*head, pa.array([r.tobytes().hex() for r in codes]), pa.array(error)],
                        ["vec_id", "label", "code", "error"])
                    continue
                for p, (f, part) in enumerate(zip(found, x, strict=True)):
                    counts[p] += np.bincount(f[0], minlength=len(counts[p]))
                    # of equal codes side by side the sums are differences of running sums
                    order = np.argsort(f[0], kind="stable")
                    used, start = np.unique(f[0][order], return_index=True)
                    sums[p][used] += np.add.reduceat(part[order], start, axis=0)
                arrays = [*head, batch.column("x"), _encoded([codes]), _encoded([f[2] for f in found])]
                yield _rows(arrays, None)
        if label is not None and not last:
            told = [{"part": p, "entry": int(e), "n": int(counts[p][e]), "s": sums[p][e].tolist()} for p in range(len(some)) for e in
                np.flatnonzero(counts[p])]
            yield _rows([pa.nulls(1, pa.int64()), pa.nulls(1, label), *(pa.nulls(1, pa.binary()) for _ in range(3))], told)

    return run


def _rows(arrays: list[pa.Array], sums: list[dict] | None) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))]))
    told = pa.nulls(len(arrays[0]), kind) if sums is None else pa.array([sums], kind)
    return pa.RecordBatch.from_arrays([*arrays, told], ["vec_id", "label", "x", "code", "low", "sums"])


def _next_books(table: DataFrame, books: list[Codebook]) -> list[Codebook]:
    """Codebooks from the sums of all tasks: at most parts x entries rows come to the driver."""
    wide = max(b.entries.shape[1] for b in books)
    one = table.where("sums is not null").select(F.explode("sums").alias("s")).select("s.*")
    added = one.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(wide)))
    counts = [np.zeros(len(b.entries), np.int64) for b in books]
    sums = [np.zeros_like(b.entries) for b in books]
    for r in added.collect():
        counts[r["part"]][r["entry"]] = r["n"]
        sums[r["part"]][r["entry"]] = [r[f"s{i}"] for i in range(wide)]
    return [b.moved(n, s) for b, n, s in zip(books, counts, sums, strict=True)]


def codebooks_digest(books: list[Codebook]) -> str:
    """SHA-256 of all entries' components, by part, entry and place."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.entries.ravel().tolist()).encode()).hexdigest()


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[Codebook]]:
    """vec_id, label, code (hex), error of every row kept, as a table; and the codebooks."""
    spark = vectors.sparkSession
    rows = components(vectors, scale)
    least = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").first()
    if least is None:
        none = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).where("false")
        return none, []
    length = len(least["v"])
    rows = rows.where(F.size("v") == length)
    books = [Codebook(e, grouped(e)) for e in first_entries(rows, entries, parts)]
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), -length % parts))
    packed = rows.select("vec_id", "label", filled.alias("v"))
    label = packed.schema["label"].dataType.simpleString()
    schema = ROW.format(label=label)
    table = packed.mapInArrow(_packed, schema)
    path = None
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        new = new_path(spark, "codes")
        table.mapInArrow(_round(shared, False), schema).write.parquet(new)
        if path:
            dropped(spark, path)
        path, table = new, spark.read.schema(schema).parquet(new)
        books = _next_books(table, books)
        table = table.where("sums is null")
    shared = spark.sparkContext.broadcast(books)
    out = stored(table.mapInArrow(_round(shared, True), f"vec_id long, label {label}, code string, error long"), "coded")
    if path:
        dropped(spark, path)
    return out, books


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            flat = batch.column(2).flatten().to_numpy().astype(np.int32).reshape(batch.num_rows, -1)
            nulls = [pa.nulls(batch.num_rows, pa.binary()) for _ in range(2)]
            yield _rows([batch.column(0), batch.column(1), _encoded([flat]), *nulls], None)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row kept."""
    coded, books = train(vectors, parts, entries, rounds)
    sums = stored(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "labels")
    # labels are few as a rule; many of them are joined by a shuffle, which splits a hot one
    few = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    out = coded.join(few, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
