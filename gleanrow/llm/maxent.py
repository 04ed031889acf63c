"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

Tokens are words (A-Z lower-cased) and one end per text. Training documents are those whose
CRC-32 of the id, modulo ``FOLDS``, is not ``HELD_OUT``.

The model. P(w | h) = P(class | h) * P(unit | class, last word) * P(w | unit). The ``FREQUENT``
most frequent words are units of their own, in classes of ``CLASS_WORDS`` by rank. Every other
word, known or not, belongs to one of ``RARE_UNITS`` units of one of ``RARE`` classes: its letters
decide the class, its hash the unit, and in a unit words have their smoothed shares, with one
share for unknown words. The end is a class of its own. So all words have features and the
probabilities sum to one. Class logits are sums of hashed features of the history: bias, last
word (n-gram), the word before it (skip), and both together; unit logits are a bias and a hashed
feature of last word and unit. Histories are hashed real words: the most frequent have a bucket
each, all others share theirs by hash.

Training. All training tokens are counted, once for the vocabulary, once for (skip, last, class)
and (last, unit) events. Events are a table; the first pass starts the last-word weights at their
smoothed log odds, then each round sends the weights to the partitions of events, which return
the gradient of the log likelihood (observed less expected counts) and the likelihood itself.
The step is that gradient under a Gaussian prior, scaled per feature by its counts; a round that
does not raise the penalised likelihood is taken back and the step halved. Events are dealt by
groups of last words that share no hashed features, and a partition returns the features that it
has seen; all they return, and the number of possible events, is bounded by the hash sizes.

Scoring. Texts are scored in numpy batches from tables of fixed size. Counts of the
``BROADCAST_WORDS`` most frequent words travel with the model; tokens of other words are
joined with the counts of all words, so base scores and shares are exact. Words over ``LONGEST``
bytes are counted by their 128-bit digests.

Edge cases: a null or empty text has one token, its end; a null id is trained on and not
held out; repeated rows are each counted and scored; without training tokens V and N are
zero and every probability is that of an unknown word; an empty table gives an empty result;
doc_id is an integer; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, groupby, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

FOLDS, HELD_OUT = 7, 2
FREQUENT, CLASS_WORDS, RARE, RARE_UNITS = 8192, 128, 32, 64
UNITS = FREQUENT + RARE * RARE_UNITS
FREQUENT_CLASSES = FREQUENT // CLASS_WORDS
CLASSES = FREQUENT_CLASSES + RARE + 1
END_CLASS = CLASSES - 1
#: First unit of each class but the end's.
CLASS_STARTS = np.concatenate([np.arange(FREQUENT_CLASSES) * CLASS_WORDS, FREQUENT + np.arange(RARE) * RARE_UNITS])
#: History buckets: words of their own, hashed ones, and the start of a text.
LAST_OWN, LAST_HASHED, SKIP_OWN, SKIP_HASHED = 2048, 512, 96, 32
LASTS, SKIPS = LAST_OWN + LAST_HASHED + 1, SKIP_OWN + SKIP_HASHED + 1
LAST_START, SKIP_START = LASTS - 1, SKIPS - 1
#: Features of pairs and of (last, unit) lie in GROUPS by the last word, so that a partition of events has its own.
GROUPS, PAIRS, WORD_WEIGHTS = 64, 1 << 13, 1 << 18
#: Gradient rounds, first step, precision of the prior, and counts added to a feature's own in its scale.
ROUNDS, STEP, PRECISION, SMOOTH = 3, 0.5, 0.05, 3.0
#: Tokens whose events one level of merging takes; events of more are merged in parts first.
MERGED_TOKENS = 1 << 32
#: Keys of a block of events, a row of some 100 KB.
BLOCK = 1 << 13
EVENTS = "part long, group int, kind int, keys binary, n binary"
#: Words whose counts travel with the model, and the longest word that is kept as it is, in bytes.
BROADCAST_WORDS, LONGEST = 150_000, 64
#: Words, and tokens, that a task counts before it hands them on.
COUNTED, COUNTED_TOKENS = 1 << 19, 1 << 22


def tokens(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if words and max(map(len, words)) > LONGEST:
        # no word has a space
        return [w if len(w) <= LONGEST else b" " + hashlib.md5(w).digest() for w in words]
    return words


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def rare_class(word: bytes) -> int:
    """0 .. RARE - 1 by the word's non-ASCII letters and its last two bytes: these tell languages apart."""
    if word.isascii():
        return (word[-1] * 31 + (word[-2] if len(word) > 1 else 0)) % (RARE // 2)
    marks = sum(1 << (b & 7) for b in set(word) if 0xA0 <= b < 0xC0)
    return RARE // 2 + (marks * 7 + word[-1]) % (RARE // 2)


def places(word: bytes, rank: int) -> tuple[int, int, int]:
    """(unit, last bucket, skip bucket) of a word; ranks from FREQUENT on are all alike."""
    h = zlib.crc32(word)
    unit = rank if rank < FREQUENT else FREQUENT + rare_class(word) * RARE_UNITS + (h >> 16) % RARE_UNITS
    return unit, rank if rank < LAST_OWN else LAST_OWN + h % LAST_HASHED, rank if rank < SKIP_OWN else SKIP_OWN + (h >> 9) % SKIP_HASHED


#: Class of each unit; the last one is the end's, of unit -1.
CLASS_OF = np.append(np.repeat(np.arange(END_CLASS), np.diff(np.append(CLASS_STARTS, UNITS))), END_CLASS)


def pair_hash(skip: np.ndarray, last: np.ndarray) -> np.ndarray:
    return last % GROUPS * (PAIRS // GROUPS) + (skip * 7919 + last // GROUPS * 104729) % (PAIRS // GROUPS)


def word_hash(last: np.ndarray, unit: np.ndarray) -> np.ndarray:
    return last % GROUPS * (WORD_WEIGHTS // GROUPS) + (last // GROUPS * 1000003 + unit * 8191) % (WORD_WEIGHTS // GROUPS)


# -- vocabulary ---------------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if not held_out(doc):
                seen.update(tokens(text.as_py()))
                seen[b""] += 1  # the end: no word is empty
                if len(seen) >= COUNTED:
                    yield out()
                    seen.clear()
    if seen:
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """word binary (empty: the end), c long, over all training documents."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _zeros(*shape: int):
    return field(default_factory=lambda: np.zeros(shape, np.float32))


@dataclass
class Weights:
    """The trained part of a model; its size is fixed by the parameters above."""

    frequent: int = 0
    bias: np.ndarray = _zeros(CLASSES)
    last: np.ndarray = _zeros(LASTS, CLASSES)
    skip: np.ndarray = _zeros(SKIPS, CLASSES)
    pair: np.ndarray = _zeros(PAIRS, CLASSES)
    unit: np.ndarray = _zeros(UNITS)
    word: np.ndarray = _zeros(WORD_WEIGHTS)

    def blocks(self) -> list[np.ndarray]:
        return [self.bias, self.last, self.skip, self.pair, self.unit, self.word]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.blocks()])

    def set_flat(self, x: np.ndarray) -> None:
        at = 0
        for block in self.blocks():
            block[...] = x[at : at + block.size].reshape(block.shape)
            at += block.size

    def class_log_p(self, skip: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log probabilities of the classes after each history, logs of their softmax's sums)."""
        x = self.bias + self.last[last] + self.skip[skip] + self.pair[pair_hash(skip, last)]
        top = x.max(axis=1, keepdims=True)
        z = top + np.log(np.exp(x - top).sum(axis=1, keepdims=True))
        return x - z, z[:, 0]

    def unit_log_p(self, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log probabilities of the units in their classes after each last word, logs of the classes' sums)."""
        u = np.arange(UNITS)
        x = self.unit + self.word[word_hash(last[:, None], u[None, :])]
        there = (u < self.frequent) | (u >= FREQUENT)
        top = x.max(axis=1, keepdims=True)
        sums = np.add.reduceat(np.where(there, np.exp(x - top), 0), CLASS_STARTS, axis=1)
        z = np.log(np.maximum(sums, 1e-30)) + top  # a class without words has no tokens either
        sizes = np.diff(np.append(CLASS_STARTS, UNITS))
        return x - np.repeat(z, sizes, axis=1), z


@dataclass
class Model:
    """Everything a worker needs to score: at most BROADCAST_WORDS words and fixed tables."""

    n: int = 0
    v: int = 0
    words: list[bytes] = field(default_factory=list)  # by rank, the end left out
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    end_count: int = 0
    unit_total: np.ndarray = field(default_factory=lambda: np.zeros(UNITS))
    unit_types: np.ndarray = field(default_factory=lambda: np.zeros(UNITS))
    weights: Weights = field(default_factory=Weights)
    #: Penalised log likelihood per training token, at the start and after each round.
    history: list[float] = field(default_factory=list)
    class_z: np.ndarray = _zeros(0)
    unit_z: np.ndarray = _zeros(0)

    def finish(self) -> None:
        """The logs of all softmax sums, so that scoring needs no sum."""
        lasts = np.arange(LASTS)
        self.class_z = np.stack([self.weights.class_log_p(np.full(LASTS, s), lasts)[1] for s in range(SKIPS)]).astype(np.float32)
        self.unit_z = np.concatenate([self.weights.unit_log_p(lasts[i : i + 256])[1] for i in range(0, LASTS, 256)]).astype(np.float32)


class Reader:
    """Texts as arrays: rank, unit and histories of their tokens, several texts after one another."""

    def __init__(self, words: list[bytes]):
        self.known = {w: i for i, w in enumerate(words)} | {b"": -1}  # no word is empty: the end
        table = [places(w, i) for i, w in enumerate(words)] + [(0, 0, 0), (-1, 0, 0)]
        self.unit, self.last, self.skip = (np.array(x, np.int32) for x in zip(*table, strict=True))
        self.beyond = len(words)

    def read(self, texts: list[list[bytes]]):
        """rank (-1: the end, beyond: not a word that travels), unit, class, last, skip; the texts' first tokens;
        the places of words that do not travel, and these words. An end is appended to each text."""
        sizes = np.array([len(t) + 1 for t in texts])
        for t in texts:
            t.append(b"")
        flat = list(chain.from_iterable(texts))
        rank = np.fromiter(map(self.known.get, flat, repeat(self.beyond)), np.int32, len(flat))
        unit, as_last, as_skip = self.unit[rank], self.last[rank], self.skip[rank]
        strange = np.flatnonzero(rank == self.beyond)
        far = [flat[i] for i in strange.tolist()]
        if far:
            seen = {w: places(w, FREQUENT) for w in set(far)}
            unit[strange], as_last[strange], as_skip[strange] = np.array([seen[w] for w in far]).T
        starts = np.cumsum(sizes) - sizes
        # histories start anew with each text
        last, skip = np.append(LAST_START, as_last[:-1]), np.append([SKIP_START, SKIP_START], as_skip[:-2])[: len(flat)]
        last[starts], skip[starts] = LAST_START, SKIP_START
        skip[starts[sizes > 1] + 1] = SKIP_START
        return rank, unit.astype(np.int64), CLASS_OF[unit], last, skip, starts, strange, far


def _parts(batch: pa.RecordBatch, rows: int = 400) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


# -- training -----------------------------------------------------------------------------


def _blocks(part: int, group: int, kind: int, key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of EVENTS: keys (int32, sorted) and their counts (int64)."""
    for i in range(0, len(key), BLOCK):
        ints = [pa.array([part], pa.int64()), pa.array([group], pa.int32()), pa.array([kind], pa.int32())]
        blobs = [pa.array([x[i : i + BLOCK].astype(t).tobytes()], pa.binary()) for x, t in ((key, np.int32), (n, np.int64))]
        yield pa.RecordBatch.from_arrays([*ints, *blobs], ["part", "group", "kind", "keys", "n"])


def _last_of(kind: int, key: np.ndarray) -> np.ndarray:
    return key // CLASSES % LASTS if kind == 0 else key // UNITS


def _events(shared):
    def out(kind: int, keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        group = _last_of(kind, key) % GROUPS
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(GROUPS + 1))
        for g in range(GROUPS):
            own = order[bounds[g] : bounds[g + 1]]
            yield from _blocks(TaskContext.get().partitionId(), g, kind, key[own], n[own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        of_class, of_unit, held = [], [], 0
        for batch in batches:
            for part in _parts(batch):
                texts = [tokens(t.as_py()) for d, t in zip(part.column(0).to_pylist(), part.column(1), strict=True) if not held_out(d)]
                if not texts:
                    continue
                _, unit, cls, last, skip, *_ = reader.read(texts)
                of_class.append(((skip * LASTS + last) * CLASSES + cls).astype(np.int32))
                own = unit >= 0
                of_unit.append((last[own] * UNITS + unit[own]).astype(np.int32))
                held += len(unit)
                if held >= COUNTED_TOKENS:
                    yield from out(0, of_class)
                    yield from out(1, of_unit)
                    of_class, of_unit, held = [], [], 0
        if held:
            yield from out(0, of_class)
            yield from out(1, of_unit)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of EVENTS come sorted by part, group and kind; the events of each as blocks of sorted, distinct keys."""

    def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)

    rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for where, some in groupby(rows, key=itemgetter(0, 1, 2)):
        keys, counts, held = [], [], 0
        for *_, key, n in some:
            keys.append(np.frombuffer(key, np.int32))
            counts.append(np.frombuffer(n, np.int64))
            held += len(keys[-1])
            if held >= COUNTED_TOKENS:
                key, n = summed(keys, counts)
                keys, counts, held = [key], [n], 0
        yield from _blocks(*where, *summed(keys, counts))


def event_table(rows: DataFrame, words: list[bytes], tokens_: int) -> DataFrame:
    """EVENTS of all training tokens: each group's distinct keys, sorted, in one partition."""
    found = rows.mapInArrow(_events(rows.sparkSession.sparkContext.broadcast(words)), EVENTS)
    parts = max(1, -(-tokens_ // MERGED_TOKENS))
    order = ["part", "group", "kind"]
    if parts > 1:
        found = found.withColumn("part", F.pmod(F.col("part"), F.lit(parts)))
        found = found.repartition("part", "group").sortWithinPartitions(*order).mapInArrow(_merge, EVENTS)
    found = found.withColumn("part", F.lit(0).cast("long"))
    return stored(found.repartition(GROUPS, "group").sortWithinPartitions(*order).mapInArrow(_merge, EVENTS), "events")


def _sum_rows(total: np.ndarray, feature: np.ndarray, x: np.ndarray) -> None:
    order = np.argsort(feature, kind="stable")
    some, first = np.unique(feature[order], return_index=True)
    total[some] += np.add.reduceat(x[order], first, axis=0)


def _class_sums(w: Weights, key: np.ndarray, n: np.ndarray, seen: Weights, want: Weights) -> float:
    """Adds observed and expected counts of the class features; the events' log likelihood."""
    groups, at = np.unique(key // CLASSES, return_inverse=True)  # keys are sorted: contexts of a block lie together
    skip, last = groups // LASTS, groups % LASTS
    observed = np.bincount(at * CLASSES + key % CLASSES, n, len(groups) * CLASSES).reshape(-1, CLASSES)
    log_p, _ = w.class_log_p(skip, last)
    expected = np.exp(log_p) * observed.sum(axis=1, keepdims=True)
    for sums, x in ((seen, observed), (want, expected)):
        sums.bias += x.sum(axis=0)
        for block, feature in ((sums.last, last), (sums.skip, skip), (sums.pair, pair_hash(skip, last))):
            _sum_rows(block, feature, x)
    return float((observed * log_p).sum())


def _unit_sums(w: Weights, key: np.ndarray, n: np.ndarray, seen: Weights, want: Weights) -> float:
    """The same for the unit features, some last words at a time."""
    total = 0.0
    lasts = np.unique(key // UNITS)
    for i in range(0, len(lasts), 128):
        some = lasts[i : i + 128]
        lo, hi = np.searchsorted(key, (some[0] * UNITS, (some[-1] + 1) * UNITS))
        at = np.searchsorted(some, key[lo:hi] // UNITS)
        observed = np.bincount(at * UNITS + key[lo:hi] % UNITS, n[lo:hi], len(some) * UNITS).reshape(-1, UNITS)
        log_p, _ = w.unit_log_p(some)
        of_class = np.add.reduceat(observed, CLASS_STARTS, axis=1)
        expected = np.exp(log_p) * np.repeat(of_class, np.diff(np.append(CLASS_STARTS, UNITS)), axis=1)
        index = word_hash(some[:, None], np.arange(UNITS)[None, :]).ravel()
        for sums, x in ((seen, observed), (want, expected)):
            sums.unit += x.sum(axis=0)
            sums.word += np.bincount(index, x.ravel(), WORD_WEIGHTS)
        total += float(log_p[observed > 0] @ observed[observed > 0])
    return total


def _gradient(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row: this partition's log likelihood, the features that it has seen, their observed and expected counts."""
        w: Weights = shared.value
        seen, want, total = Weights(), Weights(), 0.0
        for batch in batches:
            for kind, key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                add = _unit_sums if kind else _class_sums
                total += add(w, np.frombuffer(key, np.int32).astype(np.int64), np.frombuffer(n, np.int64).astype(float), seen, want)
        seen, want = seen.flat(), want.flat()
        at = np.flatnonzero(want)
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (at.astype(np.int32), seen[at].astype(np.float32),
            want[at].astype(np.float32))]
        yield pa.RecordBatch.from_arrays([pa.array([total]), *blobs], ["total", "at", "seen", "want"])

    return run


def top_words(counts: DataFrame, most: int = BROADCAST_WORDS) -> tuple[list[bytes], np.ndarray]:
    """(words, counts) by falling count: all words over a count that at most ``most`` words reach.

    The count comes from a histogram of fixed size, so no task or driver sees more than ``most`` words.
    """
    short = counts.where(F.length("word") > 0)
    step = F.when(F.col("c") < 1024, F.col("c")).otherwise(1024 + F.floor((F.log2("c") - 10) * 64)).cast("long")
    histogram = sorted(((r["step"], r["n"]) for r in short.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()),
        reverse=True)
    least, taken = None, 0
    for s, n in histogram:
        if taken + n > most:
            break
        least, taken = s, taken + n
    if least is None:
        return [], np.zeros(0, np.int64)
    top = short.where(step >= least).select("word", "c").toArrow()
    words, n = top.column(0).to_pylist(), top.column(1).to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    return [words[i] for i in order], n[order]


def train(docs: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of docs' training documents; counts: word_counts(docs), as a table."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    end = counts.where(F.length("word") == 0).select("c").first()
    words, top = top_words(counts)
    m = Model(n=total["n"], v=total["v"], end_count=end["c"] if end else 0, words=words, counts=top)
    _unit_counts(m, counts)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    events = event_table(rows, m.words, m.n)
    w = m.weights
    w.frequent = min(FREQUENT, len(m.words))
    w.unit[:] = np.log(m.unit_total + 0.5)
    by_class = np.add.reduceat(m.unit_total, CLASS_STARTS)
    w.bias[:] = np.log(np.append(by_class, m.end_count) + 0.5)
    _ascend(m, events, rounds)
    m.finish()
    return m


def _unit_counts(m: Model, counts: DataFrame) -> None:
    """Tokens and types of every unit, over the whole vocabulary."""
    frequent = counts.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(m.words[:FREQUENT])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, own = np.zeros((2, UNITS), np.int64), frequent.value
        for batch in batches:
            for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if w:
                    unit = places(w, own.get(w, FREQUENT))[0]
                    sums[0, unit] += c
                    sums[1, unit] += 1
        at = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(x[at]) for x in sums)], ["unit", "total", "types"])

    found = counts.select("word", "c").mapInArrow(run, "unit long, total long, types long")
    for r in found.groupBy("unit").agg(F.sum("total").alias("total"), F.sum("types").alias("types")).collect():  # at most UNITS rows
        m.unit_total[r["unit"]], m.unit_types[r["unit"]] = r["total"], r["types"]


def _measured(w: Weights, events: DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
    """(log likelihood, observed, expected counts): sums over the partitions of events; their features hardly overlap."""
    shared = events.sparkSession.sparkContext.broadcast(w)
    found = events.select("kind", "keys", "n").mapInArrow(_gradient(shared), "total double, at binary, seen binary, want binary")
    total, (seen, want) = 0.0, np.zeros((2, sum(x.size for x in w.blocks())), np.float32)
    for r in found.where("length(at) > 0").collect():
        at = np.frombuffer(bytes(r["at"]), np.int32)
        total += r["total"]
        seen[at] += np.frombuffer(bytes(r["seen"]), np.float32)
        want[at] += np.frombuffer(bytes(r["want"]), np.float32)
    shared.unpersist()
    return total, seen, want


def _ascend(m: Model, events: DataFrame, rounds: int) -> None:
    """Rounds of scaled gradient steps on the penalised likelihood; m.history has its value after each."""
    w, n = m.weights, max(m.n, 1)
    total, seen, want = _measured(w, events)
    if not seen.any():
        return
    # biases stand for the priors of classes and units: the penalty leaves them alone
    units = slice(CLASSES + w.last.size + w.skip.size + w.pair.size, -WORD_WEIGHTS)
    penalty = np.full(len(seen), PRECISION, np.float32)
    penalty[:CLASSES] = penalty[units] = 0
    odds = np.log((seen + SMOOTH) / (want + SMOOTH))
    odds[:CLASSES] = odds[CLASSES + w.last.size : -WORD_WEIGHTS] = 0
    at, step = w.flat() + odds, STEP
    del odds
    value = lambda t, x: (t - float((penalty * x * x).sum(dtype=float)) / 2) / n
    w.set_flat(at)
    total, seen, want = _measured(w, events)
    best = value(total, at)
    m.history = [best]
    for _ in range(rounds):
        trial = at + step * (seen - want - penalty * at) / (np.maximum(seen, want) + SMOOTH)
        w.set_flat(trial)
        total, *counts = _measured(w, events)
        if value(total, trial) > best:
            at, best, (seen, want) = trial, value(total, trial), counts
        else:
            step /= 2
        m.history.append(best)
    w.set_flat(at)


# -- scoring ------------------------------------------------------------------------------

SCORED = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<struct<word:binary,k:long>>"


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        reader = Reader(m.words)
        w = m.weights
        base_of = np.log10(np.concatenate([m.counts + 1.0, [1.0, m.end_count + 1.0]])) - math.log10(m.n + m.v + 1)
        share = -np.log(m.unit_total + m.unit_types + 1)
        share[:FREQUENT] = 0
        more_of = np.append(np.log(m.counts + 1.0), [0.0, 0.0])  # a rare word's count, where it is known here
        more_of[:FREQUENT] = 0
        more_of[-2:] = 0
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in _parts(batch):
                ids = part.column(0).to_pylist()
                texts = [tokens(t.as_py()) for t in part.column(1)]
                rank, unit, cls, last, skip, starts, strange, far = reader.read(texts)
                of = lambda block, row: block.ravel().take(row * CLASSES + cls)
                p = w.bias[cls] + of(w.last, last) + of(w.skip, skip) + of(w.pair, pair_hash(skip, last))
                p = (p - m.class_z.ravel().take(skip * LASTS + last)).astype(float)
                own = unit >= 0
                u, prev = unit[own], last[own]
                p[own] += w.unit[u] + w.word[word_hash(prev, u)] - m.unit_z.ravel().take(prev * END_CLASS + cls[own]) + share[u]
                p += more_of[rank]
                base = base_of[rank]
                owner = np.searchsorted(starts, strange, side="right") - 1
                times = Counter(zip(owner.tolist(), far, strict=True))  # in the order of the texts
                sizes = [len(t) for t in texts]  # the end included
                n_known = np.add.reduceat((rank >= 0) & (rank < reader.beyond), starts) + int(m.end_count > 0)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(np.array([o for o, _ in times], np.int64),
                    minlength=len(ids)))]).astype(np.int32)
                words = pa.array([w for _, w in times], pa.binary())
                times = pa.array(list(times.values()), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(uid, uid + len(ids))), pa.array(ids, pa.int64()), pa.array([held_out(d) for d in ids]),
                    pa.array(sizes, pa.int64()), pa.array(n_known.astype(np.int64)),
                    pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(p, starts) / math.log(10)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([words, times], ["word", "k"])),
                ], [c.split(" ")[0] for c in SCORED.split(", ")])
                uid += len(ids)

    return run


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    part = stored(rows.mapInArrow(_score(shared), SCORED), "scores")
    # words that do not travel with the model: their tokens meet the counts of all words
    far = part.select("uid", F.explode("rare").alias("r")).select("uid", F.col("r.word").alias("word"), F.col("r.k").alias("k"))
    found = far.join(counts, "word")
    more = F.col("k") * F.log10(F.col("c") + 1)
    per = found.groupBy("uid").agg(F.sum("k").alias("known"), F.sum(more).alias("more"))
    out = part.drop("rare").join(per, "uid", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Trains on docs' training documents and scores all of docs."""
    counts = stored(word_counts(docs), "words")
    return score(docs, train(docs, counts, rounds), counts)
