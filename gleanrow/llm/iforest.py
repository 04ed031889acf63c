"""Quality rules: rule statistics of whole texts, judged by an isolation forest.

Per document the rules' counts are taken; ratios of them are the features. Trees are grown
from rows labelled good, by random splits of the box that all labelled rows span, so regions
without good rows are cut off early and have short paths. The anomaly score is
2^(-mean path / expected path); a row is rejected above the threshold that finds most rows
labelled bad while at most ``max_false`` of the rows labelled good are rejected.

All labelled documents that pass the base rules count: each tree draws its ``TREE_ROWS`` rows from all
that are labelled good, the box is that of all, and the threshold is the exact one for the scores of all.
Up to ``few`` rows that is done on the driver, beyond it by tasks. Every document is counted and judged.

Edge cases: a null text has no words and fails the base rules; without rows of
both labels the forest is grown from all labelled rows (from all documents if there are no
labels) and only rejects scores above ``NO_LABEL_SCORE``; repeated rows are each judged; an
empty table gives an empty result; null labels and ids are not fitted on; doc_id is an integer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SYMBOLS = "#*$%&|<>"
FEW, MAX_FALSE, NO_LABEL_SCORE = 20_000, 0.002, 0.75
TREES, TREE_ROWS = 128, 256
SEED = 7

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_marks")
FEATURES = 6
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS + MORE)


def rule_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS and MORE of one text: words, their code points, symbols, repeated lines, words in
    repeated 3-word windows; then upper-case A-Z, exclamation and question marks."""
    text = text or ""
    data = text.encode()
    words = data.split()  # bytes: ASCII white space only
    n = len(words)
    spaces = len(data) - sum(map(len, words))
    codes = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    symbols = int(codes[[ord(c) for c in SYMBOLS]].sum())
    lines = data.split(b"\n")
    dup = 0
    if len(lines) > 1:
        seen = set()
        for line in lines:
            if line in seen:
                dup += 1
            elif line.strip():
                seen.add(line)
    return (n, len(text) - spaces, symbols, dup, repeated_words(words), int(codes[65:91].sum()), int(codes[[33, 63]].sum()))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == n:
        return 0
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair[:-1] * len(number) + ids[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order] = np.append(same, False) | np.append(False, same)
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i : n - 2 + i] |= twice
    return int(covered.sum())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *COUNTS, *MORE]
    for batch in batches:
        if batch.num_rows:
            rows = np.array([rule_counts(t.as_py()) for t in batch.column(1)], np.int64).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in rows)], names)


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id with COUNTS and MORE of every document's whole text."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_count, SCHEMA)


def features(x: dict[str, np.ndarray]) -> np.ndarray:
    """Ratios, one row per document; roots of those near zero, so that random cuts fall there too."""
    n = np.maximum(x["n_words"], 1.0)
    chars = np.maximum(x["word_chars"], 1.0)
    shares = [x["n_symbols"] / n, x["n_repeat_words"] / n, x["n_dup_lines"] / n, x["n_upper"] / chars, x["n_marks"] / n]
    return np.stack([*(np.sqrt(s) for s in shares), chars / n], axis=1)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _expected(n: np.ndarray | float):
    """Mean path of a search that fails among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 1, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), 0.0)


class Forest:
    """Trees as arrays: feature and cut of each inner node of a complete tree, path length of each leaf."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, path: np.ndarray, rows: int, threshold: float):
        self.feature, self.cut, self.path, self.rows, self.threshold = feature, cut, path, rows, threshold

    @classmethod
    def grow(cls, points: np.ndarray, box: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
        rows = min(rows, len(points))
        return cls.grow_each(lambda rng, _: points[rng.choice(len(points), rows, replace=False)], rows, box.min(axis=0), box.max(axis=0), trees, seed)

    @classmethod
    def grow_each(cls, drawn, rows: int, low: np.ndarray, high: np.ndarray, trees: int = TREES, seed: int = SEED) -> Forest:
        """drawn(rng, t): the rows of tree t; low, high: the box."""
        rng = np.random.default_rng(seed)
        depth = max(1, math.ceil(math.log2(max(rows, 2)))) + 2
        feature = np.zeros((trees, 2**depth - 1), np.int16)
        cut = np.full((trees, 2**depth - 1), np.inf)
        path = np.zeros((trees, 2**depth))
        for t in range(trees):
            own = drawn(rng, t)
            cls._grow(rng, own, low, high, 0, 0, depth, feature[t], cut[t], path[t])
        return cls(feature, cut, path, rows, NO_LABEL_SCORE)

    @classmethod
    def _grow(cls, rng, own, low, high, node, level, depth, feature, cut, path) -> None:
        wide = np.flatnonzero(high > low)
        if level == depth or len(own) <= 1 or not len(wide):
            first = (node - (2**level - 1)) << (depth - level)
            path[first : first + (1 << (depth - level))] = level + _expected(len(own))
            return
        f = rng.choice(wide)
        c = rng.uniform(low[f], high[f])
        feature[node], cut[node] = f, c
        left_high, right_low = high.copy(), low.copy()
        left_high[f] = right_low[f] = c
        less = own[:, f] < c
        cls._grow(rng, own[less], low, left_high, 2 * node + 1, level + 1, depth, feature, cut, path)
        cls._grow(rng, own[~less], right_low, high, 2 * node + 2, level + 1, depth, feature, cut, path)

    def score(self, x: np.ndarray) -> np.ndarray:
        total, inner = np.zeros(len(x)), self.feature.shape[1]
        rows = np.arange(len(x))
        for feature, cut, path in zip(self.feature, self.cut, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (x[rows, feature[node]] >= cut[node])
            total += path[node - inner]
        return 2.0 ** (-total / len(self.path) / max(float(_expected(self.rows)), 1e-9))

    def calibrate(self, good: np.ndarray, bad: np.ndarray, max_false: float = MAX_FALSE) -> None:
        """The threshold halfway to the next score that rejects most of bad, at most max_false of good."""
        g, b = np.sort(self.score(good)), np.sort(self.score(bad))
        least = g[max(0, len(g) - 1 - int(max_false * len(g)))]
        above = b[b > least]
        self.threshold = float((least + above[0]) / 2) if len(above) else float(least)


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Rule statistics and quality of the labelled documents that pass the base rules; without labels, of all, with a null quality."""
    judged = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")) & F.col("doc_id").isNotNull())
    known = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").alias("_id"), "quality")
    if known.isEmpty():
        return judged.select("doc_id", *COUNTS, *MORE, F.lit(None).cast("int").alias("quality"))
    return judged.join(known, F.col("doc_id") == F.col("_id")).select("doc_id", *COUNTS, *MORE, "quality")


def fit(stats: DataFrame, labels: DataFrame, max_false: float = MAX_FALSE, few: int = FEW) -> Forest:
    """A forest from the rule statistics of all labelled documents."""
    rows = stored(labelled(stats, labels), "labelled")
    total, n_good, n_bad = rows.agg(F.count("*"), F.count_if(F.col("quality") > 0), F.count_if(F.col("quality") == 0)).first()
    if not total:
        return Forest.grow(np.zeros((1, FEATURES)), np.zeros((1, FEATURES)))
    if total > few:
        return _fit_by_tasks(rows, total, n_good, n_bad, max_false)
    own = rows.toPandas().sort_values(["doc_id", *COUNTS], ignore_index=True)
    x = features({c: own[c].to_numpy() for c in COUNTS + MORE})
    if not n_good or not n_bad:
        return Forest.grow(x, x)
    good, bad = (own["quality"] > 0).to_numpy(), (own["quality"] == 0).to_numpy()
    forest = Forest.grow(x[good], x)
    forest.calibrate(x[good], x[bad], max_false)
    return forest


X = [f"x{i}" for i in range(FEATURES)]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = features({c: batch.column(c).to_numpy() for c in COUNTS + MORE})
            yield pa.RecordBatch.from_arrays([batch.column("draw"), batch.column("quality"), *(pa.array(c) for c in x.T)], ["draw", "quality", *X])


def _draws(key: np.ndarray, tree: int) -> np.ndarray:
    """A number from 0 to 2^64 - 1 of each row for a tree."""
    z = key.astype(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _drawn(limit: int, trees: int):
    """tree, number and features of the rows whose number for a tree is at most limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("draw").to_numpy().view(np.uint64)
            x = [batch.column(c).to_numpy() for c in X]
            for t in range(trees):
                number = _draws(key, t)
                at = np.flatnonzero(number <= np.uint64(limit))
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t)), pa.array((number[at] >> np.uint64(1)).astype(np.int64)),
                        *(pa.array(c[at]) for c in x)], ["tree", "number", *X])

    return run


def _fit_by_tasks(rows: DataFrame, total: int, n_good: int, n_bad: int, max_false: float) -> Forest:
    """fit() of more rows than the driver should hold: it gets the rows that the trees draw, and counts of scores."""
    kind = ", ".join(f"{c} double" for c in X)
    keyed = rows.select(*COUNTS, *MORE, F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id", *COUNTS, *MORE).alias("draw"))
    points = stored(keyed.mapInArrow(_featured, f"draw long, quality int, {kind}"), "points")
    box = points.agg(*(f(c) for f in (F.min, F.max) for c in X)).first()
    both = bool(n_good and n_bad)
    pool, n = (points.where("quality > 0"), n_good) if both else (points, total)
    size, share = min(TREE_ROWS, n), 4 * TREE_ROWS / n
    while True:  # the rows with the least numbers of a tree are among those up to limit, if these are enough
        limit = min(2**64 - 1, int(share * 2**64))
        found = pool.mapInArrow(_drawn(limit, TREES), f"tree long, number long, {kind}").toPandas().sort_values(["tree", "number", *X])
        held = [part[X].to_numpy()[:size] for _, part in found.groupby("tree")]
        if share >= 1 or (len(held) == TREES and min(map(len, held)) == size):
            break
        share *= 4
    forest = Forest.grow_each(lambda _, t: held[t], size, np.array(box[:FEATURES], float), np.array(box[FEATURES:], float))
    if not both:
        return forest
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([batch.column(c).to_numpy() for c in X], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(shared.value.score(x))], ["quality", "score"])

    scores = stored(points.mapInArrow(score, "quality int, score double"), "scores")
    least = _from_top(scores.where("quality > 0"), min(int(max_false * n_good), n_good - 1))
    above = scores.where((F.col("quality") == 0) & (F.col("score") > least)).agg(F.min("score")).first()[0]
    forest.threshold = least if above is None else (least + above) / 2
    return forest


def _from_top(scores: DataFrame, rank: int, bins: int = 1024) -> float:
    """The score that rank others come before, from the highest, by counts of ever narrower ranges."""
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    while low < high:
        place = F.least(F.floor((F.col("score") - low) / (high - low) * bins), F.lit(bins - 1))
        per = scores.where(F.col("score").between(low, high)).groupBy(place.alias("at")).agg(F.count("*"), F.min("score"), F.max("score"))
        for _, n, least, most in sorted(map(tuple, per.collect()), reverse=True):  # at most bins rows
            if rank < n:
                low, high = least, most
                break
            rank -= n
    return float(low)


def _judge(forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for batch in batches:
            if batch.num_rows:
                score = f.score(features({c: batch.column(c).to_numpy() for c in COUNTS + MORE}))
                told = [batch.column(c) for c in ["doc_id", *COUNTS]]
                yield pa.RecordBatch.from_arrays([*told, pa.array(score), pa.array(score <= f.threshold)],
                    ["doc_id", *COUNTS, "score", "usual"])

    return run


def judge(docs: DataFrame, labels: DataFrame, few: int = FEW, max_false: float = MAX_FALSE) -> DataFrame:
    """doc_id, COUNTS, score, base_failed, kept of every document."""
    stats = stored(rule_statistics(docs), "rules")
    forest = docs.sparkSession.sparkContext.broadcast(fit(stats, labels, max_false, few))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double, usual boolean"
    judged = stats.mapInArrow(_judge(forest), schema).withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    return judged.select("doc_id", *COUNTS, "score", "base_failed", (~F.col("base_failed") & F.col("usual")).alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, few: int = FEW, max_false: float = MAX_FALSE) -> DataFrame:
    """docs without the rejected rows: each row is counted and judged where it lies, no text is shuffled."""
    forest = docs.sparkSession.sparkContext.broadcast(fit(stored(rule_statistics(docs), "rules"), labels, max_false, few))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.array([rule_counts(t.as_py()) for t in batch.column(at)], np.int64).T
            x = dict(zip(COUNTS + MORE, rows, strict=True))
            failed = (x["n_words"] < 50) | (100 * x["n_repeat_words"] > 50 * x["n_words"])
            yield batch.filter(pa.array(~failed & (f.score(features(x)) <= f.threshold)))

    # mapInArrow looks its columns up by name: names with dots or backticks are put aside for it
    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)
