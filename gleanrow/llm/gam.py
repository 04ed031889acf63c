"""Quality classifier: a generalised additive model with pairwise interactions.

Ratios of counts over the whole text are the features. Each is cut into bins at quantiles of the
sample, and the model is an intercept, a table of one number per bin for each feature, and a table
over the bins of two features for each chosen pair; a score is the logistic of their sum. Tables
are learned by cyclic boosting: round after round each feature in turn gets a shallow tree, fitted
to the gradient left by all the others, whose leaves are added to its table. Then pairs are ranked
by how much a two-way cut explains of what is left, and the best ones are boosted alike.

The model is fitted on at most ``sample_rows`` labelled rows that are not held out, those with the
least hash of their id: a documented bound, read nowhere else. Every document is counted and scored,
by adding up table entries of whole batches. Labels, lang, source and doc_id are no inputs.

Edge cases: a null text is an empty one, and empty texts get a score like any other; without
labelled rows every score is 0.5; with rows of one label only, all scores are that label's share with
one row of each label added; repeated rows are each scored; very long texts are counted whole; an
empty table gives an empty result; null labels and ids are not learned from; columns of other names
are ignored; doc_id is an integer.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .iforest import rule_counts

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 64, 16, 6
ROUNDS, PAIR_ROUNDS, LEAVES = 120, 60, 3
RATE, SHRINK, LEAST_ROWS = 0.1, 2.0, 8.0
#: A document with this score or more is predicted to be of good quality.
GOOD = 0.7

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_digits", "n_lines", "n_distinct",
    "n_doubled", "n_commonest")
FEATURES = ("length", "symbols", "repeats", "dup_lines", "upper", "marks", "digits", "line_words", "distinct", "doubled", "commonest", "word_length")
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text: rule counts, digits, lines with a word, distinct words, words equal to the one before, and the commonest word."""
    text = text or ""
    data = text.encode()
    words = data.split()  # bytes: ASCII white space only
    often = Counter(words)
    codes = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    doubled = sum(map(bytes.__eq__, words, words[1:]))
    lines = sum(1 for line in data.split(b"\n") if line.strip())
    return (*rule_counts(text), int(codes[48:58].sum()), lines, len(often), doubled, max(often.values(), default=0))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            rows = np.array([counts(t.as_py()) for t in batch.column(1)], np.int64).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in rows)], ["doc_id", *COUNTS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id with COUNTS of every document's whole text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_count, SCHEMA)


def features(x: dict[str, np.ndarray]) -> np.ndarray:
    """FEATURES, one row per document."""
    n, chars = np.maximum(x["n_words"], 1.0), np.maximum(x["word_chars"], 1.0)
    shares = [x[c] / n for c in ("n_symbols", "n_repeat_words", "n_dup_lines")]
    more = [x["n_upper"] / chars, x["n_marks"] / n, x["n_digits"] / chars, n / np.maximum(x["n_lines"], 1)]
    return np.stack([np.log1p(x["n_words"]), *shares, *more, *(x[c] / n for c in ("n_distinct", "n_doubled", "n_commonest")), chars / n], axis=1)


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Ascending cuts between bins: halfway between neighbouring values at the quantiles."""
    known = np.unique(values)
    if len(known) > bins:
        known = np.unique(np.quantile(values, np.linspace(0, 1, bins), method="nearest"))
    return (known[1:] + known[:-1]) / 2


def _sums(at: np.ndarray, gradient: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """Rows, gradients and weights by bin: (3, size)."""
    return np.stack([np.bincount(at, minlength=size), np.bincount(at, gradient, size), np.bincount(at, weight, size)]).astype(float)


def _worth(sums: np.ndarray) -> np.ndarray:
    """How much of the loss a leaf with these sums takes away."""
    return sums[1] ** 2 / (sums[2] + SHRINK)


def best_cut(sums: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of (3, bins) into two leaves of LEAST_ROWS rows each; 0 for none."""
    if sums.shape[1] < 2:
        return 0.0, 0
    left = sums.cumsum(axis=1)[:, :-1]
    whole = sums.sum(axis=1, keepdims=True)
    right = whole - left
    gain = _worth(left) + _worth(right) - _worth(whole)
    gain[(left[0] < LEAST_ROWS) | (right[0] < LEAST_ROWS)] = 0.0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def tree(sums: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """One number per bin: a tree of a few leaves, grown where the gain is largest."""
    parts = [(0, sums.shape[1])]
    while len(parts) < leaves:
        found = [(*best_cut(sums[:, a:b]), k) for k, (a, b) in enumerate(parts)]
        gain, cut, k = max(found, key=lambda x: x[0])
        if gain <= 1e-9:
            break
        a, b = parts.pop(k)
        parts += [(a, a + cut), (a + cut, b)]
    out = np.zeros(sums.shape[1])
    for a, b in parts:
        whole = sums[:, a:b].sum(axis=1)
        out[a:b] = whole[1] / (whole[2] + SHRINK)
    return out


def pair_tree(sums: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a tree over (3, a, b) bins: one cut of one axis, then one of the other on either side."""
    best, values = 0.0, np.zeros(sums.shape[1:])
    for turned in (False, True):
        s = sums.transpose(0, 2, 1) if turned else sums
        whole = float(_worth(s.sum(axis=(1, 2))))
        left = s.cumsum(axis=1)
        for cut in range(1, s.shape[1]):
            sides = left[:, cut - 1], left[:, -1] - left[:, cut - 1]
            cuts = [best_cut(side) for side in sides]
            gain = sum(g + float(_worth(side.sum(axis=1))) for (g, _), side in zip(cuts, sides, strict=True)) - whole
            if gain > best + 1e-9:
                own = np.zeros(s.shape[1:])
                for (g, c), side, rows in zip(cuts, sides, (slice(0, cut), slice(cut, None)), strict=True):
                    for cols in (slice(0, c), slice(c, None)) if g > 0 else (slice(None),):
                        part = side[:, cols].sum(axis=1)
                        own[rows, cols] = part[1] / (part[2] + SHRINK) if part[0] >= LEAST_ROWS else 0.0
                best, values = gain, own.T if turned else own
    return best, values


class Model:
    """Bin edges and tables."""

    def __init__(self, edges: list[np.ndarray], intercept: float):
        self.edges, self.intercept = edges, intercept
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.coarse = [e[np.unique(np.linspace(0, len(e) - 1, min(len(e), PAIR_BINS - 1)).astype(int))] if len(e) else e for e in edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for at, table in zip(self.bins(x, self.edges), self.tables, strict=True):
            total += table[at]
        if self.pairs:
            at = self.bins(x, self.coarse)
            for (i, j), table in self.pairs.items():
                total += table[at[i], at[j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))

    @classmethod
    def fit(cls, x: np.ndarray, good: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, pairs: int = PAIRS) -> Model:
        """From features and 0/1 labels."""
        share = (good.sum() + 1) / (len(good) + 2)
        model = cls([quantile_edges(x[:, f], BINS) if len(x) else np.zeros(0) for f in range(len(FEATURES))], float(np.log(share / (1 - share))))
        if good.min(initial=1) == good.max(initial=0):
            return model
        total = np.full(len(x), model.intercept)

        def left() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-total))
            return good - p, p * (1 - p)

        fine = model.bins(x, model.edges)
        for _ in range(rounds):
            for at, table in zip(fine, model.tables, strict=True):
                more = RATE * tree(_sums(at, *left(), len(table)))
                table += more
                total += more[at]
        coarse = model.bins(x, model.coarse)
        size = [len(e) + 1 for e in model.coarse]
        # a pair's bins as one number
        both = {(i, j): coarse[i] * size[j] + coarse[j] for i, j in combinations(range(len(size)), 2)}
        shaped = lambda pair, g: _sums(both[pair], *g, size[pair[0]] * size[pair[1]]).reshape(3, size[pair[0]], size[pair[1]])
        gradient = left()
        ranked = sorted(both, key=lambda pair: (-pair_tree(shaped(pair, gradient))[0], pair))[:pairs]
        model.pairs = {pair: np.zeros((size[pair[0]], size[pair[1]])) for pair in ranked}
        for _ in range(pair_rounds):
            for pair, table in model.pairs.items():
                more = RATE * pair_tree(shaped(pair, left()))[1]
                table += more
                total += more[coarse[pair[0]], coarse[pair[1]]]
        return model


def held_out(doc_id: Column) -> Column:
    """Whether a row's label may not be learned from; rows without id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from statistics() and labels (doc_id, quality), without the held-out rows."""
    known = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id"), "quality")
    known = known.where(~held_out(F.col("_id")))
    ids = known.orderBy(F.xxhash64("_id"), "_id", "quality").limit(sample_rows)
    rows = stats.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).drop("_id")
    sample = rows.orderBy(F.xxhash64("doc_id"), *rows.columns).limit(sample_rows).toPandas()  # ids may be repeated: the bound is one of rows
    sample = sample.sort_values(["doc_id", *COUNTS, "quality"], ignore_index=True)
    x = features({c: sample[c].to_numpy(float) for c in COUNTS}) if len(sample) else np.zeros((0, len(FEATURES)))
    return Model.fit(x, (sample["quality"] > 0).to_numpy(float))


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, COUNTS, held_out, score, predicted of every document."""
    stats = stored(statistics(docs), "counts")
    model = docs.sparkSession.sparkContext.broadcast(fit(stats, labels, sample_rows))  # some tables of a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = features({c: batch.column(c).to_numpy() for c in COUNTS})
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.value.score(x))], ["doc_id", *COUNTS, "score"])

    scored = stats.mapInArrow(run, SCHEMA + ", score double")
    return scored.select("doc_id", *COUNTS, held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"))
