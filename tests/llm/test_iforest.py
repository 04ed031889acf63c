import math
import random
import re
from collections import Counter

import numpy as np

from gleanrow.llm import iforest

from .helpers import ODD, documents, prose


def plain_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(wins)
    cov = {j for i, x in enumerate(wins) if c[x] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cov)


def junk(rng, kind, n):
    w = [f"w{rng.randrange(400)}" for _ in range(n)]
    return {"symbols": " ".join(x + "$$$" for x in w), "pipes": " | ".join(w), "shouts": "!! ".join(w).upper()}[kind]


def corpus():
    rng = random.Random(9)
    good = [prose(rng, rng.randrange(60, 400)) for _ in range(300)]
    bad = [junk(rng, k, rng.randrange(60, 300)) for k in ("symbols", "pipes", "shouts") for _ in range(20)]
    return good, bad


def test_counts(spark):
    rng = random.Random(10)
    texts = [*ODD, *(prose(rng, n, 6) for n in range(1, 60)), "a b c a b c", "l x\nl x\n \n \nl x", "# * $"]
    rows = iforest.rule_statistics(documents(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in iforest.COUNTS) for r in rows] == [plain_counts(t) for t in texts]


def test_junk_goes_and_clean_documents_stay(spark):
    good, bad = corpus()
    texts = good + bad + ODD
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i < len(good)), 0) for i in range(len(good) + len(bad)) if i % 2] + [(3, None, 1),
        (None, 0, 0)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in iforest.judge(docs, labels).collect()}
    kept = [rows[i]["kept"] for i in range(len(texts))]
    assert sum(kept[: len(good)]) >= 0.98 * len(good)
    assert sum(kept[len(good) : len(good) + len(bad)]) <= 0.1 * len(bad)
    assert not any(kept[len(good) + len(bad) :])
    assert rows[len(texts) - 1]["base_failed"]
    left = iforest.keep(docs, labels)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i, k in enumerate(kept) if k]


def test_no_labels_and_empty_table(spark):
    good, _ = corpus()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = iforest.judge(documents(spark, good), none).collect()
    assert sum(r["kept"] for r in rows) >= 0.95 * len(good)
    assert iforest.judge(documents(spark, []), none).count() == 0
    assert iforest.keep(documents(spark, []), none).count() == 0
    assert iforest.judge(documents(spark, ["a b"] * 2, [1, 1]), none).count() == 2


def test_far_points_have_short_paths():
    rng = np.random.default_rng(0)
    points = rng.normal(0, 0.1, (500, 5))
    forest = iforest.Forest.grow(points, np.concatenate([points, np.full((1, 5), 3.0)]))
    far, near = forest.score(np.full((1, 5), 2.5)), forest.score(points[:50])
    assert far[0] > near.max()


def plain_forest(points, box, trees, rows, seed):
    """(trees as nested tuples, rows): the same draws, without arrays of nodes."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(points))
    most = max(1, math.ceil(math.log2(max(rows, 2)))) + 2

    def mean(n):
        return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 1 else 0.0

    def grow(own, low, high, level):
        wide = [f for f in range(len(low)) if high[f] > low[f]]
        if level == most or len(own) <= 1 or not wide:
            return level + mean(len(own))
        f = rng.choice(np.array(wide))
        c = rng.uniform(low[f], high[f])
        less = [p for p in own if p[f] < c]
        more = [p for p in own if not p[f] < c]
        left = grow(less, low, [c if i == f else x for i, x in enumerate(high)], level + 1)
        return (f, c, left, grow(more, [c if i == f else x for i, x in enumerate(low)], high, level + 1))

    out = []
    for _ in range(trees):
        own = [list(points[i]) for i in rng.choice(len(points), rows, replace=False)]
        out.append(grow(own, list(box.min(axis=0)), list(box.max(axis=0)), 0))
    return out, mean(rows)


def plain_score(forest, x):
    trees, expected = forest
    total = 0.0
    for node in trees:
        while isinstance(node, tuple):
            f, c, left, right = node
            node = right if x[f] >= c else left
        total += node
    return 2 ** (-total / len(trees) / max(expected, 1e-9))


def plain_verdicts(rows, labels):
    """(score, kept) of (doc_id, text) rows, by labels (doc_id, quality): counts, forest, threshold and verdicts in plain Python."""

    def point(t):
        n, chars, symbols, dup, rep = plain_counts(t)
        words, letters = max(n, 1), max(chars, 1)
        upper, marks = len(re.findall("[A-Z]", t or "")), len(re.findall("[!?]", t or ""))
        return [math.sqrt(symbols / words), math.sqrt(rep / words), math.sqrt(dup / words), math.sqrt(upper / letters),
            math.sqrt(marks / words), letters / words]

    counts = [plain_counts(t) for _, t in rows]
    failed = [c[0] < 50 or 100 * c[4] > 50 * c[0] for c in counts]
    fit = [(i, c[0], c[1], c[2], c[3], c[4], q, t) for (i, t), c, f in zip(rows, counts, failed, strict=True) for j, q in labels if i == j and not f]
    fit.sort(key=lambda r: r[:6])
    x, q = np.array([point(r[-1]) for r in fit]), np.array([r[6] for r in fit])
    forest = plain_forest(x[q > 0], x, iforest.TREES, iforest.TREE_ROWS, iforest.SEED)
    g, b = (sorted(plain_score(forest, p) for p in x[q == k]) for k in (1, 0))
    least = g[max(0, len(g) - 1 - int(iforest.MAX_FALSE * len(g)))]
    above = [s for s in b if s > least]
    threshold = (least + above[0]) / 2 if above else least
    scores = [plain_score(forest, point(t)) for _, t in rows]
    return [(s, not f and s <= threshold) for s, f in zip(scores, failed, strict=True)]


def test_scores_and_verdicts_against_plain(spark):
    good, bad = corpus()
    good, bad = good[:120], bad[:30]
    texts = good + bad + ODD
    labels = [(i, int(i < len(good)), 0) for i in range(len(good) + len(bad)) if i % 2]
    rows = {r["doc_id"]: r for r in iforest.judge(documents(spark, texts),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    for i, (score, kept) in enumerate(plain_verdicts(list(enumerate(texts)), [(i, q) for i, q, _ in labels])):
        assert math.isclose(rows[i]["score"], score, rel_tol=1e-9)
        assert rows[i]["kept"] == kept


def test_all_labelled_rows_count_beyond_the_few(spark):
    """With more rows than the driver fits, trees draw from all, and box and threshold are those of all."""
    good, bad = corpus()
    texts = good + bad
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i < len(good)), 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    stats = iforest.rule_statistics(docs)
    forest = iforest.fit(stats, labels, max_false=0.02, few=10)
    rows = iforest.labelled(stats, labels).toPandas()
    x = iforest.features({c: rows[c].to_numpy() for c in iforest.COUNTS + iforest.MORE})
    q = rows["quality"].to_numpy()
    other = iforest.Forest(forest.feature, forest.cut, forest.path, forest.rows, 0.0)
    other.calibrate(x[q > 0], x[q == 0], 0.02)
    assert math.isclose(forest.threshold, other.threshold, rel_tol=1e-12)
    low, high = x.min(axis=0), x.max(axis=0)
    used = np.isfinite(forest.cut)
    assert (forest.cut[used] >= low[forest.feature[used]]).all() and (forest.cut[used] <= high[forest.feature[used]]).all()
    assert forest.rows == min(iforest.TREE_ROWS, int((q > 0).sum()))
    told = {r["doc_id"]: r["kept"] for r in iforest.judge(docs, labels, few=10, max_false=0.02).collect()}
    assert sum(told[i] for i in range(len(good))) > 0.9 * sum((q > 0))
    assert {r["doc_id"] for r in iforest.keep(docs, labels, few=10, max_false=0.02).collect()} == {i for i, k in told.items() if k}
