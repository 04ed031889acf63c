import bisect
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from gleanrow.llm import gam

from .helpers import ODD, documents, prose


def plain_counts(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
        sum("A" <= c <= "Z" for c in t), sum(c in "!?" for c in t), sum("0" <= c <= "9" for c in t), len(lines), len(set(words)),
        sum(a == b for a, b in zip(words, words[1:], strict=False)), max(Counter(words).values(), default=0))


def plain_score(model, counts):
    x = gam.features({c: np.array([float(v)]) for c, v in zip(gam.COUNTS, counts, strict=True)})[0]
    total = model.intercept
    for f, (edges, table) in enumerate(zip(model.edges, model.tables, strict=True)):
        total += table[bisect.bisect_right(edges.tolist(), x[f])]
    for (i, j), table in model.pairs.items():
        total += table[bisect.bisect_right(model.coarse[i].tolist(), x[i]), bisect.bisect_right(model.coarse[j].tolist(), x[j])]
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def corpus():
    rng = random.Random(8)
    texts, good = [], []
    for i in range(400):
        text = prose(rng, rng.randrange(5, 300))
        if i % 4 == 0:
            text = rng.choice([text.upper() + "!!", " ".join(w + "###" for w in text.split()), " ".join([text.split()[0]] * 200), text.replace(" ", " | ")])
        texts.append(text)
        good.append(int(i % 4 != 0))
    return texts, good


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_counts_of_odd_texts():
    for t in [*ODD, "a\n\na\n b \na", "x x x y", "A1!? #", "word " * 20_000]:
        assert gam.counts(t) == plain_counts(t)


def test_held_out_rows_and_plain_sums(spark):
    texts, good = corpus()
    texts += ODD
    docs = documents(spark, texts)
    labels = [(i, q, 0) for i, q in enumerate(good)] + [(None, 1, 0), (5, None, 0)]
    schema = "doc_id long, quality int, toxic int"
    rows = {r["doc_id"]: r for r in gam.classify(docs, spark.createDataFrame(labels, schema)).collect()}
    assert len(rows) == len(texts) and all(rows[i]["held_out"] == held(i) for i in rows)
    told = [i for i in range(len(good)) if held(i)]
    assert sum(rows[i]["predicted"] == good[i] for i in told) >= 0.95 * len(told)
    x = gam.features(dict(zip(gam.COUNTS, np.array([plain_counts(texts[i]) for i in range(len(good)) if not held(i)], float).T, strict=True)))
    model = gam.Model.fit(x, np.array([good[i] for i in range(len(good)) if not held(i)], float))
    assert model.pairs and all(np.abs(t).max() > 0 for t in model.pairs.values())
    for i, t in enumerate(texts):
        assert tuple(rows[i][c] for c in gam.COUNTS) == plain_counts(t)
        assert abs(rows[i]["score"] - plain_score(model, plain_counts(t))) < 1e-9
        assert rows[i]["predicted"] == int(rows[i]["score"] >= 0.7)
    # labels of held-out rows, and of all other columns, change nothing
    other = [(i, 1 - q if held(i) else q, 1) for i, q in enumerate(good)]
    again = {r["doc_id"]: r["score"] for r in gam.classify(docs, spark.createDataFrame(other, schema)).collect()}
    assert again == {i: r["score"] for i, r in rows.items()}


def test_pairs_are_learned():
    """Of an exclusive or, single features tell nothing; a pair does."""
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(gam.FEATURES)))
    good = ((x[:, 2] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    alone = gam.Model.fit(x, good, pairs=0)
    model = gam.Model.fit(x, good, pairs=1)
    right = lambda m: ((m.score(x) > 0.5) == good).mean()
    assert set(model.pairs) == {(2, 7)}
    assert right(alone) < 0.7 < 0.9 < right(model)


def test_tables_without_labels(spark):
    schema = "doc_id long, quality int, toxic int"
    docs = documents(spark, ["a b", None, "c", "c"], ids=[1, None, 3, 3])
    none = gam.classify(docs, spark.createDataFrame([], schema)).collect()
    assert [r["score"] for r in none] == [0.5] * 4
    kept = next(i for i in (1, 3) if not held(i))
    one = gam.classify(docs, spark.createDataFrame([(kept, 1, 0)], schema)).collect()
    assert all(r["score"] > 0.6 for r in one) and len(one) == 4
    assert gam.classify(documents(spark, []), spark.createDataFrame([], schema)).collect() == []
