import random
import re
from collections import Counter, defaultdict

import pytest

from gleanrow.llm import mixing

from .helpers import ODD, documents


def plain_targets(sizes):
    total = sum(sizes.values()) * 1.5
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free = {}, set(names)
    while True:
        left, w = total - sum(target.values()), sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / w >= 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
        if not free:
            break
    return target | {s: left * weight[s] / w for s in free}


def corpus():
    rng = random.Random(11)
    texts = [" ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(1, 90))) for _ in range(400)] + ODD
    sources = [rng.choice(["a", "b", "c", "é", "Z", None, "a"]) for _ in texts]
    return texts, sources


def test_targets_and_takes(spark):
    texts, sources = corpus()
    docs = documents(spark, texts, sources=sources)
    rows = mixing.mix_report(docs).collect()
    sizes = defaultdict(int)
    for t, s in zip(texts, sources, strict=True):
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or ""))
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert taken[s] == pytest.approx(t, rel=0.1 if s != "Z" else 0.5)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix_report(docs.repartition(3)).collect()), key=str)


def test_copies_are_rows(spark):
    texts, sources = corpus()
    docs = documents(spark, texts, sources=sources)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    n = Counter(r["doc_id"] for r in mixed.collect())
    for r in mixing.mix_report(docs).collect():
        if r["size"]:
            assert n[r["doc_id"]] == r["taken"] // r["size"]


def test_odd_tables(spark):
    assert mixing.mix_report(documents(spark, [])).count() == 0
    rows = mixing.mix_report(documents(spark, [None, "", "a b"], [1, 1, None], ["x", None, "y"])).collect()
    assert sum(r["taken"] for r in rows) <= 4 and len(rows) == 3
    assert {r["target"] for r in mixing.mix_report(documents(spark, ["", None])).collect()} == {0.0}
