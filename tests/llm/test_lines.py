import random
from collections import defaultdict

import numpy as np
import pytest

from gleanrow.llm import lines

from .helpers import ODD, documents


def plain(rows, min_chars=40, min_docs=5):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    docs, most = defaultdict(int), {}
    rank = lambda d: lines.NO_DOC if d is None else d
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            docs[k] += 1
            most[k] = max(most.get(k, lines.NO_DOC), rank(d))
    out = []
    for d, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if not (len(key(x)) >= min_chars and docs[key(x)] >= min_docs and most[key(x)] != rank(d))]
        out.append((d, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    common = [f"this line number {i} is found in many of the documents É" for i in range(6)] + ["ü" * 40, "ü" * 39, "short"]
    texts = ["\n".join(rng.choice(["  ", "", "\t"]) + rng.choice([str.upper, str, str])(rng.choice(common)) + rng.choice([" ", "\r",
        ""]) if rng.random() < 0.6 else f"own {rng.random()} " * 3 for _ in range(rng.randrange(9))) for _ in range(60)]
    texts = [t.replace("Ü", "ü") for t in texts] + ODD
    ids = [*range(len(texts) - 3), None, 7, 7]
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("most", [lines.MAX_BROADCAST, 0])
def test_both_ways_against_plain(spark, most):
    rows = corpus()
    docs = documents(spark, [t for _, t in rows], [d for d, _ in rows])
    got = sorted((tuple(r) for r in lines.drop_repeated(docs, max_broadcast=most).collect()), key=str)
    want = plain(rows)
    assert any(r[3] for r in want)
    assert got == want


def test_small_shards(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 2)
    rows = corpus()
    docs = documents(spark, [t for _, t in rows], [d for d, _ in rows])
    for most in (lines.MAX_BROADCAST, 0):
        assert sorted((tuple(r) for r in lines.drop_repeated(docs, max_broadcast=most).collect()), key=str) == plain(rows)


def test_index_is_minimal_and_knows_strangers():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 5000):
        h, g = rng.integers(-(2**63), 2**63, (2, n))
        index = lines.LineIndex.load(lines.LineIndex.build(h, g, np.full(n, 9), np.arange(n)).dump())
        at = index.find(h, g)
        assert sorted(at.tolist()) == list(range(n))
        assert (index.most[at] == np.arange(n)).all()
        assert (index.find(*rng.integers(-(2**63), 2**63, (2, 100))) == -1).all()


def test_empty_table(spark):
    assert lines.drop_repeated(documents(spark, [])).count() == 0
