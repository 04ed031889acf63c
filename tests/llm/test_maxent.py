import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gleanrow.llm import maxent

from .helpers import ODD, documents


def languages(n):
    """Texts of two invented languages: the last word tells which words may follow."""
    rng = random.Random(8)
    out = []
    for _ in range(n):
        lang = rng.choice("xy")
        out.append(" ".join(f"{min(int(rng.expovariate(0.08)), 400)}{lang}" for _ in range(rng.randrange(20, 120))))
    return out


def low_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


@pytest.fixture(scope="module")
def scored(spark):
    texts = languages(300) + ODD
    return texts, maxent.score_documents(documents(spark, texts), rounds=2).orderBy("doc_id").collect()


def test_base_scores_are_exact(scored):
    texts, rows = scored
    counts = Counter()
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*low_words(t), None])
    n, v = sum(counts.values()), len(counts)
    for i, (t, r) in enumerate(zip(texts, rows, strict=True)):
        k = [*low_words(t), None]
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["train_tokens"]) == (i, zlib.crc32(str(i).encode()) % 7 == 2, len(k), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in k)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in k), rel=1e-9)


def test_model_beats_the_base_on_held_out_texts(scored):
    rows = [r for r in scored[1] if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def plain_token(m, counts, word, last, skip):
    """log probability of a token by sums over all classes and over all units of its class. word None: the end."""
    w = m.weights
    rank = {x: i for i, x in enumerate(m.words)}
    bucket = lambda x, own, kind: kind if x == "start" else maxent.places(x,
        min(rank.get(x, maxent.FREQUENT), maxent.FREQUENT))[own]
    a, b = bucket(last, 1, maxent.LAST_START), bucket(skip, 2, maxent.SKIP_START)
    pair = maxent.pair_hash(np.array([b]), np.array([a]))[0]
    logits = [float(w.bias[c]) + float(w.last[a, c]) + float(w.skip[b, c]) + float(w.pair[pair, c]) for c in range(maxent.CLASSES)]
    log_sum = lambda xs: max(xs) + math.log(sum(math.exp(x - max(xs)) for x in xs))
    if word is None:
        return logits[maxent.END_CLASS] - log_sum(logits)
    unit = maxent.places(word, min(rank.get(word, maxent.FREQUENT), maxent.FREQUENT))[0]
    cls = int(maxent.CLASS_OF[unit])
    stop = [*maxent.CLASS_STARTS[1:], maxent.UNITS][cls]
    units = [u for u in range(maxent.CLASS_STARTS[cls], stop) if u >= maxent.FREQUENT or u < w.frequent]
    of = {u: float(w.unit[u]) + float(w.word[maxent.word_hash(np.array([a]), np.array([u]))[0]]) for u in units}
    p = logits[cls] - log_sum(logits) + of[unit] - log_sum(list(of.values()))
    if unit >= maxent.FREQUENT:
        mine = [c for x, c in counts.items() if x and maxent.places(x, min(rank.get(x, maxent.FREQUENT), maxent.FREQUENT))[0] == unit]
        p += math.log(counts.get(word, 0) + 1) - math.log(sum(mine) + len(mine) + 1)
    return p


def trained(docs, rounds):
    counts = maxent.word_counts(docs).cache()
    return maxent.train(docs, counts, rounds), counts


def test_scores_against_plain_sums(spark, monkeypatch):
    """Every token by brute force; few words travel, so that frequent, known, far and unknown words all occur."""
    monkeypatch.setattr(maxent.top_words, "__defaults__", (90,))
    texts = [*languages(60), None, "", "one", "never seen words 3x 5x", "=" * 200 + " 2y " + "=" * 200, "=" * 200]
    docs = documents(spark, texts)
    m, table = trained(docs, 2)
    counts = {bytes(r["word"]): r["c"] for r in table.collect()}
    rows = maxent.score(docs, m, table).orderBy("doc_id").collect()
    assert len(m.words) <= 90 < len(counts)
    for t, r in zip(texts[-12:], rows[-12:], strict=True):
        want, last, skip = 0.0, "start", "start"
        for word in [*maxent.tokens(t), None]:
            want += plain_token(m, counts, word, last, skip)
            last, skip = word, last
        assert r["score"] == pytest.approx(want / math.log(10), rel=1e-4)


def test_probabilities_sum_to_one(spark):
    """All known tokens and every unit's unknown word after one history."""
    m, table = trained(documents(spark, languages(120)), 1)
    counts = {bytes(r["word"]): r["c"] for r in table.collect()}
    word, before = m.words[3], m.words[50]
    total = math.exp(plain_token(m, counts, None, word, before))
    w = m.weights
    a, b = maxent.places(word, 3)[1], maxent.places(before, 50)[2]
    p_class = np.exp(w.class_log_p(np.array([b]), np.array([a]))[0][0].astype(float))
    p_unit = np.exp(w.unit_log_p(np.array([a]))[0][0].astype(float))
    for u in [*range(w.frequent), *range(maxent.FREQUENT, maxent.UNITS)]:
        share = 1.0
        if u >= maxent.FREQUENT:
            mine = [c for x, c in counts.items() if x and x not in m.words[: maxent.FREQUENT] and maxent.places(x, maxent.FREQUENT)[0] == u]
            share = (sum(mine) + len(mine) + 1) / (m.unit_total[u] + m.unit_types[u] + 1)
        total += p_class[int(maxent.CLASS_OF[u])] * p_unit[u] * share
    empty = sum(p_class[c] for c in range(maxent.FREQUENT_CLASSES) if c * maxent.CLASS_WORDS >= w.frequent)
    assert total + empty == pytest.approx(1, abs=1e-4)


def test_the_likelihood_rises_each_round(spark):
    m, _ = trained(documents(spark, languages(200)), 4)
    assert len(m.history) == 5 and m.history == sorted(m.history)
    assert m.history[-1] > m.history[0] + 1e-3


def test_words_that_do_not_travel_give_the_same_base_scores(spark, monkeypatch):
    docs = documents(spark, languages(60))
    one = maxent.score_documents(docs, rounds=1).orderBy("doc_id").collect()
    counts = maxent.word_counts(docs)
    words, n = maxent.top_words(counts, most=40)
    assert 0 < len(words) <= 40 and list(n) == sorted(n, reverse=True)
    assert min(n) > max(r["c"] for r in counts.collect() if r["word"] and bytes(r["word"]) not in words)
    monkeypatch.setattr(maxent.top_words, "__defaults__", (40,))
    two = maxent.score_documents(docs, rounds=1).orderBy("doc_id").collect()
    for a, b in zip(one, two, strict=True):
        assert a["base_score"] == pytest.approx(b["base_score"], rel=1e-9) and a["n_known"] == b["n_known"]


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = maxent.score_documents(documents(spark, ["a b", "a b", None], [4, 4, None]), rounds=1).collect()
    assert len(rows) == 3 and {r["n_tokens"] for r in rows if r["doc_id"] == 4} == {3}
    assert maxent.score_documents(documents(spark, []), rounds=1).count() == 0
