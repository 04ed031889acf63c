import random
from collections import Counter

import numpy as np
import xxhash

from gleanrow.llm import simhash

from .helpers import ODD, documents, prose


def plain_fingerprint(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, budget=3):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near_prints(rng, n):
    out = [rng.getrandbits(64) for _ in range(4)]
    while len(out) < n:
        x = rng.choice(out)
        for _ in range(rng.choice([0, 1, 2, 3, 3, 4, 5])):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


def test_fingerprints_against_the_definition(spark):
    texts = [*ODD[:-2], "THE quick\tbrown\u00a0fox É", "a b c d " * 50]
    got = {r["doc_id"]: r["fp"] & (2**64 - 1) for r in simhash.fingerprints(documents(spark, texts)).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_trie_against_all_pairs():
    rng = random.Random(1)
    for n in (2, 30, 300):
        prints = np.unique(np.array(near_prints(rng, n), np.uint64))
        got = simhash.trie_forest(prints.reshape(-1, 1), np.array([0, len(prints)]))
        assert got.tolist() == plain_components([int(x) for x in prints])


def test_wide_trie_against_all_pairs(monkeypatch):
    """256 bits, a wide budget, unrelated prints beside crowds of near ones, and frontiers in slices."""
    rng = random.Random(4)
    prints = [rng.getrandbits(256) for _ in range(60)]
    for center in prints[:3]:
        prints += [center ^ sum(1 << b for b in rng.sample(range(256), rng.randrange(10, 40))) for _ in range(60)]
    prints = sorted(set(prints))
    bits = np.array([[x >> 64 * w & 2**64 - 1 for w in (3, 2, 1, 0)] for x in prints], np.uint64)
    want = plain_components(prints, 46)
    assert 3 < len(set(want)) < 100
    for frontier, compared in ((1 << 18, 1 << 21), (7, 50)):
        monkeypatch.setattr(simhash, "FRONTIER", frontier)
        monkeypatch.setattr(simhash, "COMPARED", compared)
        assert simhash.trie_forest(bits, np.array([0, len(bits)]), (5, 15, 30, 46)).tolist() == want


def test_components_with_split_buckets(spark):
    """bucket_rows so small that buckets are split again and again."""
    prints = near_prints(random.Random(2), 400)
    rows = spark.createDataFrame([(i, x - 2**64 if x >= 2**63 else x) for i, x in enumerate(prints)], "doc_id long, fp long")
    want = plain_components(prints)
    for most in (1 << 17, simhash.BUCKET_ROWS, 8):
        found = rows.join(simhash.components(rows, bucket_rows=most), "fp")
        got = {r["doc_id"]: r["component_id"] for r in found.collect()}
        assert [got[i] for i in range(len(prints))] == want


def test_odd_rows(spark):
    rng = random.Random(3)
    long = prose(rng, 500)
    texts = [*ODD, long, long, long.replace("w1 ", "W1 "), long]
    ids = [*range(len(ODD)), 50, 50, 40, None]
    rows = simhash.near_duplicates(documents(spark, texts, ids)).collect()
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert by[0] == by[1] == by[2] == {0}
    assert by[50] == by[40] == by[None] == {40}
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def plain_set(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similarity(a, b):
    a, b = plain_set(a), plain_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def near_texts(rng):
    """Texts, edited copies of similarity 0.9 and more, a crowd of copies, and texts that quote one passage."""
    base = [prose(rng, rng.randrange(150, 400), 3000) for _ in range(25)]
    near = [edited(rng, t, 1) for t in base for _ in range(2)]
    crowd = prose(rng, 300, 3000)
    passage = prose(rng, 60, 3000)
    quoting = [prose(rng, rng.randrange(60, 120), 3000) + " " + passage for _ in range(60)]
    return base, near, [edited(rng, crowd, rng.randrange(0, 3)) for _ in range(80)], quoting


def test_edited_copies_go_and_others_stay(spark):
    base, near, crowd, quoting = near_texts(random.Random(5))
    texts = base + quoting + near + crowd
    out = simhash.keep_one(documents(spark, texts).repartition(3))
    assert out.columns == documents(spark, []).columns
    clean = len(base) + len(quoting)
    assert sorted(r["doc_id"] for r in out.collect()) == [*range(clean), clean + len(near)]
    for most in (8, 1):  # buckets that are dealt again
        found = simhash.keep_one(documents(spark, texts), wide_rows=most)
        assert sorted(r["doc_id"] for r in found.collect()) == [*range(clean), clean + len(near)]


def test_links_follow_the_similarity():
    """Over pairs of texts of all similarities: none under 0.5 is linked, nearly all from 0.85 on are."""
    rng = random.Random(6)
    far = close = missed = 0
    for _ in range(800):
        text = prose(rng, rng.randrange(60, 600), 3000)
        other = edited(rng, text, rng.randrange(1, max(2, len(text.split()) // 5)))
        near = similarity(text, other)
        (a, k), (b, m) = simhash.wide_fingerprint(text), simhash.wide_fingerprint(other)
        linked = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() <= simhash.WIDE_BUDGET and bool(set(k.tolist()) & set(m.tolist()))
        if near < 0.5:
            far += 1
            assert not linked
        elif near >= 0.85:
            close += 1
            missed += not linked
    assert far > 50 and close > 50 and missed <= 0.05 * close


def test_keep_one_with_null_and_shared_ids_and_odd_texts(spark):
    """Unrelated texts under null ids or one id stay, copies go, repeated rows are one; an empty table."""
    rng = random.Random(7)
    base = [prose(rng, 200, 3000) for _ in range(6)]
    texts = [*base, base[0], edited(rng, base[3], 1), base[4], base[4], base[5]]
    ids = [None, None, None, 5, 5, 6, None, None, 5, 9, 6]
    out = [(r["doc_id"], r["text"]) for r in simhash.keep_one(documents(spark, texts, ids)).collect()]
    assert sorted(out, key=str) == sorted(zip(ids[:6], base, strict=True), key=str)
    left = simhash.keep_one(documents(spark, ODD))
    assert sorted(r["doc_id"] for r in left.collect()) == [0, *range(3, len(ODD))]
    assert simhash.keep_one(documents(spark, [])).count() == 0


def test_large_buckets_are_dealt_and_crowds_are_not(spark):
    """Rows with one key in common are dealt by their other keys; near pairs meet again, and no bucket stays large."""
    rng = random.Random(8)
    texts = []
    for i in range(120):  # every text holds the passage, by which all have some least shingles in common
        own = prose(rng, 80, 9000) + " " + "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 2
        texts += [own, edited(rng, own, 1)] if i < 20 else [own]
    prints = [simhash.wide_fingerprint(t) for t in texts]

    def buckets(some, most):
        df = spark.createDataFrame([(bytearray(fp), keys.tolist()) for fp, keys in some], "fp binary, keys array<long>").distinct()
        rows = [(bytes(r["fp"]), r["key"]) for r in simhash.shingle_buckets(df, most).collect()]
        sizes = Counter(key for _, key in rows)
        at = {}
        for fp, key in rows:
            at.setdefault(fp, set()).add(key)
        return max(sizes.values()), at

    assert buckets(prints, 1 << 15)[0] > 100
    largest, at = buckets(prints, 70)
    assert largest <= 70
    for i in range(0, 40, 2):
        a, b = prints[i][0], prints[i + 1][0]
        assert a == b or at[a] & at[b]
    crowd = [simhash.wide_fingerprint(edited(rng, texts[0], 1)) for _ in range(90)]
    largest, at = buckets(crowd, 30)
    assert largest > 60 and max(map(len, at.values())) <= simhash.KEYS
