import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
from gleanrow.llm import decontam, hashtree, mixing, simhash

from .helpers import prose
from .test_decontam import plain as plain_contaminated
from .test_hashtree import plain_shard
from .test_iforest import junk, plain_verdicts
from .test_mixing import plain_targets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, `a.b` string"


def plain_near_dedup(rows):
    """One row of each group of texts that share 0.8 of their five-word shingles, directly or in a chain: all pairs are compared."""

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if x == a else x for x in group]
    best = {}
    for i, r in enumerate(rows):
        k = (r[0] is None, r[0] or 0)
        if group[i] not in best or k < best[group[i]][0]:
            best[group[i]] = (k, r)
    return [r for _, r in best.values()]


def plain_mix(rows):
    """Each row as often as the mix takes it."""
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r)
    target = plain_targets(sizes)
    rate = {s: min(mixing.MAX_RATE, target[s] / n) if n else 0.0 for s, n in sizes.items()}

    def draw(i, k):
        h = hashlib.md5(f"{'null' if i is None else i}|{k // mixing.DRAWS}".encode()).hexdigest()
        return int(h[8 * (k % mixing.DRAWS) : 8 * (k % mixing.DRAWS) + 8], 16) / 2**32

    out = []
    for s in sizes:
        own = [r for r in rows if r[3] == s]
        part = rate[s] - math.floor(rate[s])
        won = lambda k: sum(size(r) for r in own if draw(r[0], k) < part)  # noqa: B023, E731
        k = min(range(mixing.SEEDS), key=lambda k: (abs(won(k) - (target[s] - math.floor(rate[s]) * sizes[s])), k))  # noqa: B023
        for r in own:
            out += [r] * (math.floor(rate[s]) + (draw(r[0], k) < part))
    return out


def test_run_against_brute_force(spark, tmp_path):
    """The rows of run() are those of a plain version of every stage: null and repeated ids, repeats and odd columns included."""
    rng = random.Random(12)
    base = [prose(rng, 300, 5000) for _ in range(60)]
    edited = base[5].split(" ")
    edited[100] = "changed"
    near = [base[3], base[4].replace("\n", " "), " ".join(edited), base[6] + " and a few words more"]
    half = " ".join(base[7].split(" ")[:150]) + " " + prose(rng, 150, 5000)  # like base[7], but not alike enough
    item = prose(rng, 30, 9000)
    dirty = [prose(rng, 60, 5000) + " " + item, item + " " + prose(rng, 100, 5000)]
    bad = [junk(rng, k, 120) for k in ("symbols", "pipes", "shouts") for _ in range(4)]
    texts = base + near + [half] + dirty + bad + [None, "", "short"]
    row = lambda i, t, s: (i, t, "en", s, None if t is None else len(t), "x", "y")
    rows = [row(i, t, f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [row(None, prose(rng, 200, 5000), None), row(None, prose(rng, 200, 5000), "s1"), row(10, prose(rng, 200, 5000), "s2"), rows[12], rows[12],
        row(None, base[9], "s0")]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    first_bad = len(texts) - 3 - len(bad)
    labels = [(i, int(i < first_bad)) for i in range(first_bad + len(bad)) if i % 2 or i == 10]
    spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    kept = [r for r, (_, fine) in zip(rows, plain_verdicts([r[:2] for r in rows], labels), strict=True) if fine]
    alone = plain_near_dedup(kept)
    clean = [r for r, x in zip(alone, plain_contaminated([r[1] for r in alone], [(1, item)]), strict=True) if not x[3]]
    tree = hashtree.default_tree(corpus_pipeline.SHARDS)
    want = Counter((*r, plain_shard("null" if r[0] is None else r[0], tree)) for r in plain_mix(clean))
    assert len(rows) - len(kept) == 15 and len(kept) - len(alone) == 7 and len(alone) - len(clean) == 2

    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "shard", "a.b"] and len(out.columns) == 8
    assert Counter(map(tuple, out.collect())) == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "mix_sources", "shard"]
    assert decontam.WINDOW == 13 and simhash.BUDGET == 3 and tree.weight == 16
