import hashlib
import math

import numpy as np
import pytest

from gleanrow.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, v string, code string, error string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def plain(rows, parts=4, entries=256, rounds=4):
    """Lloyd's rounds as the contract words them, in plain Python."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    by_id = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(by_id[0][1])
    kept, by_id = ([r for r in some if len(r[1]) == size] for some in (kept, by_id))
    width = -(-size // parts)
    cut = lambda v: [tuple((v + [0] * (width * parts - size))[p * width : (p + 1) * width]) for p in range(parts)]
    books = [list(b) for b in zip(*(cut(v) for _, v, _ in by_id[:entries]), strict=True)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [[min((far(x, e), j) for j, e in enumerate(book)) for x, book in zip(cut(v), books, strict=True)] for _, v, _ in kept]

    for _ in range(rounds):
        found = assign()
        for p, book in enumerate(books):
            for j in range(len(book)):
                own = [cut(v)[p] for (_, v, _), f in zip(kept, found, strict=True) if f[p][1] == j]
                if own:
                    book[j] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    found = assign()
    sums = {}
    for (_, _, label), f in zip(kept, found, strict=True):
        sums[label] = sums.get(label, 0) + sum(d for d, _ in f)
    return [(i, "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f), sums[label], digest) for (i, _, label), f in zip(kept, found, strict=True)]


def test_against_plain_rounds(spark):
    rng = np.random.default_rng(4)
    vectors = np.float32(rng.normal(size=(700, 8)) * 0.02)  # few integers: many ties
    rows = [(int(i), [float(x) for x in v], int(i) % 3 if i % 5 else None) for i, v in zip(rng.permutation(700), vectors, strict=True)]
    rows += rows[:40] + [(None, rows[0][1], 1), (3, rows[1][1], 2), (1000, None, 1), (1001, [None] * 8, 1), (1002, [float("nan")] * 8, None),
        (-5, [float("-inf")] + [0.0] * 7, 1), (1003, [], 1), (1004, [0.5] * 7, 1), (2, [0.5] * 7, 1), (1005, [1.5] * 8, 9)]
    got = codes.compress(frame(spark, rows).repartition(5)).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, plain(rows)))


def test_small_and_odd_tables(spark):
    assert codes.compress(frame(spark, [])).collect() == []
    assert codes.compress(frame(spark, [(1, None, 1)])).collect() == []
    for rows in ([(1, [0.1] * 8, None)], [(i, [i / 100] * 6, 1) for i in range(9)], [(7, [0.25, -0.25, 1.0, 0.0], 1)] * 300):
        got = codes.compress(frame(spark, rows)).collect()
        assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, plain(rows)))
    with pytest.raises(Exception, match="a component times"):
        codes.compress(frame(spark, [(1, [1e30] * 4, 1)])).collect()


def test_bounds_skip_groups_and_keep_every_code():
    """Codes by bounds are those of all distances, large numbers included, and most groups are passed over."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-900, 900, (40, 16))
    for scale in (1, 30_000):
        x = (centres[rng.integers(0, 40, 6000)] + rng.integers(-25, 25, (6000, 16))) * scale
        book = codes.Codebook(x[:256], codes.grouped(x[:256]))
        code, _, low = book.assign(x)
        for _ in range(4):
            counts, sums = np.bincount(code, minlength=256), np.zeros_like(book.entries)
            np.add.at(sums, code, x)
            book = book.moved(counts, sums)
            code, best, low, taken = book.again(x, code, low)
            want = np.array([[((r - e) ** 2).sum() for e in book.entries] for r in x[:300]])
            assert (code[:300] == want.argmin(1)).all() and (best[:300] == want.min(1)).all()
            all_d = codes.squared(x, book.entries)
            assert (code == all_d.argmin(1)).all()
            assert taken < 0.4 * all_d.size
