"""Crowded cells, large components and stacked rows: the same results as comparing all pairs and going through them in order."""

import random
import time
from collections import Counter
from dataclasses import replace

from pyspark.sql import functions as F

from gleanrow.functions.options import Options
from gleanrow.functions.similarity import indel_ratio, name_features, names_may_match
from gleanrow.operators import blocking, clustering, identity

from .test_linkage import ROW, frame, plain_groups, row

NAMES = ["sunny flat", "sunny flat 2", "sunny flot", "loft", "loft 7", "a", "", None, "old town studio", "old town studios"]


def stacked(rng, n, phones=20):
    """Rows at few spots, with few names: many are equal, some with keys of an operator or a twin."""
    out = []
    for i in range(n):
        lat, lng = 44.43 + rng.randrange(3) * 0.0006, 26.1 + rng.randrange(3) * 0.0005
        phone = rng.choice([None, None, None, f"07212345{rng.randrange(phones):02}"])
        out.append(row(f"{'ab'[i % 2]}{rng.randrange(10**6):06}_{i}", ("booking", "airbnb")[i % 2], rng.choice(NAMES), lat, lng, phone=phone,
            rooms=(rng.choice([None] * 4 + [1]), None, None), guests=rng.choice([None] * 4 + [2])))
    return out


def groups_of(found):
    got = {}
    for r in found.collect():
        got.setdefault((r["group_id"], r["by_identity"]), []).append(r["id"])
    return sorted((sorted(v), k[1]) for k, v in got.items())


def plain(rows):
    names = [c.split()[0] for c in ROW.split(", ")]
    return {r[0]: dict(zip(names, r, strict=True)) | {"amenities": set()} for r in rows}


def test_filters_lose_no_similar_names(spark):
    rng = random.Random(5)
    names = [*NAMES, "aaaaaaa", "x" * 250, "Étage"]
    for _ in range(120):
        letters = list(rng.choice(names) or "")
        for _ in range(rng.randrange(1, 5)):
            letters.insert(rng.randrange(len(letters) + 1), rng.choice("ab 1"))
        names.append("".join(letters))
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string").select("id", "name", name_features(F.col("name")).alias("f"))
    a, b = (df.select(*(F.col(c).alias(p + c) for c in df.columns)) for p in "ab")
    for least in (70.0, 80.0, 95.0):
        found = a.join(b, F.expr("aid < bid")).select("aname", "bname", names_may_match(F.col("af"), F.col("bf"), least).alias("may")).collect()
        assert all(r["may"] for r in found if indel_ratio(r["aname"], r["bname"]) >= least)
        assert sum(r["may"] for r in found) < 0.7 * len(found)


def test_crowded_cells_give_the_same_pairs(spark):
    rows = frame(spark, stacked(random.Random(6), 300))
    plain_way, crowded = Options(), replace(Options(), crowd=0)
    for pairs in (lambda o: blocking.strict_candidates(rows, o).select("a_id", "b_id", "similarity"),
        lambda o: blocking.cross_platform_matches(rows, o).select("a_id", "b_id", "similarity")):
        one, other = (sorted(map(tuple, pairs(o).collect())) for o in (plain_way, crowded))
        assert one == other and len(one) > 500


def test_link_counts(spark):
    df = frame(spark, stacked(random.Random(7), 250))
    ends = Counter(x for r in blocking.strict_candidates(df).select("a_id", "b_id").collect() for x in r)
    found = blocking.link_counts(df).collect()
    assert {r["id"]: r["links"] for r in found} == {r["id"]: ends[r["id"]] for r in df.collect()}
    assert len({r["class_id"] for r in found}) < 200
    assert blocking.link_counts(df.limit(0)).collect() == []


def test_groups_by_rounds_equal_the_one_pass(spark):
    for seed, phones, o in ((8, 20, replace(Options(), equal_rows=2)), (9, 4, replace(Options(), crowd=0, component_pairs=400, equal_rows=3))):
        rows = stacked(random.Random(seed), 150, phones)
        df = frame(spark, rows).persist()
        ops = identity.operator_ids(df).persist()
        want = plain_groups(plain(rows), [tuple(r) for r in clustering.candidates(df, ops).collect()], Options())
        found = clustering.property_groups(df, ops, o)
        assert groups_of(found) == want
        assert {r["cross_platform"] for r in found.select("cross_platform").distinct().collect()} == {True, False}


def test_components_part_by_the_order_of_their_pairs(spark, monkeypatch):
    """One component of all pairs, whose earlier pairs hang together in small ones: no rounds are needed."""
    def rounds(*_):
        raise AssertionError("rounds")

    rng = random.Random(13)
    rows = [row(f"x{rng.randrange(10**9):09}_{i}", ("booking", "airbnb")[i % 2], ("sunny flat", "sunny flot", "sunny float")[i % 3],
        44.0 + i // 6 * 0.0006, 26.1, phone=f"0721234{i // 6:03}") for i in range(240)]
    df = frame(spark, rows).persist()
    ops = identity.operator_ids(df).persist()
    pairs = [tuple(r) for r in clustering.candidates(df, ops).collect()]
    want = sorted((ids, by) for ids, by in clustering.cluster(plain(rows), pairs))
    monkeypatch.setattr(clustering, "_by_rounds", rounds)
    assert groups_of(clustering.property_groups(df, ops, replace(Options(), component_pairs=len(pairs) // 3, equal_rows=10**9))) == want


def test_one_to_one_by_rounds(spark):
    df = frame(spark, stacked(random.Random(10), 200))
    one, other = (sorted(map(tuple, clustering.one_to_one(df, o).collect())) for o in (Options(), replace(Options(), component_pairs=10)))
    assert one == other and len(one) > 50


def test_batch_dedup_by_rounds(spark):
    rows = [(f"i{i % 150}", *r[1:], i) for i, r in enumerate(stacked(random.Random(11), 260))]
    df = spark.createDataFrame(rows, ROW + ", seq long")
    one, other = (sorted(r["seq"] for r in clustering.batch_dedup(df, o=o).collect()) for o in (Options(), replace(Options(), component_pairs=10)))
    assert one == other and 10 < len(one) < 200


def test_a_hundred_thousand_rows_at_one_point(spark):
    """60 kinds of equal rows stand for all: links are counted and groups formed without their five billion pairs."""
    kind = F.col("id") % 60
    names = F.array(*(F.lit(f"{word} {k}") for k, word in enumerate(["sunny flat", "loft", "old town studio"] * 20)))
    df = spark.range(100_000).select(F.format_string("x%06d", "id").alias("id"), F.lit("airbnb").alias("platform"), F.get(names, kind.cast("int")).alias("name"),
        F.lit(44.43).alias("latitude"), F.lit(26.1).alias("longitude"), *(F.lit(None).cast(t).alias(c) for c, t in (("registration", "string"),
        ("phone", "string"), ("email", "string"), ("bedrooms", "int"), ("beds", "int"), ("bathrooms", "double"), ("max_guests", "int"),
        ("amenities", "array<string>"))))
    per = {k: 100_000 // 60 + (k < 100_000 % 60) for k in range(60)}
    name = {k: f"{['sunny flat', 'loft', 'old town studio'][k % 3]} {k}" for k in range(60)}
    links = {k: sum(per[j] for j in range(60) if indel_ratio(name[k], name[j]) >= 80) - 1 for k in range(60)}
    began = time.time()
    found = blocking.link_counts(df).groupBy("class_id").agg(F.count("*").alias("n"), F.min("links").alias("low"), F.max("links").alias("high")).collect()
    assert {int(r["class_id"][1:]): (r["n"], r["low"], r["high"]) for r in found} == {k: (per[k], links[k], links[k]) for k in range(60)}
    grouped = clustering.property_groups(df, identity.operator_ids(df))
    assert grouped.count() == 100_000 and grouped.select("group_id").distinct().count() < 60
    assert time.time() - began < 120


def test_one_component_of_fifty_thousand_rows(spark):
    """A street of equal names, each row near those beside it: settled in blocks, none of which holds more than a part of it."""
    n, rng = 50_000, random.Random(12)
    rows = [row(f"x{rng.randrange(10**9):09}_{i}", "airbnb", f"street flat {i % 3}", 44.0 + i * 0.0004, 26.1 + (i % 2) * 0.0001) for i in range(n)]
    df = frame(spark, rows).repartition(8).persist()
    pairs = [tuple(r) for r in clustering.candidates(df, identity.operator_ids(df)).collect()]
    members = plain(rows)
    want = sorted((ids, by) for ids, by in clustering.cluster(members, pairs))
    got = groups_of(clustering.property_groups(df, identity.operator_ids(df), replace(Options(), component_pairs=10_000)))
    assert got == want and len(pairs) > 1.5 * n
