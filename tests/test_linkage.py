import math
import random

from pyspark.sql import functions as F

from gleanrow.functions import similarity
from gleanrow.functions.options import Options
from gleanrow.functions.similarity import compatible, indel_ratio
from gleanrow.operators import blocking, clustering, identity, quality
from gleanrow.operators.components import component_changes, connected_components, with_changes

ROW = "id string, platform string, name string, latitude double, longitude double, registration string, phone string, email string, bedrooms int, beds int, bathrooms double, max_guests int, amenities array<string>"


def row(i, platform, name="flat", lat=44.43, lng=26.1, phone=None, reg=None, mail=None, rooms=(None, None, None), guests=None,
    amenities=()):
    return (i, platform, name, lat, lng, reg, phone, mail, *rooms, guests, list(amenities))


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def groups(spark, rows, o=Options()):
    df = frame(spark, rows)
    return {r["id"]: r for r in clustering.property_groups(df, identity.operator_ids(df), o).collect()}


def test_components_against_union_find(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 470)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_operators_chain_and_ids_are_stable(spark):
    rows = [row("a", "booking", phone="0721234567"), row("b", "airbnb", phone="+40721234567", reg="RO 1"), row("c", "airbnb", reg="1"),
        row("d", "airbnb"), row("e", "booking", mail="X@y.z")]
    got = {r["id"]: r["operator_id"] for r in identity.operator_ids(frame(spark, rows)).collect()}
    assert got["a"] == got["b"] == got["c"] != got["e"] and "d" not in got
    assert got == {r["id"]: r["operator_id"] for r in identity.operator_ids(frame(spark, rows[::-1])).collect()}


def test_singleton_identity_ignores_distance_and_name(spark):
    got = groups(spark, [row("a1", "booking", "north", 44.43, 26.1, phone="0721234567"),
        row("b1", "airbnb", "south", 44.4336, 26.1, phone="0721234567")])
    assert got["a1"]["group_id"] == got["b1"]["group_id"] and got["a1"]["cross_platform"] and got["a1"]["by_identity"]


def test_one_operator_does_not_merge_distant_flats(spark):
    rows = [row("a1", "booking", "sun", 44.43, 26.1, reg="1"), row("b1", "airbnb", "sun", 44.4301, 26.1, reg="1"),
        row("b2", "airbnb", "sun", 44.5, 26.2, reg="1")]
    got = groups(spark, rows)
    assert set(got) == {"a1", "b1"}


def test_vetoes(spark):
    a = {"platform": "airbnb", "name": "x", "latitude": 44.43, "longitude": 26.1, "bedrooms": None, "beds": None, "bathrooms": None,
        "max_guests": 12, "amenities": set("abc")}
    for relaxed in (True, False):
        assert not compatible(a, a | {"max_guests": 14}, relaxed, Options())
        assert compatible(a, a | {"platform": "booking", "max_guests": 14}, relaxed, Options())
        assert compatible(a, a | {"amenities": set("abcde")}, relaxed, Options())  # exactly 0.6
        assert not compatible(a, a | {"amenities": set("abcdef")}, relaxed, Options())
    far = a | {"latitude": 44.4315, "name": "yyy"}
    assert not compatible(a, far, True, Options())
    assert compatible(a | {"beds": 2}, far | {"beds": 2}, True, Options())
    assert set(groups(spark, [row("a", "airbnb", guests=2), row("b", "airbnb", guests=3), row("c", "airbnb", guests=2)])) == {"a", "c"}


def plain_groups(rows, pairs, o):
    """One global greedy pass over sets."""
    of, sets, ident = {}, {}, set()
    for tier, _, a, b in sorted((t, -s, a, b) for t, s, a, b in pairs):
        ga, gb = of.get(a), of.get(b)
        if ga is not None and ga == gb:
            continue
        left, right = (sets[ga] if ga is not None else {a}), (sets[gb] if gb is not None else {b})
        if (ga is not None or gb is not None) and not all(compatible(rows[x], rows[y], tier < 2, o) for x in left for y in right):
            continue
        new = len(sets) + len(of) * 1000 + 1
        while new in sets:
            new += 1
        if tier < 2 or ga in ident or gb in ident:
            ident.add(new)
        sets[new] = left | right
        for x in sets[new]:
            of[x] = new
    live = set(of.values())
    return sorted((sorted(sets[g]), g in ident) for g in live)


def test_clustering_per_component_equals_one_global_pass(spark):
    rng = random.Random(3)
    rows = []
    for i in range(120):
        lat, lng = 44.43 + rng.randrange(4) * 0.004 + rng.random() * 0.0009, 26.1 + rng.random() * 0.0009
        rows.append(row(f"{'ab'[i % 2]}{i:03}", ("booking", "airbnb")[i % 2],
            rng.choice(["sunny flat", "sunny flat 2", "sunny flot", "loft", "loft 7"]), lat, lng,
            phone=rng.choice([None, None, f"07212345{rng.randrange(20):02}"]), rooms=(rng.choice([None, 1, 2]), None, None),
            guests=rng.choice([None, 2, 4])))
    df = frame(spark, rows)
    ops = identity.operator_ids(df)
    pairs = [tuple(r) for r in clustering.candidates(df, ops).collect()]
    names = [c.split()[0] for c in ROW.split(", ")]
    plain = {r[0]: dict(zip(names, r, strict=True)) | {"amenities": set()} for r in rows}
    got = {}
    for r in clustering.property_groups(df, ops).collect():
        got.setdefault((r["group_id"], r["by_identity"]), []).append(r["id"])
    assert sorted((sorted(v), k[1]) for k, v in got.items()) == plain_groups(plain, pairs, Options())
    assert len(got) > 10


def test_one_to_one(spark):
    rows = [row("a1", "booking", "sunny flat"), row("b1", "airbnb", "sunny flat"), row("b2", "airbnb", "sunny flats"),
        row("a2", "booking", "sunny flatz", 44.5)]
    got = {r["id"]: r["group_id"] for r in clustering.one_to_one(frame(spark, rows)).collect()}
    assert set(got) == {"a1", "b1"} and got["a1"] == got["b1"]


def test_batch_dedup_against_plain(spark):
    rng = random.Random(4)
    rows = [(*row(f"a{rng.randrange(60)}", rng.choice(["booking", "airbnb"]), rng.choice(["aaaa", "aaab", "zzzz"]),
        44.43 + rng.randrange(5) * 0.0003, 26.1), i) for i in range(120)]
    seen, kept = {"a1", "a2"}, []
    for r in rows:
        near = lambda k: k[1] == r[1] and abs(k[3] - r[3]) * 111_195 < 50 and indel_ratio(k[2], r[2]) >= 70  # noqa: B023, E731
        if r[0] not in seen and not any(near(k) for k in kept):
            kept.append(r)
            seen.add(r[0])
    df = spark.createDataFrame(rows, ROW + ", seq long")
    before = spark.createDataFrame([("a1",), ("a2",)], "id string")
    assert sorted(r["seq"] for r in clustering.batch_dedup(df, before).collect()) == [r[-1] for r in kept]


def test_metrics(spark):
    rows = [row("a", "booking", reg="1"), row("b", "airbnb", reg="1"), row("c", "booking", reg="2"), row("d", "airbnb", reg="3"),
        row("e", "airbnb")]
    mapping = spark.createDataFrame([("a", "g1", False), ("b", "g1", False), ("c", "g2", False), ("d", "g2", False), ("e", "g2", False)],
        "id string, group_id string, by_identity boolean")
    m = quality.dedup_metrics(frame(spark, rows), mapping).first()
    assert (m["comparable_groups"], m["agreeing_groups"], m["precision_proxy"], m["conflict_groups"]) == (2, 1, 0.5, ["g2"])
    assert (m["identity_twins"], m["identity_twins_grouped"], m["recall_proxy"]) == (1, 1, 1.0)
    none = quality.dedup_metrics(frame(spark, rows[4:]), mapping).first()
    assert none["precision_proxy"] is None and none["recall_proxy"] is None


def test_components_by_rounds_and_in_one_task(spark):
    """Chains, stars, cliques, loops and nulls; whole numbers, texts and bytes; both ways of settling them."""
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 300),
        rng.randrange(200, 300)) for _ in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    want = {x: find(x) for x in parent}
    for kind, as_node in (("long", lambda x: x), ("string", lambda x: f"é{x:05d}"), ("binary", lambda x: x.to_bytes(4, "big"))):
        df = spark.createDataFrame([(None if a is None else as_node(a), as_node(b)) for a, b in edges], f"a {kind}, b {kind}")
        for few in (0, 1 << 17):
            got = {r["node"]: r["component"] for r in connected_components(df, few_edges=few).collect()}
            assert {(bytes(k) if kind == "binary" else k): (bytes(v) if kind == "binary" else v) for k,
                v in got.items()} == {as_node(k): as_node(v) for k, v in want.items()}
    assert connected_components(df.limit(0)).count() == 0


def test_cells_hold_every_near_pair(spark):
    """Pairs within the distance share a cell everywhere: at the poles and across the date line too."""
    rng = random.Random(4)
    points = []
    for _ in range(4000):
        lat = rng.choice([rng.uniform(-90, 90), rng.uniform(79.95, 80.05), rng.uniform(-80.05, -79.95), rng.uniform(89.99, 90),
            rng.uniform(-0.01, 0.01)])
        lng = rng.choice([rng.uniform(-180, 180), rng.uniform(179.999, 180), rng.uniform(-180, -179.999)])
        angle, far = rng.uniform(0, 2 * math.pi), rng.uniform(0, 300)
        lat2 = max(-90.0, min(90.0, lat + math.degrees(far * math.cos(angle) / 6_371_000)))
        lng2 = lng + math.degrees(far * math.sin(angle) / 6_371_000 / max(1e-6, math.cos(math.radians(lat))))
        points.append((lat, lng, lat2, (lng2 + 180) % 360 - 180))
    df = spark.createDataFrame(points, "a_latitude double, a_longitude double, b_latitude double, b_longitude double")
    own, around = blocking.distance_cells(F.col("a_latitude"), F.col("a_longitude"), 250.0)[0], blocking.distance_cells(F.col("b_latitude"),
        F.col("b_longitude"), 250.0)[1]
    rows = df.select(similarity.pair_distance("a_", "b_").alias("d"), F.array_contains(around, own).alias("meet"),
        F.size(around).alias("n")).collect()
    assert sum(r["d"] <= 250 for r in rows) > 1000
    assert all(r["meet"] for r in rows if r["d"] <= 250) and max(r["n"] for r in rows) == 9


def test_rows_of_one_id_in_a_batch(spark):
    """The first row of an id that stays is the only one; one that falls to a neighbour leaves room for the next."""
    rows = [("x", 1, "flat one", 44.0), ("y", 2, "flat one", 44.0), ("y", 3, "other name", 44.5), ("y", 4, "other name", 44.9),
        ("z", 5, "zzz", 45.0)]
    df = spark.createDataFrame([(i, s, "airbnb", n, lat, 26.0) for i, s, n, lat in rows],
        "id string, seq long, platform string, name string, latitude double, longitude double")
    none = {"bedrooms": "int", "beds": "int", "bathrooms": "double", "max_guests": "int", "amenities": "array<string>"}
    df = df.select("*", *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    assert sorted(r["seq"] for r in clustering.batch_dedup(df).collect()) == [1, 3, 5]


def test_components_follow_batches_of_edges(spark):
    """Stored labels and each batch's changes equal a new computation; only touched nodes are written."""
    rng = random.Random(13)
    schema, every, labels = "a long, b long", [], spark.createDataFrame([], "node long, component long")
    for k, n in enumerate((60, 15, 40, 1)):
        batch = [(rng.randrange(150), rng.randrange(150)) for _ in range(n)] + [(5, 5), (None, 3)]
        before = {r["node"]: r["component"] for r in labels.collect()}
        changes = component_changes(labels, spark.createDataFrame(batch, schema), few_edges=1 if k % 2 else 100)
        told = {r["node"]: (r["component"], r["before"]) for r in changes.collect()}
        every += batch
        want = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(every, schema)).collect()}
        assert told == {x: (c, before.get(x)) for x, c in want.items() if before.get(x) != c}
        rows = with_changes(labels, changes).collect()
        assert {r["node"]: r["component"] for r in rows} == want and len(rows) == len(want)
        labels = spark.createDataFrame(rows, "node long, component long")
