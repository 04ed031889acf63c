import hashlib
import math
import zlib
from collections import Counter

from gleanrow.llm import hashtree

from .helpers import ODD, documents


def plain_shard(key, node):
    if node.shard is not None:
        return node.shard
    time = lambda c: -math.log((int(hashlib.md5(f"{key}|{c.name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / c.weight
    return plain_shard(key, min(node.children, key=time))


def test_report_against_plain(spark):
    texts = ODD * 60
    rows = hashtree.shard_report(documents(spark, texts), cell_rows=5).collect()
    tree = hashtree.default_tree(16)
    grown = hashtree.add_shard(tree, 16)
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]] or ""
        assert (r["size"], r["text_crc32"], r["law"]) == (len(t.encode()) + 1, zlib.crc32(t.encode()), "key")
        assert (r["shard"], r["grown_shard"]) == (plain_shard(r["doc_id"], tree), plain_shard(r["doc_id"], grown))
        assert r["grown_shard"] in (r["shard"], 16)
    for s, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))


def test_weights_and_confined_movement(spark):
    ids = spark.range(6000).withColumnRenamed("id", "doc_id")
    leaf = lambda n, s, w: hashtree.Node(n, shard=s, own_weight=w)
    tree = lambda w: hashtree.Node("root", (hashtree.Node("a", (leaf("a0", 0, 1.0), leaf("a1", 1, w))),
        hashtree.Node("b", (leaf("b0", 2, 1.0), leaf("b1", 3, 1.0)))))
    both = hashtree.assign(hashtree.assign(ids, tree(1.0)), tree(3.0), "later").collect()
    n = Counter(r["later"] for r in both)
    assert abs(n[1] / 6000 - 0.5) < 0.03 and abs(n[0] / 6000 - 1 / 6) < 0.03
    for r in both:
        if r["shard"] != r["later"]:
            assert r["later"] in (0, 1)  # only into the subtree that has grown
        if r["shard"] in (2, 3) and r["later"] in (2, 3):
            assert r["shard"] == r["later"]


def test_null_and_repeated_ids_and_empty(spark):
    rows = hashtree.shard_report(documents(spark, ["a"] * 6, [None, None, 5, 5, 5, 6])).collect()
    assert len({(r["shard"], r["slot"]) for r in rows}) == 6
    assert len({r["shard"] for r in rows if r["doc_id"] == 5}) == 1
    rows = hashtree.shard_report(documents(spark, ["a", "a", "b", None] * 50, [7, 7, 7, None] * 50), cell_rows=1).collect()
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert len(rows) == 200
    assert hashtree.shard_report(documents(spark, [])).count() == 0
    assert {r["shard"] for r in hashtree.assign(documents(spark, ["a"], [1]).drop("shard"), hashtree.default_tree(1)).collect()} == {0}
    row = hashtree.assign(documents(spark, ["a"], [1]), hashtree.default_tree(1)).first()
    assert (row["shard"], row["shard_"]) == ("x", 0)
