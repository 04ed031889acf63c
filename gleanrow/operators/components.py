"""Connected components by alternating large-star and small-star steps.

Each round rewires every node to the least neighbour it knows; rounds grow with the
logarithm of the longest chain. Edges stay in tables in the shared folder, never on the
driver, which compares a count and a checksum that each round observes while it writes.
At most ``FEW_EDGES`` edges are settled by one task instead, in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.storage import stored

#: Edges that one task settles: some tens of bytes each.
FEW_EDGES = 1 << 17


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges: a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least.hint("merge"), "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """edges as a table, and (count, checksum) of them."""
    seen = Observation()
    part = F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))
    table = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(part).alias("h")), "edges")
    return table, (seen.get["n"], seen.get["h"])


def joined_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """labels (each the least of its set) after the sets of i and j are joined pairwise."""
    while len(i):
        a, b = labels[i], labels[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            break
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up
    return labels


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, component of all edges, which come to one task."""
    held = [b for b in batches if b.num_rows]
    if held:
        edges = pa.Table.from_batches(held)
        ends = pa.chunked_array([*edges.column(0).chunks, *edges.column(1).chunks])
        nodes, at = np.unique(np.array(ends.to_pylist(), object if not pa.types.is_integer(ends.type) else None), return_inverse=True)
        labels = joined_labels(np.arange(len(nodes)), at[: len(at) // 2], at[len(at) // 2 :])
        yield pa.RecordBatch.from_arrays([pa.array(nodes.tolist(), ends.type), pa.array(nodes[labels].tolist(), ends.type)],
            ["node", "component"])


def connected_components(edges: DataFrame, max_rounds: int = 60, few_edges: int = FEW_EDGES) -> DataFrame:
    """From edges (a, b) of any ordered type: node, component (its least node).

    Only nodes with an edge to another node are in the result; nulls and loops are ignored.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    edges, mark = _written(edges.distinct())
    if mark[0] <= few_edges:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.coalesce(1).mapInArrow(_settled, f"node {kind}, component {kind}")
    for _ in range(max_rounds):
        before = mark
        edges, mark = _written(_small_star(_large_star(edges)))
        if mark == before:
            break
    else:
        raise RuntimeError(f"components are not settled after {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def component_changes(labels: DataFrame, edges: DataFrame, few_edges: int = FEW_EDGES) -> DataFrame:
    """node, component, before: what new edges (a, b) change in stored labels (node, component), and new nodes (before is null).

    Stored components are nodes here, by their label, so the work is that of the batch: components of labels that
    the edges join, then the nodes of those labels that give way to a lesser one. Other rows are not written.
    """
    given = stored(edges.select("a", "b").where("a != b").distinct(), "given")
    ends = given.select(F.col("a").alias("node")).unionByName(given.select(F.col("b").alias("node"))).distinct()
    known = ends.join(labels.select("node", "component"), "node", "left")
    at = stored(known.select("node", F.coalesce("component", "node").alias("label"), F.col("component").isNull().alias("fresh")), "ends")
    of = at.select("node", "label")
    joined = given.join(of.toDF("a", "label_a"), "a").join(of.toDF("b", "label_b"), "b")
    merged = stored(connected_components(joined.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")), few_edges=few_edges), "merged")
    now = merged.select(F.col("node").alias("label"), F.col("component").alias("now"))
    fresh = at.where("fresh").join(now, "label", "left").select("node", F.coalesce("now", "label").alias("component"))
    moved = labels.join(now.where("label != now"), F.col("component") == F.col("label")).select("node", F.col("now").alias("component"),
        F.col("component").alias("before"))
    kind = labels.schema["component"].dataType
    return moved.unionByName(fresh.withColumn("before", F.lit(None).cast(kind)))


def with_changes(labels: DataFrame, changes: DataFrame) -> DataFrame:
    """labels after component_changes()."""
    kept = labels.select("node", "component").join(changes.select("node"), "node", "left_anti")
    return kept.unionByName(changes.select("node", "component"))
