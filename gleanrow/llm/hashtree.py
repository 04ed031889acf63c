"""Sharding by a hierarchical weighted hash tree.

A document starts at the root and at each level draws one number per child, from its id and
the child's name; the child with the least ``-ln(draw) / weight`` takes it (the race that
child i wins with probability weight_i / sum of weights). A child's draw depends on no
other child, so a changed weight moves documents only into or out of that subtree. A shard
that is added becomes a region of its own: it wins documents from every other region and
none move between those. Law: ``key``.

slot counts a shard's documents from 0 without gaps: documents of a shard are dealt into
cells by a hash of id, size and checksum, as many cells as keep about ``CELL_ROWS`` rows each;
a document's slot is the count of the cells before its own plus its rank in the cell, so only
cell counts meet in one place. Rows that are equal in all three are counted as one row and
share out a run of slots, so a third of all rows may be copies of one without a long sort.

Edge cases: a null doc_id is drawn as the text "null"; equal ids share a shard and get
different slots, by size, then checksum (rows that are equal in all three differ in nothing
that is reported); an empty table has no rows; null text has size 1 and checksum 0; columns of
any name pass through assign() unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import own_prefix

#: Rows that a cell holds on average, and offsets of cells that are broadcast; more are joined by shuffle.
CELL_ROWS, BROADCAST_CELLS = 1 << 16, 1 << 18
#: Children of the first shards: regions of racks of shards.
SHARDS_PER_RACK, RACKS_PER_REGION = 4, 2


@dataclass(frozen=True)
class Node:
    """A leaf has a shard; an inner node has children. weight: of the leaves below, if not given."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def default_tree(shards: int) -> Node:
    """Regions of 2 racks of 4 shards; what does not fill a region stands in regions of one shard."""
    per = SHARDS_PER_RACK * RACKS_PER_REGION
    regions = []
    for r in range(shards // per):
        racks = tuple(Node(f"{r}.{k}", tuple(Node(f"{r}.{k}.{s}",
            shard=r * per + k * SHARDS_PER_RACK + s) for s in range(SHARDS_PER_RACK))) for k in range(RACKS_PER_REGION))
        regions.append(Node(f"{r}", racks))
    tree = Node("root", tuple(regions))
    for s in range(shards // per * per, shards):
        tree = add_shard(tree, s)
    return tree


def add_shard(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, as a region of its own: documents move only into it."""
    return Node(tree.name, (*tree.children, Node(f"+{shard}", shard=shard, own_weight=weight)))


def draw(key: Column, name: Column) -> Column:
    """In (0, 1): 52 bits of md5 of the key and a node's name, so other engines can repeat it."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), name)), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2**52)


def by_level(tree: Node) -> list[list[list[tuple[str, float, int]]]]:
    """Per level, per node: (name, weight, index in the next level) of its children.

    A leaf above the lowest level goes down as its own only child; the last indexes are shards.
    """
    out, row = [], [tree]
    while any(n.children for n in row):
        below, level = [], []
        for n in row:
            own = []
            for c in n.children or (n,):
                own.append((c.name, c.weight, len(below)))
                below.append(c)
            level.append(own)
        out.append(level)
        row = below
    if out:
        out[-1] = [[(name, weight, row[i].shard) for name, weight, i in own] for own in out[-1]]
    return out


def assign(docs: DataFrame, tree: Node, into: str = "shard") -> DataFrame:
    """docs with the shard of each row as its last column; a narrow plan, one step a level.

    The column is called ``into``, with as many underscores after it as set it apart from docs' own.
    """
    while into.lower() in (c.lower() for c in docs.columns):
        into += "_"
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    out = docs.withColumn(into, F.lit(0 if tree.children else tree.shard))
    for level in by_level(tree):
        child = lambda name, weight, to: F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight"),
            F.lit(to).alias("to"))
        nodes = F.array(*(F.array(*(child(*c) for c in own)) for own in level))
        out = out.withColumn(into, _race(key, F.get(nodes, F.col(into))))
    return out


def _race(key: Column, children: Column) -> Column:
    times = F.transform(children, lambda c: F.struct((-F.ln(draw(key, c["name"])) / c["weight"]).alias("t"), c["to"].alias("to")))
    return F.array_min(times)["to"]


def with_slots(rows: DataFrame, shards: int, cells: int) -> DataFrame:
    """rows (doc_id, shard below shards, and more) with slot long; cells: into which each shard is dealt."""
    p = own_prefix(rows)
    cell, n, before, first = (p + x for x in ("cell", "n", "before", "first"))
    dealt = rows.groupBy(*rows.columns).agg(F.count("*").alias(n))
    whole = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in rows.columns))
    dealt = dealt.withColumn(cell, (F.conv(F.substring(F.md5(whole), 1, 8), 16, 10).cast("long") % cells).cast("int"))
    counts = dealt.groupBy("shard", cell).agg(F.sum(n).alias(n))
    ahead = Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", cell, F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(before))
    within = Window.partitionBy("shard", cell).orderBy("doc_id", *rows.columns).rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn(first, F.coalesce(F.sum(n).over(within), F.lit(0)))
    # 24 bytes for each cell of each shard
    offsets = F.broadcast(offsets) if cells * shards <= BROADCAST_CELLS else offsets
    out = ranked.join(offsets, ["shard", cell])
    start = F.col(before) + F.col(first)
    return out.select(*rows.columns, F.explode(F.sequence(start, start + F.col(n) - 1)).alias("slot"))


def shard_report(docs: DataFrame, shards: int = 16, cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    tree = default_tree(shards)
    text = F.coalesce("text", F.lit(""))
    size, crc = (F.octet_length(text) + 1).cast("long"), F.crc32(text).cast("long")
    narrow = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("key").alias("law"))
    cells = max(1, -(-docs.count() // (cell_rows * shards)))
    out = with_slots(assign(assign(narrow, tree), add_shard(tree, shards), "grown_shard"), shards + 1, cells)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
