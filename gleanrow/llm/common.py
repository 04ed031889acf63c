"""What the training-data operators share: table access and ASCII rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import dropped, new_path, shared_dir, stored

__all__ = [
    "LOWER", "UPPER", "WORD", "all_of", "ascii_lower", "dropped", "keep_first", "name", "new_path", "own_prefix", "read", "shared_dir", "stored",
    "text_key",
]

#: Only A-Z are lower-cased in every contract here; lower() would touch more letters.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def own_prefix(*frames: DataFrame) -> str:
    """A prefix that no column of the frames starts with: names of our own columns beside a caller's."""
    taken = [c.lower() for df in frames for c in df.columns]
    prefix = "_own"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    return prefix


def name(column: str) -> Column:
    """The column of just this name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def all_of(docs: DataFrame) -> list[Column]:
    """Every column of docs by its name."""
    return [name(c) for c in docs.columns]


def text_key() -> Column:
    """Tells texts apart where ids do not: they may be null or repeated."""
    return F.xxhash64(F.col("text").cast("string"), F.length("text"))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with one row of each root of found (doc_id, txt, root; txt is text_key()), a table.

    It is that of the least doc_id (null ids last), then of the least text_key(). Rows that share
    both are copies of one another, and one of them stays; all other rows are told apart by the
    two, so no row goes but for one that is kept in its stead.
    """
    p = own_prefix(docs)
    none, i, txt = f"{p}none", f"{p}id", f"{p}txt"
    first = F.min(F.struct(F.col("doc_id").isNull().alias(none), F.coalesce("doc_id", F.lit(0)).alias(i), F.col("txt").alias(txt)))
    kept = found.groupBy("root").agg(first.alias("k")).select("k.*")
    again = found.groupBy(F.col("doc_id").isNull().alias(none), F.coalesce("doc_id", F.lit(0)).alias(i), F.col("txt").alias(txt)).count()
    again = stored(again.where("count > 1").drop("count"), "again")
    mine = [F.col("doc_id").cast("long").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), text_key()]

    def rows_of(keys: DataFrame) -> DataFrame:
        return docs.join(keys, (mine[0] == keys[none]) & (mine[1] == keys[i]) & (mine[2] == keys[txt]), "left_semi")

    if again.isEmpty():
        return rows_of(kept)
    copies = rows_of(kept.join(again, [none, i, txt], "left_semi"))
    for column, value in zip((none, i, txt), mine, strict=True):
        copies = copies.withColumn(column, value)
    copies = copies.dropDuplicates([none, i, txt]).drop(none, i, txt)
    return rows_of(kept.join(again, [none, i, txt], "left_anti")).unionByName(copies)
