"""The corpus pipeline: documents in, cleaned, mixed and sharded documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents;
the last adds the shard of each row.

Edge cases: null, empty and very short texts fail the base rules and go in the first stage; rows
with null or repeated ids are judged, grouped and mixed as rows of their own (unrelated texts of
one id all stay, exactly repeated rows are copies of one another); empty tables go through all
stages; columns of any other name pass through, and the shard's column is called ``shard``, with
underscores after it where documents has one of that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanrow.functions.storage import dropped, scratch
from gleanrow.llm import decontam, hashtree, iforest, mixing, simhash
from gleanrow.llm.common import new_path, read

SHARDS = 16


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or that the isolation forest finds unusual go."""
    return iforest.keep(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word similarity of 0.8 or more by their fingerprints) stays: that of the least doc_id."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark windows over a twentieth of their words go."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is repeated or left out so that sources meet their targets."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row gets the shard that the hash tree gives its doc_id."""
    return hashtree.assign(docs, hashtree.default_tree(SHARDS))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: The forest and the fingerprints are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, as a table; what a stage read and stored is removed once it is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            dropped(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
