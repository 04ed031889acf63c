"""Columns of any name pass through the operators that return whole documents."""

import random

import corpus_pipeline
import pytest
from gleanrow.llm import decontam, hashtree, iforest, mixing, simhash

from .helpers import prose
from .test_iforest import junk

#: Names that an operator might use inside, and names that need quoting.
NAMES = (
    "_w", "_hits", "_c13", "_n_words", "_row", "_hit", "_s", "_rate", "_seed", "_copy", "_id", "_kept", "_cell", "_rank", "_txt", "_none",
    "shard", "shard_", "fp", "root", "txt", "key", "keys", "hits", "slot",
    "size", "n", "text_id", "n_words", "items", "source_size", "target", "rate", "quality", "_own", "_ownid", "_OWNtxt", "_own_text_id",
    "a.b", "back`tick", "word count", "len", "start",
)


def wide(spark):
    rng = random.Random(21)
    texts = [prose(rng, 200, 3000) for _ in range(12)]
    item = prose(rng, 40, 9000)
    texts += [texts[0], item + " " + prose(rng, 60, 3000), *(junk(rng, "symbols", 90) for _ in range(3)), None, ""]
    base = [(i, t, f"s{i % 2}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, *(f"{c}-{r[0]}" for c in NAMES)) for r in base], ["doc_id", "text", "source", *NAMES])
    labels = spark.createDataFrame([(i, int(i < 14), 0) for i in range(17)], "doc_id long, quality int, toxic int")
    return docs, labels, spark.createDataFrame([(1, item)], "item_id long, text string")


OPERATORS = {
    "quality": lambda d, labels, bench: iforest.keep(d, labels),
    "near_dedup": lambda d, labels, bench: simhash.keep_one(d),
    "near_dedup_copies": lambda d, labels, bench: simhash.keep_one(d.unionByName(d)),
    "decontaminate": lambda d, labels, bench: decontam.decontaminate(d, bench),
    "spans": lambda d, labels, bench: decontam.remove_spans(d, bench),
    "mix": lambda d, labels, bench: mixing.mix(d),
    "shard": lambda d, labels, bench: hashtree.assign(d, hashtree.default_tree(16)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_come_through_unchanged(spark, name):
    docs, labels, bench = wide(spark)
    out = OPERATORS[name](docs, labels, bench)
    assert out.columns[: len(docs.columns)] == docs.columns
    given = {tuple(r) for r in docs.collect()}
    rows = [tuple(r)[: len(docs.columns)] for r in out.collect()]
    assert rows and set(rows) <= given
    if name == "decontaminate":
        assert len(rows) == len(given) - 1


def test_pipeline_with_odd_tables(spark, tmp_path):
    """Extra columns, null and repeated ids, repeated rows, null, empty and long texts; then empty tables."""
    docs, labels, bench = wide(spark)
    rng = random.Random(3)
    one = prose(rng, 300, 3000)
    # column names of Parquet may not hold all marks in all readers: the plain ones stay
    plain = [c for c in docs.columns if not set(c) & set(".` ")]
    more = [(None, one, "s0"), (None, prose(rng, 250, 3000), None), (5, prose(rng, 250, 3000), "s1"), (5, one, "s1"),
        (40, prose(rng, 60_000, 9000), "s0"), (40, "", "s0")]
    extra = spark.createDataFrame([(*r, *("x" for _ in plain[3:])) for r in more], docs.select(*plain).schema)
    docs.select(*plain).unionByName(extra).unionByName(extra).write.parquet(str(tmp_path / "full/documents.parquet"))
    labels.write.parquet(str(tmp_path / "full/labels.parquet"))
    bench.write.parquet(str(tmp_path / "full/benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path / "full"))
    assert out.columns == [*plain, "shard__"]
    rows = out.collect()
    texts = {r["text"] for r in rows}
    assert len([t for t in texts if t == one]) <= 1 and None not in texts and "" not in texts
    assert {r["shard__"] for r in rows} <= set(range(16))
    for name, df in (("documents", docs.select(*plain)), ("labels", labels), ("benchmark", bench)):
        df.limit(0).write.parquet(str(tmp_path / f"none/{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
