"""Small documents that every operator must cope with."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hits string, size string, shard string, key string"


def documents(spark, texts, ids=None, sources=None):
    """Documents with extra columns whose names operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t), "x", "x", "x", "x") for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", ",", ".", "\n"]) for _ in range(n))


ODD = [None, "", " \t\n", "one", "two words", "É É é Ü\u00a0x", "a\x0bb\x0cc\rd", "x" * 5000, "word " * 3000]
