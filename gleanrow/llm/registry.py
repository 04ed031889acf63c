"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import chat, codes, decontam, gam, hashtree, hosts, iforest, lines, maxent, mixing, repair, simhash, warc
from .common import read
from .sql import ORACLES


def op1_chat_format(spark, sf_dir):
    """All conversations plus -7, whose two texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    base = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.expand(base.unionByName(extra)))


def op2_simhash(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op3_line_dedup(spark, sf_dir):
    found = lines.drop_repeated(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_decontaminate(spark, sf_dir):
    found = decontam.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_url_filter(spark, sf_dir):
    return hosts.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def op6_warc(spark, sf_dir):
    return warc.round_trip(read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_lm_score(spark, sf_dir):
    return maxent.score_documents(read(spark, sf_dir, "documents"))


def op8_quality_rules(spark, sf_dir):
    found = iforest.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", *iforest.COUNTS, "base_failed", "kept")


def op9_shard(spark, sf_dir):
    return hashtree.shard_report(read(spark, sf_dir, "documents"))


def op10_mix(spark, sf_dir):
    return mixing.mix_report(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_vector_codes(spark, sf_dir):
    return codes.compress(read(spark, sf_dir, "embeddings"))


def op12_quality_classifier(spark, sf_dir):
    found = gam.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op13_conversation_repair(spark, sf_dir):
    return repair.report(repair.damage(read(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_simhash, op3_line_dedup, op4_decontaminate, op5_url_filter, op6_warc, op7_lm_score,
    op8_quality_rules, op9_shard, op10_mix, op11_vector_codes, op12_quality_classifier, op13_conversation_repair)}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
