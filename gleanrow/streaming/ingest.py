"""Continuous ingest of landed payloads (an extension: the batch rules, run per micro-batch)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import latest_non_null, upsert_last_non_null


def read_landed(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """payload and ts (file time) of JSON or HTML files as they land."""
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_trigger).load(path)
    return files.select(F.col("value").alias("payload"), F.col("_metadata.file_modification_time").alias("ts"))


def distinct_within(rows: DataFrame, delay: str = "1 day") -> DataFrame:
    """Rows (id, ts) without repeats of an id that come within the watermark."""
    return rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id"])


def upsert_into(rows: DataFrame, table: str, checkpoint: str, key: Sequence[str], order: str, overwrite: Sequence[str],
    frozen: Sequence[str], after: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Each micro-batch goes into a new snapshot ``table/v=<batch>`` of the null-aware upsert.

    A batch that is run again after a failure reads the snapshot before its own, so its
    result is the same.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        fresh = latest_non_null(batch, key, order, overwrite)
        if epoch:
            old = spark.read.parquet(f"{table}/v={epoch - 1}")
            fresh = upsert_last_non_null(old, fresh.select(*old.columns), key, overwrite, frozen)
        fresh.write.mode("overwrite").parquet(f"{table}/v={epoch}")
        if after:
            after(spark.read.parquet(f"{table}/v={epoch}"))

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
