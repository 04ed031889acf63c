"""Null-aware upserts as joins of the old table with a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pair(old: DataFrame, new: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    o = old.select(F.struct(*old.columns).alias("o"), *(F.col(k).alias(f"_{k}") for k in key))
    n = new.select(F.struct(*new.columns).alias("n"), *(F.col(k).alias(f"_{k}") for k in key))
    return o.join(n, [f"_{k}" for k in key], how)


def latest_non_null(batch: DataFrame, key: Sequence[str], order: str, overwrite: Sequence[str] = ()) -> DataFrame:
    """A batch with repeated keys as one row each, as if its rows had been written in order."""
    rest = [c for c in batch.columns if c not in (*key, order)]
    pick = lambda c: F.max_by(c, order) if c in overwrite else F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    return batch.groupBy(*key).agg(*(pick(c).alias(c) for c in rest))


def upsert_last_non_null(old: DataFrame, new: DataFrame, key: Sequence[str], overwrite: Sequence[str], frozen: Sequence[str]) -> DataFrame:
    """old after new: overwrite columns take the new value even if null, frozen ones are only set on insert, others take a new value if there is one."""

    def value(c: str) -> Column:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in key or c in frozen:
            return F.when(F.col("o").isNotNull(), o).otherwise(n)
        if c in overwrite:
            return F.when(F.col("n").isNotNull(), n).otherwise(o)
        return F.coalesce(n, o)

    return _pair(old, new, key, "full_outer").select(*(value(c).alias(c) for c in old.columns))


def enrich_first_non_null(old: DataFrame, new: DataFrame, key: Sequence[str], prefer_new: Sequence[str] = (), overwrite: Sequence[str] = (),
    soft: dict[str, str] | None = None) -> DataFrame:
    """old with its nulls filled from new; keys that old lacks are ignored.

    prefer_new columns take a new value if there is one, overwrite columns take it even if null. soft: columns whose given
    value is a placeholder that real values replace and that never replaces a real value.
    """
    soft = soft or {}

    def value(c: str) -> Column:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}") if c in new.columns else F.lit(None)
        if c in key or c not in new.columns:
            return o
        if c in overwrite:
            return F.when(F.col("n").isNotNull(), n).otherwise(o)
        if c in soft:
            return F.coalesce(F.nullif(n, F.lit(soft[c])), o, n)
        return F.coalesce(n, o) if c in prefer_new else F.coalesce(o, n)

    return _pair(old, new, key, "left").select(*(value(c).alias(c) for c in old.columns))


def write_counts(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many of new's keys insert and how many update."""
    there = old.select(*key).distinct().withColumn("_there", F.lit(True))
    return new.select(*key).distinct().join(there, list(key), "left").agg(F.count_if(F.col("_there").isNull()).alias("inserted"),
        F.count_if("_there").alias("updated"))


def insert_or_ignore(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    return old.unionByName(new.join(old.select(*key), list(key), "left_anti"), allowMissingColumns=True)


def init_progress(old: DataFrame, cells: DataFrame) -> DataFrame:
    """old with every new (cell_id, platform) as pending."""
    fresh = cells.select("cell_id", "platform").distinct().withColumn("status", F.lit("pending"))
    return insert_or_ignore(old, fresh, ["cell_id", "platform"])


def apply_transitions(progress: DataFrame, events: DataFrame) -> DataFrame:
    """progress after events (cell_id, platform, status, at, result_count, error_message): the latest decides.

    in_progress sets started_at; completed, failed and needs_refinement set the count, the end and the error.
    Unknown cells are ignored.
    """
    ended = F.col("status").isin("completed", "failed", "needs_refinement")
    known = events.where(ended | (F.col("status") == "in_progress"))
    last = known.groupBy("cell_id", "platform").agg(
        F.max_by("status", "at").alias("_status"), F.max(F.when(F.col("status") == "in_progress", F.col("at"))).alias("_started"),
        F.max(F.when(ended, F.col("at"))).alias("_ended"),
        F.max_by(F.struct(F.coalesce("result_count", F.lit(0)).alias("n"), "error_message"), F.when(ended, F.col("at"))).alias("_end"),
    )
    was_ended = F.col("_ended").isNotNull()
    return progress.join(last, ["cell_id", "platform"], "left").select(
        "cell_id", "platform", F.coalesce("_status", "status").alias("status"), F.coalesce("_started", "started_at").alias("started_at"),
        F.coalesce("_ended", "completed_at").alias("completed_at"),
        F.when(was_ended, F.col("_end.n")).otherwise(F.col("result_count")).alias("result_count"),
        F.when(was_ended, F.col("_end.error_message")).otherwise(F.col("error_message")).alias("error_message"),
    )


def finish_runs(runs: DataFrame, ends: DataFrame) -> DataFrame:
    """runs after ends (run_id, completed_at and tallies): given tallies replace, missing ones stay."""
    tallies = [c for c in ("total_listings", "completed_cells", "listings_dropped") if c in ends.columns]
    done = ends.withColumn("status", F.lit("completed"))
    return enrich_first_non_null(runs, done.select("run_id", "completed_at", "status", *tallies), ["run_id"], prefer_new=tallies,
        overwrite=["completed_at", "status"])


def replace_latest(old: DataFrame, new: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """One row per key: the latest of both tables, all its columns."""
    both = old.unionByName(new)
    return both.groupBy(*key).agg(F.max_by(F.struct(*both.columns), order).alias("r")).select("r.*")


def merge_fields(row: str, page: str, overwrite: Sequence[str], fill: Sequence[str],
    fallback: dict[str, str] | None = None) -> list[Column]:
    """Columns of a detail merge: page values overwrite where they exist, or only fill gaps; fallback labels come last."""
    out = [F.coalesce(F.col(f"{page}.{c}"), F.col(f"{row}.{c}"),
        *([F.lit(fallback[c])] if fallback and c in fallback else [])).alias(c) for c in overwrite]
    return out + [F.coalesce(F.col(f"{row}.{c}"), F.col(f"{page}.{c}")).alias(c) for c in fill]
