"""The null-aware upsert as keyed state: what is known of a key is updated in place, and only changed rows are written.

State holds, per column, the value and the order (a sequence number or time) of the row it came
from, so rows may come late, in any order and repeatedly: the result is that of the batch rules
over all rows in order. With ``settle_ms`` a timer gathers the changes of a key and writes it once
in that time; without it a key is written in each batch that changes it.

Edge cases: rows without an order come before all others; of rows of equal order the greater
value stands; a null key is a key; an empty batch writes no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

#: Timers and several states of a key need this store.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rank(value: Any) -> tuple:
    """Null before all values."""
    return () if value is None else (value,)


class LastKnown(StatefulProcessor):
    """One key: overwrite columns have the value of the last row, frozen ones of the first, others the last that is not null."""

    def __init__(self, schema: StructType, key: Sequence[str], order: str, overwrite: Sequence[str], frozen: Sequence[str], settle_ms: int) -> None:
        self.order, self.frozen, self.overwrite, self.settle_ms, self.key = order, set(frozen), set(overwrite), settle_ms, list(key)
        self.rest = [f.name for f in schema if f.name not in (*key, order)]
        at = schema[order].dataType
        # per column: value, order of its row, whether there is one
        fields = [f for i, c in enumerate(self.rest) for f in (StructField(f"v{i}", schema[c].dataType), StructField(f"o{i}", at),
            StructField(f"k{i}", BooleanType()))]
        self.known = StructType(fields)

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("known", self.known)

    def _takes(self, column: str, value: Any, at: Any, known: list) -> bool:
        if column not in self.frozen and column not in self.overwrite and value is None:
            return False
        old_value, old_at, there = known
        if not there:
            return True
        new, old = (_rank(at), _rank(value)), (_rank(old_at), _rank(old_value))
        return new < old if column in self.frozen else new > old

    def _row(self, key: tuple, known: Sequence) -> Row:
        return Row(*self.key, *self.rest)(*key, *known[::3])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.state.get() if self.state.exists() else None
        known = list(before) if before is not None else [None, None, False] * len(self.rest)
        for row in rows:
            at = row[self.order]
            for i, column in enumerate(self.rest):
                if self._takes(column, row[column], at, known[3 * i : 3 * i + 3]):
                    known[3 * i : 3 * i + 3] = [row[column], at, True]
        self.state.update(tuple(known))
        if before is not None and list(before)[::3] == known[::3]:
            return
        if not self.settle_ms:
            yield self._row(tuple(key), known)
        elif not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.settle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self._row(tuple(key), list(self.state.get()))

    def close(self) -> None:
        pass


def changes(rows: DataFrame, key: Sequence[str], order: str, overwrite: Sequence[str] = (), frozen: Sequence[str] = (), settle_ms: int = 0) -> DataFrame:
    """The whole new row (key, then the other columns but order) of each key of a stream, as it changes."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rest = [f for f in rows.schema if f.name not in (*key, order)]
    out = StructType([rows.schema[k] for k in key] + [StructField(f.name, f.dataType) for f in rest])
    processor = LastKnown(rows.schema, key, order, overwrite, frozen, settle_ms)
    return rows.groupBy(*key).transformWithState(processor, out, "Update", "ProcessingTime" if settle_ms else "None")


def write_changes(changed: DataFrame, table: str, checkpoint: str, **trigger: Any) -> StreamingQuery:
    """Each batch's changes go to ``table/written_in=<number>``; a batch that runs again overwrites its own."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/written_in={number}")

    return changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger or
        {"availableNow": True}).start()


def current(spark: SparkSession, table: str, key: Sequence[str]) -> DataFrame:
    """The last written row of each key."""
    rows = spark.read.parquet(table)
    rest = [c for c in rows.columns if c not in (*key, "written_in")]
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "written_in").alias("last"))
    return last.select(*key, *(F.col(f"last.{c}").alias(c) for c in rest))
