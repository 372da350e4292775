"""The live blacklist as the state of a stream: newest entry per key, dropped by a timer when its life is over.

It stands beside the file table of ``sources.keyed`` and is fed from its rows. Whoever asks for the list reads the
state itself, without touching the running query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from skywarden.schema import KEYED_SCHEMA
from skywarden.sources.keyed import NEVER
from skywarden.streaming.jobs import BATCH_INTERVAL, start

_STATE = "value string, expire_ms long, written_ms long"
_OUT = "key string, value string, expire_ms long, written_ms long, event string"
# Timers stand beside the entries, which only this provider can store.
_PROVIDER = ("spark.sql.streaming.stateStore.providerClass",
             "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class NewestEntry(StatefulProcessor):
    """Holds the newest entry of a key and a timer for the end of its life."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.entry.get() if self.entry.exists() else None
        best = None if held is None else (held[2], held[1], held[0])
        newest = max([(r.written_ms, r.expire_ms, r.value) for r in rows] + ([best] if best else []))
        if newest != best:
            written, expire, value = newest
            if best:
                self.handle.deleteTimer(best[1])
            self.handle.registerTimer(expire)
            self.entry.update((value, expire, written))
            yield Row(key=key[0], value=value, expire_ms=expire, written_ms=written, event="listed")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.entry.exists():
            value, expire, written = self.entry.get()
            # A timer of an entry that was replaced meanwhile says nothing.
            if expire <= expiredTimerInfo.getExpiryTimeInMs():
                self.entry.clear()
                yield Row(key=key[0], value=value, expire_ms=expire, written_ms=written, event="over")

    def close(self) -> None:
        pass


def entry_stream(spark: SparkSession, root: str) -> DataFrame:
    """Entries of a keyed table as a stream. An entry may come twice, after a repeated batch; the state takes it once."""
    return spark.readStream.schema(f"{KEYED_SCHEMA}, expire_hour string, batch long").parquet(root)


def live_changes(entries: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """``key, value, expire_ms, written_ms, event`` of the entries that were ``listed`` and of those that are ``over``.

    ``delay`` is how late an entry may come. Timers follow the times entries were written, not the clock of the
    machine, so that a repeated run does the same; entries that never end have no timer to wait for.
    """
    rows = entries.where(F.col("expire_at") < F.lit(NEVER).cast("timestamp")).withWatermark("written_at", delay).select(
        "key", "value", F.unix_millis("expire_at").alias("expire_ms"), F.unix_millis("written_at").alias("written_ms"),
        "written_at")
    return rows.groupBy("key").transformWithState(NewestEntry(), _OUT, "Append", "EventTime")


@contextmanager
def _state_provider(spark: SparkSession) -> Iterator[None]:
    """Queries started meanwhile keep their state with ``_PROVIDER``, whatever the session says; a query takes its settings
    over when it starts, and its checkpoint and readers of its state go on with them."""
    key, provider = _PROVIDER
    before = spark.conf.get(key)
    spark.conf.set(key, provider)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_live_view(entries: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
                  interval: str | None = BATCH_INTERVAL, delay: str = "10 minutes") -> StreamingQuery:
    """Keep the live blacklist as state; ``each`` gets the changes of every batch."""
    with _state_provider(entries.sparkSession):
        return start(live_changes(entries, delay), each, checkpoint, interval)


def live_entries(spark: SparkSession, checkpoint: str, now: str, batch_id: int | None = None) -> DataFrame:
    """``key, value, expire_at, written_at`` of the entries that live at ``now``, out of the state after the last batch or
    the one named. A view that has not run yet, or has met no entry, is empty."""
    reader = spark.read.format("statestore").option("stateVarName", "entry")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    try:
        state = reader.load(checkpoint)
    except PySparkException as e:
        if e.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise
        return spark.createDataFrame([], KEYED_SCHEMA)
    at = F.unix_millis(F.to_timestamp(F.lit(now)))
    return state.where(F.col("value.expire_ms") > at).select(
        "key.key", "value.value", F.timestamp_millis("value.expire_ms").alias("expire_at"),
        F.timestamp_millis("value.written_ms").alias("written_at"))
