"""Metrics over windows of several lengths out of one stream of slices.

The stream's state is that of open slices alone. Finished slices leave partial results in tables; a longer window is
merged from them in the batch in which its last slice is done, and a day from its hours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.operators.metrics import GAP_LIMIT_MS
from skywarden.operators.slices import Partials, partials, rolled, seconds_of, vectors_of
from skywarden.sources.writers import by_folder

# Batches whose progress is remembered; only the one before a repeated batch is ever asked for.
_SLOTS = 100

_KEYS = "window_start timestamp, remote_addr string"
_SCHEMAS = {
    "addresses": f"{_KEYS}, n long, n_critical long, first_ms long, last_ms long, min_gap_ms long",
    "urls": f"{_KEYS}, request string, n long, seen_ms long, first_ms long, last_ms long, short_gaps long",
    "facts": f"{_KEYS}, kind string, value string",
}


@dataclass
class WindowTables:
    """Partial results below ``root``: slices of ``length``, then each longer window, a multiple of the one before."""

    spark: SparkSession
    root: str
    length: str
    longer: Sequence[str] = ()
    threshold_ms: int = GAP_LIMIT_MS

    def __post_init__(self) -> None:
        sizes = [seconds_of(x) for x in (self.length, *self.longer)]
        if any(b % a or a == b for a, b in zip(sizes, sizes[1:])):
            raise ValueError(f"each window length has to be a multiple of the one before: {self.length}, {self.longer}")

    def _path(self, length: str, name: str) -> str:
        return f"{self.root}/{length.replace(' ', '-')}/{name}"

    def _store(self, length: str, parts: Partials, batch_id: int) -> None:
        """Write the partial results of one batch; a repeated batch replaces its rows."""
        def write(name: str, df: DataFrame) -> DataFrame:
            rows = df.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
            (by_folder(rows, "day").withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(self._path(length, name)))
            return df
        parts.map(write)

    def read(self, length: str, low_s: int, high_s: int, batch_id: int | None = None) -> Partials:
        """Partial results of the windows that start from ``low_s`` up to, not including, ``high_s`` (epoch seconds);
        those of one batch only if it is named."""
        low, high = (F.timestamp_seconds(F.lit(x)) for x in (low_s, high_s))
        days = [F.date_format(F.timestamp_seconds(F.lit(x)), "yyyy-MM-dd") for x in (low_s, high_s - 1)]

        def load(name: str, _: object) -> DataFrame:
            rows = self.spark.read.option("basePath", self._path(length, name)).schema(
                f"{_SCHEMAS[name]}, day string, batch long").parquet(self._path(length, name))
            if batch_id is not None:
                rows = rows.where(F.col("batch") == batch_id)
            return rows.where(F.col("day").between(*days) & (F.col("window_start") >= low) & (F.col("window_start") < high)
                              ).drop("day", "batch")
        return Partials(None, None, None).map(load)

    def _closed_before(self, batch_id: int) -> int | None:
        try:
            rows = self.spark.read.schema("batch long, closed_s long, slot int").json(f"{self.root}/progress")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return rows.where(F.col("batch") < batch_id).agg(F.max_by("closed_s", "batch")).first()[0]

    def add(self, states: DataFrame, critical: Column, batch_id: int) -> Iterator[tuple[str, DataFrame]]:
        """Take in the finished slices of a batch. Gives the metric vectors of the slices and of every longer window that
        they complete, each with its length.

        ``states`` is read several times and best persisted. Slices finish in the order of their ends, so a window is
        complete once a slice that ends with it or later is there.
        """
        if not self.longer:
            # Nothing is to be merged later, so nothing is stored.
            yield self.length, vectors_of(partials(states, critical, self.threshold_ms))
            return
        oldest, newest = states.agg(F.min(F.unix_seconds("window_start")), F.max(F.unix_seconds("window_end"))).first()
        if newest is None:
            return
        self._store(self.length, partials(states, critical, self.threshold_ms), batch_id)
        yield self.length, vectors_of(self.read(self.length, oldest, newest, batch_id))
        before = self._closed_before(batch_id)
        finer = self.length
        for length in self.longer:
            step = seconds_of(length)
            low, high = ((x // step) * step for x in (oldest if before is None else before, newest))
            if low < high:
                self._store(length, rolled(self.read(finer, low, high), length, self.threshold_ms), batch_id)
                yield length, vectors_of(self.read(length, low, high))
            finer = length
        (self.spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), F.lit(newest).cast("long").alias("closed_s"))
         .coalesce(1).write.mode("overwrite").json(f"{self.root}/progress/slot={batch_id % _SLOTS}"))


def metric_batches(tables: WindowTables, critical: Callable[[], Column], out: str) -> Callable[[DataFrame, int], None]:
    """Batch function of a stream of ``slice_states``: writes the vectors of every finished window below ``out``, with
    ``window_length``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for length, vectors in tables.add(batch, critical(), batch_id):
                rows = vectors.withColumns({"window_length": F.lit(length), "batch": F.lit(batch_id)})
                (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("window_length", "batch").parquet(out))
        finally:
            batch.unpersist()
    return each
