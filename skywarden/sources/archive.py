"""Hourly archive that is compacted while a stream writes to it.

Batches write to folders of their own. Compaction merges finished batches of an hour into one table and then publishes a
manifest that names it and the batches it holds. Readers follow the newest whole manifest and take the batches that it
does not name, so at every moment each row is seen once, whatever step a compaction has come to.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skywarden.sources import folders
from skywarden.sources.writers import FILE_ROWS


@dataclass
class HourArchive:
    """The folders that ``write_hourly_batch`` fills below ``root``; ``schema`` is that of the rows."""

    spark: SparkSession
    root: str
    schema: str | StructType

    def _hour(self, day: str, hour: str) -> str:
        return f"{self.root}/dt={day}/hh={hour}"

    def _merged(self, day: str, hour: str) -> str:
        # Names with an underscore are not read as part of the archive.
        return f"{self.root}/_merged/dt={day}/hh={hour}"

    def batches(self, day: str, hour: str) -> list[int]:
        return sorted(int(n.removeprefix("batch=")) for n in folders.names(self.spark, self._hour(day, hour))
                      if n.startswith("batch="))

    def _numbers(self, day: str, hour: str, kind: str) -> list[int]:
        at = self._merged(day, hour)
        return sorted(int(n.removeprefix(kind)) for n in folders.names(self.spark, at)
                      if n.startswith(kind) and folders.whole(self.spark, f"{at}/{n}"))

    def manifest(self, day: str, hour: str) -> tuple[int, list[int]]:
        """Number of the merged table that counts and the batches in it; 0 and none before the first."""
        found = self._numbers(day, hour, "manifest-")
        if not found:
            return 0, []
        row = self.spark.read.schema("value string").text(f"{self._merged(day, hour)}/manifest-{found[-1]}").first()
        return found[-1], json.loads(row.value)

    def _parts(self, day: str, hour: str, number: int, loose: list[int]) -> DataFrame:
        paths = [f"{self._hour(day, hour)}/batch={b}" for b in loose]
        if number:
            paths.append(f"{self._merged(day, hour)}/rows-{number}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, day: str, hour: str) -> DataFrame:
        """All rows of an hour, each once."""
        number, merged = self.manifest(day, hour)
        return self._parts(day, hour, number, [b for b in self.batches(day, hour) if b not in set(merged)])

    def compact(self, day: str, hour: str, upto: int, least: int = 2) -> int:
        """Merge the batches up to number ``upto`` that are not merged yet, if there are at least ``least``; says how
        many. ``upto`` is the last finished batch (``folders.committed_batch``): the one at work may still be repeated.
        """
        number, merged = self.manifest(day, hour)
        loose = [b for b in self.batches(day, hour) if b <= upto and b not in set(merged)]
        if len(loose) < least:
            return 0
        at, new = self._merged(day, hour), max([number, *self._numbers(day, hour, "rows-")]) + 1
        # Spark sizes the output: a small hour becomes one file, a large one stays parallel.
        (self._parts(day, hour, number, loose).hint("rebalance").write.mode("overwrite")
         .option("maxRecordsPerFile", FILE_ROWS).parquet(f"{at}/rows-{new}"))
        (self.spark.range(1).select(F.lit(json.dumps(sorted([*merged, *loose]))).alias("value")).coalesce(1)
         .write.mode("overwrite").text(f"{at}/manifest-{new}"))
        return len(loose)

    def clean(self, day: str, hour: str) -> int:
        """Delete what the newest manifest has made superfluous: merged batches, older tables and manifests, and tables
        that were never published. For a time when no reader that began before the last compaction is still at work.
        """
        number, merged = self.manifest(day, hour)
        if not number:
            return 0
        at = self._merged(day, hour)
        old = [f"{self._hour(day, hour)}/batch={b}" for b in merged]
        old += [f"{at}/{n}" for n in folders.names(self.spark, at) if n.split("-")[-1].isdigit() and int(n.split("-")[-1]) != number]
        return sum(folders.remove(self.spark, p) for p in old if folders.exists(self.spark, p))
