"""Moving old snapshots from the keyed store to report tables, in steps that can stop anywhere.

A move first records the rows it will move. Parents and children are then written under the number of the move, the keys
are taken off the store, and the move is marked as done. A move that stopped is taken up from its record: what it wrote
is replaced, so nothing is lost and nothing doubled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.operators import monitor as mon
from skywarden.operators.blacklist import latest_row
from skywarden.sources import folders, keyed
from skywarden.sources.writers import by_folder

_RECORD = "key string, value string, expire_at timestamp, written_at timestamp"


@dataclass
class SnapshotDrain:
    """Drain of the keyed table ``store`` into the tables ``parents`` and ``children`` below ``reports``."""

    spark: SparkSession
    store: str
    reports: str
    prefix: str
    older_minutes: int = 30

    def _move(self, number: int) -> str:
        return f"{self.reports}/_moves/{number:09d}"

    def _recorded(self) -> list[int]:
        return [int(n) for n in folders.names(self.spark, f"{self.reports}/_moves")
                if folders.whole(self.spark, f"{self._move(int(n))}/rows")]

    def _pending(self) -> list[int]:
        return [n for n in self._recorded() if not folders.whole(self.spark, f"{self._move(n)}/done")]

    def table(self, name: str) -> DataFrame:
        """Parent or child rows of all moves."""
        return self.spark.read.parquet(f"{self.reports}/{name}").drop("move")

    def run(self, now: str, after: Callable[[str], None] = lambda step: None) -> int:
        """Finish what an earlier run has left, then move the snapshots older than the bound; says how many rows moved.

        ``after`` is told each step that is done.
        """
        for number in self._pending():
            self._carry_out(number, now, after)
        # Also those whose life is over, as long as their folders are there; keys that were taken off hold no value.
        newest = latest_row(keyed.stored(self.spark, self.store).select("key", "value", "expire_at", "written_at"), ["key"],
                            ["written_at", "expire_at", "value"])
        rows = keyed.with_prefix(newest, self.prefix).where(~F.col("key").endswith("_LAST") & (F.col("value") != ""))
        old = mon.decode_throughput(rows)
        bound = mon.drain(old, now, self.older_minutes)[0].select(F.col("id").alias("key"))
        number = max(self._recorded(), default=0) + 1
        # Whatever was not finished of this number is no record, and is replaced.
        rows.join(bound, "key", "left_semi").select("key", "value", "expire_at", "written_at").write.mode("overwrite").parquet(
            f"{self._move(number)}/rows")
        after("recorded")
        return self._carry_out(number, now, after)

    def _carry_out(self, number: int, now: str, after: Callable[[str], None]) -> int:
        moved = self.spark.read.schema(_RECORD).parquet(f"{self._move(number)}/rows")
        # Every recorded row goes, however much time has passed since.
        parent, child, _ = mon.drain(mon.decode_throughput(moved), keyed.NEVER, 0)
        for name, df in (("parents", parent), ("children", child)):
            (by_folder(df.withColumn("move", F.lit(number)), "move").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("move").parquet(f"{self.reports}/{name}"))
            after(name)
        at = F.to_timestamp(F.lit(now))
        # A row of the key that is over when it is written takes the key off the live view.
        gone = moved.select("key", F.lit("").alias("value"), at.alias("expire_at"), at.alias("written_at"))
        keyed.put(gone, self.store, -1_000_000_000 - number)
        after("taken off")
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self._move(number)}/done")
        after("done")
        return moved.count()
