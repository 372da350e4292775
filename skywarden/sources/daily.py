"""Per-server totals kept by day: a day's run reads the last stored day and today's counts, never the log's history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from skywarden.operators.monitor import roll_server_totals
from skywarden.sources import folders

TOTALS = "server_name string, before_yesterday_num long, yesterday_num long, last_three_days_num long"


@dataclass
class DailyTotals:
    """A folder per day below ``root`` with the totals of all servers after that day, and one with the day's counts."""

    spark: SparkSession
    root: str

    def days(self) -> list[str]:
        return [n.removeprefix("day=") for n in folders.names(self.spark, f"{self.root}/totals")
                if n.startswith("day=") and folders.whole(self.spark, f"{self.root}/totals/{n}")]

    def of(self, day: str) -> DataFrame:
        return self.spark.read.schema(TOTALS).parquet(f"{self.root}/totals/day={day}")

    def start(self, day: str, totals: DataFrame) -> None:
        """Totals to begin with."""
        totals.select("server_name", "before_yesterday_num", "yesterday_num", "last_three_days_num").write.mode(
            "overwrite").parquet(f"{self.root}/totals/day={day}")

    def roll(self, day: str, counts: DataFrame) -> DataFrame:
        """Take in the counts (server_addr, n) of a day, and roll the days after it anew if any were rolled.

        A day that is repeated or corrected replaces what it wrote. Gives the totals after the day.
        """
        counts.select("server_addr", "n").write.mode("overwrite").parquet(f"{self.root}/counts/day={day}")
        later = [d for d in self.days() if d > day and folders.whole(self.spark, f"{self.root}/counts/day={d}")]
        for each in [day, *later]:
            before = [d for d in self.days() if d < each]
            history = self.of(before[-1]) if before else self.spark.createDataFrame([], TOTALS)
            today = self.spark.read.schema("server_addr string, n long").parquet(f"{self.root}/counts/day={each}")
            roll_server_totals(history, today).write.mode("overwrite").parquet(
                f"{self.root}/totals/day={each}")
        return self.of(day)
