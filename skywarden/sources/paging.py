"""Pages of a sorted table: sorted once into ranges, of which a page opens those it lies in."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


@dataclass
class PagedTable:
    """Rows below ``root`` in ranges of the sort order; ``order`` has columns and should end in a unique one."""

    spark: SparkSession
    root: str
    order: Sequence[str | Column]

    def store(self, df: DataFrame, ranges: int | None = None) -> None:
        """Sort the rows into ranges, and count them. The counts are as few as the ranges."""
        n = ranges or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = df.repartitionByRange(n, *self.order).sortWithinPartitions(*self.order)
        dealt.withColumn("_range", F.spark_partition_id()).write.mode("overwrite").partitionBy("_range").parquet(
            f"{self.root}/rows")
        # An empty table leaves no file in the ranges that could tell its columns.
        df.limit(0).write.mode("overwrite").parquet(f"{self.root}/columns")
        rows = self._rows()
        rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/counts")

    def _rows(self) -> DataFrame:
        columns = self.spark.read.parquet(f"{self.root}/columns").schema
        return self.spark.read.schema(columns.add("_range", IntegerType())).parquet(f"{self.root}/rows")

    def _counts(self) -> list[tuple[int, int]]:
        rows = self.spark.read.schema("_range int, n long").parquet(f"{self.root}/counts").collect()
        return sorted((r["_range"], r.n) for r in rows)

    def page(self, number: int, rows: int = 20) -> DataFrame:
        """Page ``number``, counted from 1, in order. Reads the ranges that hold it and sorts no more than these."""
        counts = self._counts()
        ends = list(accumulate(n for _, n in counts))
        low, high = (number - 1) * rows, number * rows
        hit = [i for i, end in enumerate(ends) if end > low and end - counts[i][1] < high]
        table = self._rows()
        if not hit:
            return table.drop("_range").limit(0)
        before = ends[hit[0]] - counts[hit[0]][1]
        return (table.where(F.col("_range").isin([counts[i][0] for i in hit])).drop("_range")
                .orderBy(*self.order).offset(low - before).limit(rows))
