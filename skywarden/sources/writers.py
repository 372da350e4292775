"""Sinks: report tables, hourly folders, routed lines."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.schema import BEHAVIOR_CODES

# Topics of processed lines by behavior.
TOPICS = {"Query": "processedQuery", "Book": "processedBook"}
# Rows per output file of a compaction.
FILE_ROWS = 5_000_000


def append_result(df: DataFrame, target: dict[str, str] | str) -> None:
    """Append rows to a report table: a parquet path, or writer options with their ``format``."""
    if isinstance(target, str):
        df.write.mode("append").parquet(target)
        return
    options = dict(target)
    df.write.format(options.pop("format", "jdbc")).mode("append").options(**options).save()


def by_folder(df: DataFrame, *columns: str) -> DataFrame:
    """Bring the rows of an output folder together, so that a folder gets few files.

    Adaptive execution splits folders that are large and joins those that are small.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def hour_columns(time: Column) -> dict[str, Column]:
    return {"dt": F.date_format(time, "yyyy-MM-dd"), "hh": F.date_format(time, "HH")}


def append_hourly(df: DataFrame, root: str, time_col: str) -> None:
    """Append to one folder per hour of the time column."""
    rows = df.withColumns(hour_columns(F.col(time_col)))
    by_folder(rows, "dt", "hh").write.mode("append").partitionBy("dt", "hh").parquet(root)


def write_hourly_batch(df: DataFrame, root: str, time_col: str, batch_id: int) -> None:
    """Hourly folders of one micro-batch; a repeated batch replaces what it wrote before."""
    (by_folder(df.withColumns(hour_columns(F.col(time_col))), "dt", "hh").withColumn("batch", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "hh", "batch").parquet(root))


def read_recent_hours(spark: SparkSession, root: str, now: str, schema: str, hours_back: int = 1) -> DataFrame:
    """Rows of the hour of ``now`` and the hours before it.

    The folders are named outright, so the rest of the history is not even listed; missing hours are left out.
    """
    at = datetime.fromisoformat(now)
    hours = [at - timedelta(hours=i) for i in range(hours_back + 1)]
    folders = ",".join(f"dt={h:%Y-%m-%d}/hh={h:%H}" for h in hours)
    full = f"{schema}, dt string, hh string"
    try:
        return spark.read.option("basePath", root).schema(full).parquet(f"{root}/{{{folders}}}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def route(df: DataFrame, topics: dict[str, str] | None = None) -> DataFrame:
    """Rows that have a topic by their behavior, with ``topic`` and ``value`` in one pass."""
    names = topics or TOPICS
    topic = F.lit(None).cast("string")
    for behavior, name in names.items():
        topic = F.when(F.col("behavior_type") == behavior, F.lit(name)).otherwise(topic)
    return df.withColumn("topic", topic).where(F.col("topic").isNotNull())


def of_behavior(df: DataFrame, code: int) -> DataFrame:
    """Rows of one behavior code."""
    name = {v: k for k, v in BEHAVIOR_CODES.items()}[code]
    return df.where(F.col("behavior_type") == name)


def compact_hour(spark: SparkSession, root: str, day: str, hour: str, out: str, column: str = "value") -> None:
    """Rewrite the files of one archived hour into few files at a new place.

    Spark sizes the output partitions, so a small hour becomes one file and a large one stays parallel.
    """
    rows = spark.read.parquet(root).where(
        (F.col("dt").cast("string") == day) & (F.lpad(F.col("hh").cast("string"), 2, "0") == hour))
    rows.select(column).hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).text(out)
