"""Keyed table with expiry, kept as files.

Writes only append: a later row of a key replaces an earlier one when read. Folders are cut by expiry hour, so a
reader of live entries opens the hours that can still hold some and no others, however long the history is.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.operators.blacklist import latest_row
from skywarden.schema import KEYED_SCHEMA
from skywarden.sources.writers import by_folder

NEVER = "9999-12-31 00:00:00"
_COLUMNS = ["key", "value", "expire_at", "written_at"]


def put(df: DataFrame, root: str, batch_id: int) -> None:
    """Write entries of one batch; repeating the batch replaces its rows.

    An entry that never expires has a folder of its own that the next one of its key replaces.
    """
    rows = df.select(*_COLUMNS).withColumn("expire_hour", F.date_format("expire_at", "yyyy-MM-dd-HH"))
    own = F.when(F.col("expire_at") >= F.lit(NEVER).cast("timestamp"), F.pmod(F.xxhash64("key"), F.lit(1 << 40)))
    (by_folder(rows, "expire_hour").withColumn("batch", F.coalesce(own, F.lit(batch_id).cast("long")))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("expire_hour", "batch").parquet(root))


def stored(spark: SparkSession, root: str) -> DataFrame:
    """All entries; a table that was never written, or is lost, has none."""
    schema = f"{KEYED_SCHEMA}, expire_hour string, batch long"
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def between(spark: SparkSession, root: str, low: str, high: str, ttl_s: int) -> DataFrame:
    """Entries written from ``low`` to ``high`` that live for ``ttl_s``; opens the hours in which those expire."""
    first, last = (F.to_timestamp(F.lit(x)) for x in (low, high))
    life = F.make_dt_interval(secs=F.lit(ttl_s))
    hours = [F.date_format(x + life, "yyyy-MM-dd-HH") for x in (first, last)]
    return stored(spark, root).where(F.col("expire_hour").between(*hours)).where(F.col("written_at").between(first, last))


def newest_hour(spark: SparkSession, root: str) -> DataFrame:
    """Entries of the latest hour that holds any which expire."""
    rows = stored(spark, root)
    hours = rows.where(F.col("expire_hour") < NEVER[:4]).agg(F.max("expire_hour").alias("h"))
    return rows.where(F.col("expire_hour") == hours.scalar())


def live(spark: SparkSession, root: str, now: str) -> DataFrame:
    """Newest unexpired entry per key."""
    at = F.to_timestamp(F.lit(now))
    rows = stored(spark, root).where(F.col("expire_hour") >= F.date_format(at, "yyyy-MM-dd-HH"))
    newest = latest_row(rows.select(*_COLUMNS), ["key"], ["written_at", "expire_at", "value"])
    return newest.where(F.col("expire_at") > at)


def drop_expired(spark: SparkSession, root: str, now: str) -> int:
    """Delete the folders of hours that are over before ``now``; says how many. Their entries are all expired."""
    hour = datetime.fromisoformat(now).strftime("%Y-%m-%d-%H")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in fs.listStatus(path)
            if s.getPath().getName().startswith("expire_hour=") and s.getPath().getName() < f"expire_hour={hour}"]
    return sum(bool(fs.delete(p, True)) for p in gone)


def entries(df: DataFrame, prefix: str, at: Column, value: Column, ttl_s: int, carry: Sequence[str] = ()) -> DataFrame:
    """Entries keyed by prefix and time in milliseconds."""
    return df.select(
        *carry, F.concat(F.lit(prefix), F.unix_millis(at).cast("string")).alias("key"), value.alias("value"),
        (at + F.make_dt_interval(secs=F.lit(ttl_s))).alias("expire_at"), at.alias("written_at"))


def with_last(df: DataFrame, prefix: str, suffix: str = "_LAST") -> DataFrame:
    """The entries of a prefix plus one that holds the newest value and never expires."""
    own = df.where(F.col("key").startswith(prefix))
    newest = own.agg(F.max_by("value", F.struct("written_at", "key")).alias("value"),
                     F.max("written_at").alias("written_at")).where(F.col("value").isNotNull())
    last = newest.select(F.lit(prefix + suffix).alias("key"), "value",
                         F.lit(NEVER).cast("timestamp").alias("expire_at"), "written_at")
    return df.select(*_COLUMNS).unionByName(last)


def with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Entries whose key starts with a prefix."""
    return df.where(F.col("key").startswith(prefix))
