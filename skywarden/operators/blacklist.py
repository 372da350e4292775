"""Blacklist life cycle: latest entry per key, restore after a loss, keep-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, key: str = "key", order: str = "key_exp_time") -> DataFrame:
    """Rows that hold the greatest order value of their key; ties stay.

    The join runs on key and value together, so the rows of one key spread over many tasks.
    """
    top = df.groupBy(key).agg(F.max(order).alias(order))
    return df.join(top, [key, order], "inner")


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``. Partial maxima are taken before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def keep_if_absent(new: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows whose key is not there yet."""
    return new.join(current.select(*keys), list(keys), "left_anti")


def still_valid(df: DataFrame, now_ms: Column, column: str = "key_exp_time") -> DataFrame:
    """Rows with more than a whole second left; adds ``ttl_s``."""
    left = F.floor((F.col(column).cast("long") - now_ms) / 1000)
    return df.withColumn("ttl_s", left).where(F.col("ttl_s") > 0)


def restore_blacklist(backup: DataFrame, current: DataFrame, now_ms: Column, restore: bool = True) -> DataFrame:
    """Entries to put back from the backup: newest per key, not expired, not present. Off gives none."""
    picked = keep_if_absent(still_valid(newest_per_key(backup), now_ms), current, ["key"])
    return picked if restore else picked.limit(0)
