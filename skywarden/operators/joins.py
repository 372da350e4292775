"""Joins that hold when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows up to which a lookup counts as small enough to be sent to every executor.
BROADCAST_ROWS = 200_000
# Parts a hot key is split into when both sides are shuffled.
SALTS = 32
# A key is hot when it holds more than one part in this many of all rows.
HOT_SHARE = 1000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the frame has at most ``max_rows`` rows; reads no more than needed to know."""
    return df.limit(max_rows + 1).count() <= max_rows


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str, spread: Sequence[str],
                salts: int = SALTS) -> DataFrame:
    """Equi-join with each key split into ``salts`` parts.

    The salt is a hash of the ``spread`` columns, so a retried task places its rows as before. The other side,
    which has few rows per key, is repeated once per salt. Only for joins that keep the rows of ``big``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def hot_keys(sizes: DataFrame, on: Sequence[str], rows: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``1/share`` of all rows. There are fewer than ``share`` of them."""
    total = sizes.agg(F.sum(rows).alias("_total"))
    return sizes.where(F.col(rows) * F.lit(share) > total.scalar()).select(*on)


def skew_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str, spread: Sequence[str],
              sizes: DataFrame, rows: str, salts: int = SALTS, share: int = HOT_SHARE) -> DataFrame:
    """Equi-join that salts the hot keys only.

    ``sizes`` has one row per key with its row count in ``big``. The list of hot keys is the only thing broadcast,
    and its length is bounded by ``share`` whatever the data holds.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot salt a {how} join")
    hot = F.broadcast(hot_keys(sizes, on, rows, share).withColumn("_hot", F.lit(True)))
    left = big.join(hot, list(on), "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0))
    right = small.join(hot, list(on), "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                           .otherwise(F.array(F.lit(0)))))
    return left.drop("_hot").join(right.drop("_hot"), [*on, "_salt"], how).drop("_salt")


def sized_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str, spread: Sequence[str] = (),
               max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast the lookup when a count shows that it is small, else shuffle both sides.

    The shuffled form is salted when ``spread`` is given, otherwise left to adaptive skew handling.
    """
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), list(on), how)
    if spread:
        return salted_join(big, small, on, how, spread)
    return big.join(small, list(on), how)
