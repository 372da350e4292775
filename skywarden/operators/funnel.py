"""Stage conversion, query-to-book ratios and volumes.

All figures come from one pass over the requests: rows collapse to counts per dimension, and every ratio is taken
from that small frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.operators.joins import sized_join
from skywarden.operators.tag import spider_tag, stage_tag

ALL = "all"


def tag_spiders(requests: DataFrame, spiders: DataFrame, how: str = "left", dedup: bool = True,
                spread: Sequence[str] = ()) -> DataFrame:
    """Requests with the flow id of their address on the spider list.

    ``left`` keeps requests of normal users; ``inner`` keeps listed addresses only. Without ``dedup`` an address
    that is listed twice doubles its requests.
    """
    return sized_join(requests, listed_spiders(spiders, dedup), ["remote_addr"], how, spread=spread)


def listed_spiders(spiders: DataFrame, dedup: bool = True) -> DataFrame:
    listed = spiders.select("remote_addr", "flow_id")
    return listed.groupBy("remote_addr").agg(F.min("flow_id").alias("flow_id")) if dedup else listed


def stage_counts(requests: DataFrame, spiders: DataFrame | None = None, by: Sequence[str] = (),
                 how: str = "left", dedup: bool = True) -> DataFrame:
    """Requests per stage, with and without a session, by dimension and spider tag.

    Rows are counted per address before they meet the spider list, so a hot address is a handful of rows then.
    """
    tagged = requests.withColumn("_stage", stage_tag(F.col("request"))).withColumn(
        "_session", ~F.col("jsessionid").contains("NULL"))
    if spiders is None:
        per = tagged.groupBy(*by, "_stage", "_session", "flow_id").agg(F.count(F.lit(1)).alias("_n"))
    else:
        per = (tagged.groupBy("remote_addr", *by, "_stage", "_session").agg(F.count(F.lit(1)).alias("_n")))
        per = per.join(listed_spiders(spiders, dedup), ["remote_addr"], how)
    per = per.withColumn("spider_tag", spider_tag(F.col("flow_id")))

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0)).cast("long")

    stages = ("0", "1", "2", "3")
    return per.groupBy(*by, "spider_tag").agg(
        *[total(F.col("_stage") == s).alias(f"stage{s}") for s in stages],
        *[total((F.col("_stage") == s) & F.col("_session")).alias(f"stage{s}_session") for s in stages],
        F.sum("_n").cast("long").alias("requests"))


_SUMS = [f"stage{s}{x}" for s in "0123" for x in ("", "_session")] + ["requests"]


def fold(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stage counts summed to fewer dimensions."""
    return counts.groupBy(*by).agg(*[F.sum(c).cast("long").alias(c) for c in _SUMS])


def by_tag_with_total(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per spider tag plus one ``all`` row, from one pass."""
    rolled = counts.groupingSets([[*by, "spider_tag"], [*by]], *by, "spider_tag").agg(
        *[F.sum(c).cast("long").alias(c) for c in _SUMS], F.grouping("spider_tag").alias("_all"))
    return rolled.withColumn(
        "spider_tag", F.when(F.col("_all") == 1, F.lit(ALL)).otherwise(F.col("spider_tag"))).drop("_all")


def conversion(counts: DataFrame, step: int, session_filter: str = "numerator") -> Column:
    """Rate from ``step - 1`` to ``step``; the numerator counts rows with a session only.

    ``session_filter="both"`` asks the same of the denominator. An empty denominator gives null.
    """
    den = f"stage{step - 1}_session" if session_filter == "both" else f"stage{step - 1}"
    return F.try_divide(F.col(f"stage{step}_session").cast("double"), F.col(den).cast("double"))


def query_book_ratio(session: Column) -> Column:
    """Bookings per query: spiders count bookings with a session, normal users all."""
    booked = F.when(session, F.col("stage1_session")).otherwise(F.col("stage1"))
    return F.try_divide(booked.cast("double"), F.col("stage0").cast("double"))


def funnel(counts: DataFrame, by: Sequence[str] = (), session_filter: str = "numerator") -> DataFrame:
    """Both conversion rates per spider tag and in total."""
    rows = by_tag_with_total(counts, by)
    return rows.select(*by, "spider_tag", conversion(rows, 2, session_filter).alias("select_to_info"),
                       conversion(rows, 3, session_filter).alias("info_to_pay"))


def flight_conversion(counts: DataFrame, by: Sequence[str] = (), session_filter: str = "numerator") -> DataFrame:
    """Both conversion rates per flight type; a known misspelling of the international type is read as it."""
    fixed = counts.withColumn("flight_type", F.when(F.col("flight_type") == "Internatinal", "International")
                              .otherwise(F.col("flight_type")))
    rows = fold(fixed, [*by, "flight_type"])
    return rows.select(*by, "flight_type", conversion(rows, 2, session_filter).alias("select_to_info"),
                       conversion(rows, 3, session_filter).alias("info_to_pay"))


def spider_trips(requests: DataFrame, spiders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Spider requests with a session per flight type and travel type."""
    counts = stage_counts(requests, spiders, [*by, "flight_type", "travel_type"], how="inner")
    session = F.col("stage0_session") + F.col("stage1_session") + F.col("stage2_session") + F.col("stage3_session")
    return (counts.where("spider_tag = '1'").groupBy(*by, "flight_type", "travel_type")
            .agg(F.sum(session).cast("long").alias("n")).where("n > 0"))


def query_book(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Query-to-book ratio per spider tag."""
    rows = fold(counts, [*by, "spider_tag"])
    return rows.select(*by, "spider_tag", query_book_ratio(F.col("spider_tag") == "1").alias("query_book_ratio"))


def volumes(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests per spider tag and in total."""
    return by_tag_with_total(counts, by).select(*by, "spider_tag", "requests")
