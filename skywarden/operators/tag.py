"""Noise filter and request tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.functions.text import any_full_match, is_blank
from skywarden.operators.joins import sized_join
from skywarden.operators.parse import request_url
from skywarden.schema import BEHAVIOR_CODES, FLIGHT_CODES, ClassifyRule

# Fixed value: a date inside a referrer.
DATE_PATTERN = r"(\d{4})-(0\d{1}|1[0-2])-(0\d{1}|[12]\d{1}|3[01])"

# Funnel stage by URL.
STAGE_PATTERNS = {
    "1": ["^.*/bookingnew/.*$", "^.*/bookingGroup/.*$", "^.*/ita/intl/zh/shop/.*$"],
    "2": ["^.*/modules/permissionnew/.*$", "^.*/ita/intl/zh/passengers/.*$"],
    "3": ["^.*upp_payment/pay/.*$"],
}


def _keep_url(url: Column, patterns: Sequence[str]) -> Column:
    return ~url.rlike(r"\A\s*\z") & ~any_full_match(url, patterns)


def drop_noise(df: DataFrame, patterns: Sequence[str], column: str = "request") -> DataFrame:
    """Drop rows whose URL is blank or matches a noise rule."""
    return df.where(_keep_url(F.coalesce(F.col(column), F.lit("")), patterns))


def drop_noise_lines(df: DataFrame, patterns: Sequence[str], column: str = "value") -> DataFrame:
    """The same on raw lines, before anything else is parsed."""
    return df.where(_keep_url(request_url(F.col(column)), patterns))


def critical(patterns: Sequence[str], column: str = "request") -> Column:
    """Whether the URL is a critical page."""
    return any_full_match(F.col(column), patterns)


def tag_request_type(df: DataFrame, rules: Sequence[ClassifyRule], column: str = "request") -> DataFrame:
    """``flight_type`` and ``behavior_type`` by the first class with a matching rule.

    Classes are tried national before international, and query before booking inside each.
    """
    classes = [(f, b) for f in ("National", "International") for b in ("Query", "Book")]
    number = F.lit(len(classes))
    for i, (f, b) in reversed(list(enumerate(classes))):
        patterns = [r.expression for r in rules
                    if r.flight_type == FLIGHT_CODES[f] and r.operation_type == BEHAVIOR_CODES[b]]
        if patterns:
            number = F.when(any_full_match(F.col(column), patterns), F.lit(i)).otherwise(number)
    names = [*classes, ("Other", "Other")]
    found = F.col("_class") + 1
    both = F.struct(F.element_at(F.array(*[F.lit(f) for f, _ in names]), found).alias("flight_type"),
                    F.element_at(F.array(*[F.lit(b) for _, b in names]), found).alias("behavior_type"))
    # The names come out of a generator, so that filters on them read them instead of trying all patterns again.
    return (df.drop("flight_type", "behavior_type").withColumn("_class", number)
            .select("*", F.inline(F.array(both))).drop("_class"))


def travel_type(referrer: Column) -> Column:
    dates = F.regexp_count(referrer, F.lit(DATE_PATTERN))
    return F.when(dates == 1, "OneWay").when(dates == 2, "RoundTrip").otherwise("Unknown")


def tag_travel_type(df: DataFrame, column: str = "http_referrer") -> DataFrame:
    return df.withColumn("travel_type", travel_type(F.col(column)))


def flag_known_ip(df: DataFrame, blacklist: DataFrame, column: str = "remote_addr",
                  spread: Sequence[str] = ()) -> DataFrame:
    """``high_freq_ip``: the address is on the list. ``spread`` names columns that split a hot address."""
    listed = blacklist.select(F.col(blacklist.columns[0]).alias(column)).distinct().withColumn("_hit", F.lit(True))
    joined = sized_join(df, listed, [column], "left", spread=spread)
    return joined.withColumn("high_freq_ip", F.col("_hit").isNotNull()).drop("_hit")


def stage_tag(url: Column) -> Column:
    """Funnel stage of a URL: 1 booking, 2 passenger data, 3 payment, 0 the rest."""
    out = F.lit("0")
    for stage in sorted(STAGE_PATTERNS, reverse=True):
        out = F.when(any_full_match(url, STAGE_PATTERNS[stage]), F.lit(stage)).otherwise(out)
    return out


def spider_tag(flow_id: Column) -> Column:
    """``1`` when a flow id is present, ``0`` when it is null or the word null."""
    return F.when(flow_id.isNull() | (F.lower(flow_id) == "null"), F.lit("0")).otherwise(F.lit("1"))


def with_known_session(df: DataFrame, column: str = "jsessionid") -> DataFrame:
    return df.where(~F.col(column).contains("NULL"))


def search(df: DataFrame, columns: Sequence[str], term: str | None) -> DataFrame:
    """Rows in which one of the columns contains the term; a blank term keeps all."""
    if term is None or term.strip() == "" or term.lower() == "null":
        return df
    cond = F.lit(False)
    for name in columns:
        cond = cond | F.col(name).contains(term)
    return df.where(cond)


def optional_equal(df: DataFrame, column: str, value: str | int | None) -> DataFrame:
    return df if value is None or str(value).strip() == "" else df.where(F.col(column) == value)


__all__ = [
    "DATE_PATTERN", "STAGE_PATTERNS", "critical", "drop_noise", "drop_noise_lines", "flag_known_ip", "is_blank",
    "optional_equal", "search", "spider_tag", "stage_tag", "tag_request_type", "tag_travel_type", "travel_type",
    "with_known_session",
]
