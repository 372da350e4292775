"""Report queries over result tables: range filters, day series, ranking and paging."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blank(value: str | None) -> bool:
    return value is None or value.strip() == "" or value.lower() == "null"


def _bound(df: DataFrame, column: str, text: str, days: int = 0) -> Column:
    """A bound in the column's own type, so that the comparison reaches the scan."""
    at = datetime.fromisoformat(text) + timedelta(days=days)
    return F.lit(at.isoformat(sep=" ")).cast(df.schema[column].dataType)


def date_range(df: DataFrame, start: str | None = None, end: str | None = None, column: str = "record_time",
               by_day: bool = False) -> DataFrame:
    """Rows between two bounds, both included; a blank bound is open. ``by_day`` takes in the whole end day."""
    if not _blank(start):
        df = df.where(F.col(column) >= _bound(df, column, start[:10] if by_day else start))
    if not _blank(end):
        if by_day:
            df = df.where(F.col(column) < _bound(df, column, end[:10], 1))
        else:
            df = df.where(F.col(column) <= _bound(df, column, end))
    return df


def same_day(df: DataFrame, day: str | None, column: str = "record_time") -> DataFrame:
    return df if _blank(day) else date_range(df, day, day, column, by_day=True)


def report(df: DataFrame, start: str | None = None, end: str | None = None, order: Sequence[str] = ("record_time",),
           column: str = "record_time", **filters) -> DataFrame:
    """Rows of a report table in a date range that meet every given equality, in time order."""
    df = date_range(df, start, end, column)
    for name, value in filters.items():
        if value is not None and str(value).strip() != "":
            df = df.where(F.col(name) == value)
    return df.orderBy(*order)


def day_report(df: DataFrame, day: str | None, column: str = "record_time", **filters) -> DataFrame:
    """Rows of one day. Filters apply only together with a day; if either is blank all rows come back."""
    if _blank(day) or any(_blank(str(v)) for v in filters.values()):
        return df
    for name, value in filters.items():
        df = df.where(F.col(name) == value)
    return same_day(df, day, column)


def daily_series(df: DataFrame, start: str, end: str, type_col: str, value_col: str, types: Sequence,
                 order: str = "id", column: str = "record_time") -> DataFrame:
    """One row per day of the range and one column per type; the first value of a day counts, none gives null."""
    spark = df.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    firsts = (date_range(df, start, end, column, by_day=True)
              .withColumn("day", F.to_date(column))
              .groupBy("day").pivot(type_col, list(types)).agg(F.min_by(value_col, F.struct(column, order))))
    # One row per day on both sides: the calendar decides the size of this join, not the data.
    return days.join(firsts, "day", "left")


def ranking(df: DataFrame, by: str, ties: Sequence[str], start: str | None = None, end: str | None = None,
            column: str = "record_time") -> DataFrame:
    """Rows of a range from the highest value down."""
    return date_range(df, start, end, column).orderBy(F.col(by).desc(), *ties)


def page(df: DataFrame, order: Sequence[str | Column], number: int = 1, rows: int = 20) -> DataFrame:
    """One page of an ordered listing. The order must end in a unique column."""
    return df.orderBy(*order).offset((number - 1) * rows).limit(rows)


def page_count(df: DataFrame, rows: int = 20) -> DataFrame:
    """Number of rows and of pages."""
    return df.agg(F.count(F.lit(1)).alias("total")).withColumn(
        "pages", F.ceil(F.col("total") / F.lit(rows)).cast("long"))


def first_row(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def percent(value: Column) -> Column:
    return value * 100


def three_decimals(value: Column) -> Column:
    """Plain number text with three decimals, ``0`` when there is none."""
    return F.coalesce(F.replace(F.format_number(value, 3), F.lit(","), F.lit("")), F.lit("0"))


def route_frequencies(queries: DataFrame) -> DataFrame:
    """How often spiders asked for each route and day of departure."""
    return (queries.groupBy("depcity", "arrcity", "flight_date").agg(F.count(F.lit(1)).alias("grap_frequency")))


def spiders_found(found: DataFrame, day: str) -> DataFrame:
    """Spiders found on a day and in total."""
    return found.agg(
        F.sum(F.when(F.col("date") == F.lit(day).cast("date"), F.col("numspider"))).cast("long").alias("numspider"),
        F.sum("numspider").cast("long").alias("sumspider"))


def pipeline_health(snapshots: DataFrame) -> DataFrame:
    """``sign`` 0 when any snapshot is there, else 1. Reads no more than one row."""
    return snapshots.limit(1).agg((F.count(F.lit(1)) == 0).cast("int").alias("sign"))


# Data kinds of the rule form and the flags they stand for, named as in the table the readers load.
PARSE_KINDS = {
    "0": {"isJson": "true", "isApplicationJson": "true"},
    "1": {"isJson": "true", "isApplicationJson": "false"},
    "2": {"isXML": "true", "isTextXml": "true"},
    "3": {"isXML": "true", "isNormalForm": "true"},
    "4": {"isXML": "false", "isJson": "false", "isNormalForm": "true"},
    "5": {"isNormalGet": "true"},
}


def parse_rules_by_kind(rules: DataFrame, flight_type: int, behavior_type: int) -> DataFrame:
    """Every parse rule of a flight type and behavior once for each ``kind`` it is of, in one pass."""
    def is_kind(flags: dict[str, str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(name) == value for name, value in flags.items()])

    kinds = F.array_compact(F.array(*[F.when(is_kind(flags), F.lit(kind)) for kind, flags in PARSE_KINDS.items()]))
    mine = rules.where((F.col("flight_type") == flight_type) & (F.col("behavior_type") == behavior_type))
    return mine.withColumn("kind", F.explode(kinds))
