"""String, list and map helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what an absent cookie or an empty slot is written as.
NULL_TEXT = "NULL"


def full_match(value: Column, pattern: str) -> Column:
    """Whole-string regex match."""
    return value.rlike(rf"\A(?:{pattern})\z")


def any_of(conditions: Sequence[Column]) -> Column:
    """OR over any number of conditions, built as a balanced tree so that long rule lists stay shallow."""
    if not conditions:
        return F.lit(False)
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return any_of(conditions[:half]) | any_of(conditions[half:])


def any_full_match(value: Column, patterns: Sequence[str]) -> Column:
    """True when at least one pattern matches the whole string; null input gives false."""
    return F.coalesce(any_of([full_match(value, p) for p in patterns]), F.lit(False))


def is_blank(value: Column) -> Column:
    """Null, empty, white space only, or the word ``null`` in any case."""
    return value.isNull() | value.rlike(r"\A[\x00-\x20]*\z") | (F.lower(value) == "null")


def or_null_text(value: Column) -> Column:
    """Empty or missing text becomes ``NULL``."""
    return F.when(value.isNull() | (value == ""), F.lit(NULL_TEXT)).otherwise(value)


def key_values(text: Column, separator: str) -> Column:
    """``k=v`` tokens as ``array<struct<k,v>>`` in text order.

    The value ends at a second ``=``; tokens without a value are left out.
    """
    tokens = F.filter(F.split(text, separator), lambda t: t.rlike("=+[^=]"))
    return F.transform(
        tokens,
        lambda t: F.struct(
            F.substring_index(t, "=", 1).alias("k"),
            F.get(F.split(t, "="), F.lit(1)).alias("v"),
        ),
    )


def last_value(pairs: Column, key: str) -> Column:
    """Value of the last pair with this key, null when there is none. One linear pass, no map needed."""
    return F.try_element_at(F.filter(pairs, lambda p: p["k"] == key), F.lit(-1))["v"]


def last_wins_map(pairs: Column) -> Column:
    """Pairs to a map in which the last pair of a key wins."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    values = F.transform(
        keys, lambda k: F.try_element_at(F.filter(pairs, lambda p: p["k"] == k), F.lit(-1))["v"])
    return F.map_from_arrays(keys, values)


def drop_empty(items: Column) -> Column:
    """List without nulls and empty strings."""
    return F.filter(items, lambda x: x.isNotNull() & (x != ""))


def distinct_items(items: Column) -> Column:
    """List without nulls and repeats, first occurrence order."""
    return F.array_distinct(F.filter(items, lambda x: x.isNotNull()))


def comma_list(value: Column) -> Column:
    """Comma-separated text to a list; null gives an empty list."""
    return F.coalesce(F.split(value, ","), F.array().cast("array<string>"))


def map_get(mapping: Column, key: Column | str, default) -> Column:
    """Map lookup with a default."""
    k = key if isinstance(key, Column) else F.lit(key)
    return F.coalesce(F.try_element_at(mapping, k), F.lit(default))


def ip_block(address: Column) -> Column:
    """First two octets of a four-part address, otherwise empty."""
    # A dotted address with trailing dots still counts its non-empty parts only.
    parts = F.split(F.rtrim(address, F.lit(".")), r"\.")
    return F.when(F.size(parts) == 4, F.substring_index(address, ".", 2)).otherwise(F.lit(""))


def usage_percent(free: Column, total: Column, whole: bool = False) -> Column:
    """Percentage rounded half up to one decimal; ``whole`` truncates to a whole percent first."""
    ratio = F.try_divide(free * F.lit(100.0), total.cast("double"))
    return F.round(F.floor(ratio).cast("double") if whole else ratio, 1)
