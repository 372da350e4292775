"""Masking of phone and identity numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.functions.codec import md5_upper

# What is masked, in this order.
PHONE = r"((13[0-9])|(14[5|7])|(15([0-3]|[5-9]))|(17[0-9])|(18[0,5-9]))\d{8}"
IDENTITY = r"(\d{18})|(\d{17}(\d|X|x))|(\d{15})"


def mask_text(text: Column, pattern: str) -> Column:
    """Replace every hit by its digest, everywhere in the text.

    Hits are found on the text as it came in and applied one after another.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.aggregate(hits, text, lambda acc, hit: F.replace(acc, hit, md5_upper(hit)))


def mask_pii(df: DataFrame, column: str = "value", patterns: Sequence[str] = (PHONE, IDENTITY)) -> DataFrame:
    """Run the masks one after another; a later mask sees the output of the earlier ones."""
    for pattern in patterns:
        df = df.withColumn(column, mask_text(F.col(column), pattern))
    return df
