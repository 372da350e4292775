"""Processed records to and from their one-line form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywarden.functions.text import or_null_text
from skywarden.functions.times import iso_timestamp
from skywarden.schema import LINE_SLOTS, QUERY_SCHEMA, SEPARATOR


def to_line(df: DataFrame, into: str = "value") -> DataFrame:
    """Add the 19-slot line; empty slots are written as ``NULL``."""
    derived = {
        "query_json": F.to_json("query_data") if "query_data" in df.columns else F.lit(None).cast("string"),
        "book_json": F.to_json("book_data") if "book_data" in df.columns else F.lit(None).cast("string"),
        "high_freq_ip": F.coalesce(F.col("high_freq_ip"), F.lit(False)).cast("string"),
    }
    slots = []
    for name in LINE_SLOTS:
        if name in derived:
            value = derived[name]
        elif name in df.columns:
            value = F.col(name).cast("string")
        else:
            value = F.lit("")
        slots.append(or_null_text(value))
    return df.withColumn(into, F.concat_ws(SEPARATOR, *slots))


def from_line(df: DataFrame, column: str = "value") -> DataFrame:
    """Processed lines back to typed columns; source text and booking record are not carried over."""
    parts = F.split(F.col(column), SEPARATOR)
    names = [n for n in LINE_SLOTS if n not in ("source_data", "query_json", "book_json")]
    cols = {n: F.get(parts, F.lit(LINE_SLOTS.index(n))) for n in names}
    cols["high_freq_ip"] = F.lower(cols["high_freq_ip"]) == "true"
    query = F.get(parts, F.lit(LINE_SLOTS.index("query_json")))
    cols["query_data"] = F.from_json(F.when(F.lower(query) != "null", query), QUERY_SCHEMA)
    cols["event_time"] = iso_timestamp(F.get(parts, F.lit(LINE_SLOTS.index("time_iso8601"))))
    return df.withColumns(cols).drop(column)
