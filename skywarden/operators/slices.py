"""Behaviour metrics from partial results of short time slices, which merge into longer windows.

A slice state is what the requests of one address and URL in a slice come to: how many, when, and which agents,
itineraries and sessions. It takes part in streams as the only state, one row per slice, address and URL. A finished
slice falls apart into three tables of mergeable partial results: addresses (counts, smallest gap, first and last
time), URLs (counts, short gaps, first and last time) and facts (distinct values, one a row, so that a hot address
spreads over many tasks). Windows of any multiple of the slice are merged from these, not from requests, and all eight
metrics come out of them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywarden.functions.text import ip_block
from skywarden.operators.metrics import GAP_LIMIT_MS, MAX_INT, METRICS

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def seconds_of(length: str) -> int:
    """Seconds of a window length such as ``5 minutes`` or ``1 day``."""
    found = re.fullmatch(r"(\d+) (second|minute|hour|day)s?", length)
    if not found:
        raise ValueError(f"not a number of seconds, minutes, hours or days: {length}")
    return int(found[1]) * _SECONDS[found[2]]


def slice_states(df: DataFrame, length: str) -> DataFrame:
    """``window_start, window_end, remote_addr, request`` and their requests collapsed to one row.

    Works on streams: with a watermark each row is emitted once, when its slice is complete. Rows combine on the map
    side, so what is shuffled of a hot address is one row per task, URL and slice. ``times`` holds distinct
    milliseconds, so its length is bounded by that of the slice.
    """
    return (df.groupBy(F.window("event_time", length).alias("window"), "remote_addr", "request").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.unix_millis("event_time")).alias("seen_ms"),
        F.collect_set(F.unix_millis("event_time")).alias("times"), F.collect_set("http_user_agent").alias("agents"),
        F.collect_set(F.concat("depcity", F.lit("->"), "arrcity")).alias("trips"),
        F.collect_set("jsessionid").alias("sessions"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "remote_addr",
                "request", "n", "seen_ms", "times", "agents", "trips", "sessions"))


@dataclass
class Partials:
    """Partial results of windows of one length; each has ``window_start`` and ``remote_addr``.

    ``addresses``: ``n, n_critical, first_ms, last_ms, min_gap_ms``; ``urls``: ``request, n, seen_ms, first_ms, last_ms,
    short_gaps``; ``facts``: ``kind, value``, distinct.
    """

    addresses: DataFrame
    urls: DataFrame
    facts: DataFrame

    def map(self, change) -> Partials:
        """The same with each table changed by ``change(name, table)``."""
        return Partials(*[change(name, getattr(self, name)) for name in ("addresses", "urls", "facts")])


def partials(states: DataFrame, critical: Column, threshold_ms: int = GAP_LIMIT_MS) -> Partials:
    """Partial results of slice states. Times and sessions count on critical pages only."""
    keys = ["window_start", "remote_addr"]
    marked = states.withColumn("_critical", F.coalesce(critical, F.lit(False)))
    ordered = F.array_sort("times")
    size = F.size("times")
    gaps = F.when(size > 1, F.zip_with(F.slice(ordered, F.lit(2), size - 1), F.slice(ordered, F.lit(1), size - 1),
                                       lambda later, before: later - before)).otherwise(F.array().cast("array<bigint>"))
    # Requests within the same millisecond are gaps of zero.
    same = F.col("n") - size if threshold_ms > 0 else F.lit(0)
    short = F.size(F.filter(gaps, lambda gap: gap < threshold_ms)) + same
    urls = marked.select(
        *keys, "request", "n", "seen_ms", F.when(F.col("_critical"), F.array_min("times")).alias("first_ms"),
        F.when(F.col("_critical"), F.array_max("times")).alias("last_ms"),
        F.when(F.col("_critical"), short).otherwise(0).cast("long").alias("short_gaps"))

    counts = marked.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("_critical"), F.col("n")).otherwise(0)).alias("n_critical"),
        F.max(F.col("_critical") & (F.col("n") > size)).alias("_same"))
    # The times of an address over all its URLs: a bounded number in a slice.
    per_ms = marked.where("_critical").select(*keys, F.explode("times").alias("ms")).groupBy(*keys, "ms").agg(
        F.count(F.lit(1)).alias("_urls"))
    gap = F.col("ms") - F.lag("ms").over(Window.partitionBy(*keys).orderBy("ms"))
    spans = per_ms.withColumn("_gap", F.when(F.col("_urls") > 1, F.lit(0).cast("long")).otherwise(gap)).groupBy(*keys).agg(
        F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"), F.min("_gap").alias("_gap"))
    addresses = counts.join(spans, keys, "left").select(
        *keys, "n", "n_critical", "first_ms", "last_ms",
        F.when(F.col("_same"), F.lit(0).cast("long")).otherwise(F.col("_gap")).alias("min_gap_ms"))

    def of(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    none = F.array().cast("array<string>")
    facts = marked.select(*keys, F.explode(F.concat(
        of("agent", F.col("agents")), of("trip", F.col("trips")),
        of("session", F.when(F.col("_critical"), F.col("sessions")).otherwise(none)))).alias("f")).select(
        *keys, "f.kind", "f.value").distinct()
    return Partials(addresses, urls, facts)


def rolled(finer: Partials, length: str, threshold_ms: int = GAP_LIMIT_MS) -> Partials:
    """Partial results of windows of ``length``, a multiple of the finer windows, out of theirs.

    Gaps across the border of two finer windows come from their last and first times: a window over as many rows as
    there are finer windows in one.
    """
    start = F.window("window_start", length)["start"]

    def bordered(df: DataFrame, keys: list[str]) -> DataFrame:
        order = Window.partitionBy("_window", *keys).orderBy("window_start")
        # A finer window without critical pages has no times; the one before it counts then.
        before = F.last("last_ms", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
        return df.withColumn("_window", start).withColumn("_border", F.col("first_ms") - before)

    addresses = bordered(finer.addresses, ["remote_addr"]).groupBy(
        F.col("_window").alias("window_start"), "remote_addr").agg(
        F.sum("n").alias("n"), F.sum("n_critical").alias("n_critical"), F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"), F.least(F.min("min_gap_ms"), F.min("_border")).alias("min_gap_ms"))
    crossing = F.when(F.col("_border") < threshold_ms, 1).otherwise(0)
    urls = bordered(finer.urls, ["remote_addr", "request"]).groupBy(
        F.col("_window").alias("window_start"), "remote_addr", "request").agg(
        F.sum("n").alias("n"), F.max("seen_ms").alias("seen_ms"), F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"), F.sum(F.col("short_gaps") + crossing).cast("long").alias("short_gaps"))
    facts = finer.facts.select(start.alias("window_start"), "remote_addr", "kind", "value").distinct()
    return Partials(addresses, urls, facts)


def vectors_of(parts: Partials) -> DataFrame:
    """One row per window, address and URL with all eight metrics: what ``metric_vectors`` gives from requests."""
    keys = ["window_start", "remote_addr"]

    def distinct(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    values = parts.facts.groupBy(*keys).agg(distinct("agent").alias("ua_count"), distinct("trip").alias("trip_count"),
                                            distinct("session").alias("session_count"))
    # A block has a bounded number of addresses, and its requests are the sum of theirs.
    of_block = Window.partitionBy("window_start", "ip_block")
    per_ip = (parts.addresses.join(values, keys, "left").withColumn("ip_block", ip_block(F.col("remote_addr")))
              .withColumn("ip_block_count", F.sum("n").over(of_block))
              .select(*keys, "ip_block", "ip_block_count", F.col("n").alias("ip_count"),
                      F.col("n_critical").alias("critical_count"), "ua_count", "trip_count", "session_count", "min_gap_ms"))
    urls = parts.urls.select(*keys, "request", F.col("n").alias("requests"),
                             F.timestamp_millis("seen_ms").alias("last_seen"), "short_gaps")
    zero = [c for c in METRICS.values() if c != "min_gap_ms"]
    # An address with very many URLs makes a skewed partition of one side, which adaptive execution splits.
    return urls.join(per_ip, keys, "left").fillna(0, zero).fillna(MAX_INT, ["min_gap_ms"])
