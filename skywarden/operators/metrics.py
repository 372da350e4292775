"""Behaviour metrics per address, address block and address with URL.

Every aggregate first collapses rows on the map side and only ever groups by keys that split a hot address:
distinct counts group by address and value, gaps by address and time slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywarden.functions.text import ip_block
from skywarden.operators.joins import salted_join, skew_join

# Fixed value: gaps below this count as too fast.
GAP_LIMIT_MS = 5000
# Fixed value: what a missing smallest gap is read as.
MAX_INT = 2147483647
# Length of the time slices gaps are computed in: at most 300,000 distinct milliseconds per slice.
SLICE_MS = 300_000
# Parts an address is split into, by URL, when its metrics are joined to its URLs.
URL_SALTS = 8

METRICS = {
    "ipBlock": "ip_block_count", "ip": "ip_count", "criticalPages": "critical_count", "userAgent": "ua_count",
    "criticalPagesAccTime": "min_gap_ms", "criticalPagesLessThanDefault": "short_gaps",
    "flightQuery": "trip_count", "criticalCookies": "session_count",
}


def _with_window(df: DataFrame, window: str | None, slide: str | None = None, time: str = "event_time") -> DataFrame:
    if window is None:
        return df
    if "window_start" in df.columns:
        return df
    return df.withColumn("window_start", F.window(F.col(time), window, slide)["start"])


def _keys(window: str | None, keys: Sequence[str]) -> list[str]:
    return [*(["window_start"] if window else []), *keys]


def _rows(weight: str | None) -> Column:
    return F.sum(F.col(weight)) if weight else F.count(F.lit(1))


def ip_counts(df: DataFrame, critical: Column, window: str | None = None, slide: str | None = None,
              weight: str | None = None) -> DataFrame:
    """Requests, critical requests, distinct agents, itineraries and critical-page sessions per address."""
    w = F.col(weight) if weight else F.lit(1)
    src = _with_window(df, window, slide).withColumn("_critical", critical)
    return src.groupBy(*_keys(window, ["remote_addr"])).agg(
        _rows(weight).cast("long").alias("ip_count"),
        F.sum(F.when(F.col("_critical"), w).otherwise(0)).cast("long").alias("critical_count"),
        F.countDistinct("http_user_agent").alias("ua_count"),
        F.countDistinct(F.concat("depcity", F.lit("->"), "arrcity")).alias("trip_count"),
        F.countDistinct(F.when(F.col("_critical"), F.col("jsessionid"))).alias("session_count"),
    )


def block_metrics(df: DataFrame, window: str | None = None, slide: str | None = None,
                  weight: str | None = None) -> DataFrame:
    """Requests per address block."""
    src = _with_window(df, window, slide).withColumn("ip_block", ip_block(F.col("remote_addr")))
    return src.groupBy(*_keys(window, ["ip_block"])).agg(_rows(weight).cast("long").alias("ip_block_count"))


def gap_stats(df: DataFrame, keys: Sequence[str], threshold_ms: int = GAP_LIMIT_MS, window: str | None = None,
              slide: str | None = None, weight: str | None = None, slice_ms: int = SLICE_MS) -> DataFrame:
    """Smallest gap between consecutive requests and number of gaps below the threshold, per key.

    Rows collapse to distinct milliseconds, gaps are taken inside fixed time slices, and the gaps across slice
    borders come from one summary row per slice. No step needs all the rows of a key in one task.
    """
    group = _keys(window, keys)
    timed = df if "_ms" in df.columns else df.withColumn("_ms", F.unix_millis("event_time"))
    per_ms = (_with_window(timed, window, slide)
              .groupBy(*group, "_ms").agg(_rows(weight).alias("_n")))
    sliced = per_ms.withColumn("_slice", F.floor(F.col("_ms") / slice_ms))
    inside = Window.partitionBy(*group, "_slice").orderBy("_ms")
    gap = F.col("_ms") - F.lag("_ms").over(inside)
    # Requests within the same millisecond are gaps of zero.
    same = F.col("_n") - 1
    slices = (sliced.withColumn("_gap", gap)
              .groupBy(*group, "_slice").agg(
                  F.min("_ms").alias("_first"), F.max("_ms").alias("_last"),
                  F.min(F.when(same > 0, F.lit(0).cast("long")).otherwise(F.col("_gap"))).alias("_min_gap"),
                  (F.coalesce(F.sum(F.when(F.lit(threshold_ms > 0), same).otherwise(0)), F.lit(0))
                   + F.count_if(F.col("_gap") < threshold_ms)).alias("_short")))
    across = Window.partitionBy(*group).orderBy("_slice")
    border = F.col("_first") - F.lag("_last").over(across)
    return (slices.withColumn("_border", border)
            .groupBy(*group).agg(
                F.least(F.min("_min_gap"), F.min("_border")).alias("min_gap_ms"),
                F.sum(F.col("_short") + F.when(F.col("_border") < threshold_ms, 1).otherwise(0))
                .cast("long").alias("short_gaps")))


def with_previous_time(df: DataFrame, keys: Sequence[str], time: str = "event_time",
                       slice_ms: int = SLICE_MS) -> DataFrame:
    """Add ``previous_ms`` and ``gap_ms``: distance to the row before it within the key, in time order.

    The predecessor is looked up among the distinct milliseconds of the key, slice by slice. Rows that share a
    millisecond share one predecessor: the first gets the gap to it, the rest zero.
    """
    base = df.withColumn("_ms", F.unix_millis(time))
    times = base.groupBy(*keys, "_ms").agg(F.count(F.lit(1)).alias("_n")).withColumn("_slice", F.floor(F.col("_ms") / slice_ms))
    local = times.withColumn("_before", F.lag("_ms").over(Window.partitionBy(*keys, "_slice").orderBy("_ms")))
    borders = (times.groupBy(*keys, "_slice").agg(F.max("_ms").alias("_last"))
               .withColumn("_prev_last", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice")))
               .select(*keys, "_slice", "_prev_last"))
    before = local.join(borders, [*keys, "_slice"], "left").select(
        *keys, "_ms", F.coalesce("_before", "_prev_last").alias("_before"))
    # Of the rows within a millisecond, which are few, the first has the time before it, the others have their own.
    ties = [F.col(c) for c in ("event_id",) if c in df.columns] or [F.lit(1)]
    place = F.row_number().over(Window.partitionBy(*keys, "_ms").orderBy(*ties))
    return (base.join(before, [*keys, "_ms"], "left").withColumn("_place", place)
            .withColumn("previous_ms", F.when(F.col("_place") == 1, F.col("_before")).otherwise(F.col("_ms")))
            .withColumn("gap_ms", F.col("_ms") - F.col("previous_ms"))
            .drop("_ms", "_before", "_place"))


def url_gap_counts(df: DataFrame, critical: Column, threshold_ms: int = GAP_LIMIT_MS, window: str | None = None,
                   slide: str | None = None, weight: str | None = None) -> DataFrame:
    """Gaps below the threshold per address and critical URL."""
    return (gap_stats(df.where(critical), ["remote_addr", "request"], threshold_ms, window, slide, weight)
            .drop("min_gap_ms"))


def ip_min_gap(df: DataFrame, critical: Column, window: str | None = None, slide: str | None = None,
               weight: str | None = None) -> DataFrame:
    """Smallest gap between critical requests per address; null with a single one."""
    return gap_stats(df.where(critical), ["remote_addr"], GAP_LIMIT_MS, window, slide, weight).drop("short_gaps")


def ip_metrics(df: DataFrame, critical: Column, window: str | None = None, slide: str | None = None,
               weight: str | None = None, slice_ms: int = SLICE_MS) -> DataFrame:
    """All per-address metrics in one frame, from one pass over the input.

    A request unfolds to the facts it adds to: itself, its agent, itinerary and session, and the millisecond of a
    critical page. Equal facts collapse on the map side; what is left is counted, and measured for gaps, in parts that
    split an address by time slice or by a hash of the value.
    """
    keys = _keys(window, ["remote_addr"])
    w = F.col(weight) if weight else F.lit(1)
    src = _with_window(df, window, slide).withColumns({"_critical": critical, "_w": w.cast("long")})
    ms = F.unix_millis("event_time")

    def fact(kind: str, when: Column | None = None, value: Column | None = None, at: Column | None = None) -> Column:
        made = F.struct(F.lit(kind).alias("kind"), (value if value is not None else F.lit(None)).cast("string").alias("value"),
                        (at if at is not None else F.lit(None)).cast("long").alias("ms"))
        return made if when is None else F.when(when, made)

    trip = F.concat("depcity", F.lit("->"), "arrcity")
    facts = F.array_compact(F.array(
        fact("other", ~F.coalesce("_critical", F.lit(False))), fact("page", F.col("_critical")),
        fact("agent", F.col("http_user_agent").isNotNull(), F.col("http_user_agent")), fact("trip", trip.isNotNull(), trip),
        fact("session", F.col("_critical") & F.col("jsessionid").isNotNull(), F.col("jsessionid")),
        fact("time", F.col("_critical"), at=ms)))
    per_fact = (src.select(*keys, "_w", F.explode(facts).alias("_f")).select(*keys, "_w", "_f.*")
                .groupBy(*keys, "kind", "value", "ms").agg(F.sum("_w").alias("_n")))
    part = F.coalesce(F.floor(F.col("ms") / slice_ms), F.pmod(F.xxhash64("value"), F.lit(64)))
    sliced = per_fact.withColumn("_slice", part)
    gap = F.col("ms") - F.lag("ms").over(Window.partitionBy(*keys, "kind", "_slice").orderBy("ms"))
    slices = sliced.withColumn("_gap", gap).groupBy(*keys, "kind", "_slice").agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"), F.min("ms").alias("_first"),
        F.max("ms").alias("_last"),
        F.min(F.when(F.col("ms").isNotNull() & (F.col("_n") > 1), F.lit(0).cast("long")).otherwise(F.col("_gap"))).alias("_min"))
    border = F.col("_first") - F.lag("_last").over(Window.partitionBy(*keys, "kind").orderBy("_slice"))

    def total(column: str, *kinds: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col(column))), F.lit(0)).cast("long")

    return slices.withColumn("_border", border).groupBy(*keys).agg(
        total("_rows", "other", "page").alias("ip_count"), total("_rows", "page").alias("critical_count"),
        total("_values", "agent").alias("ua_count"), total("_values", "trip").alias("trip_count"),
        total("_values", "session").alias("session_count"),
        F.min(F.when(F.col("kind") == "time", F.least("_min", "_border"))).alias("min_gap_ms"))


def url_profile(df: DataFrame, critical: Column, threshold_ms: int = GAP_LIMIT_MS, window: str | None = None,
                slide: str | None = None, weight: str | None = None, slice_ms: int = SLICE_MS) -> DataFrame:
    """Requests, time last seen and short gaps per address and URL, in one pass over the input.

    Only critical pages keep their milliseconds; the rest collapse to one row per time slice before the shuffle.
    """
    keys = _keys(window, ["remote_addr", "request"])
    real = F.unix_millis("event_time")
    marked = (_with_window(df, window, slide).withColumn("_critical", critical)
              .withColumns({"_real": real, "_ms": F.when(F.col("_critical"), real)
                            .otherwise(F.floor(real / slice_ms) * slice_ms)}))
    per_ms = marked.groupBy(*keys, "_critical", "_ms").agg(
        _rows(weight).alias("_n"), F.max("_real").alias("_seen")).withColumn("_slice", F.floor(F.col("_ms") / slice_ms))
    gap = F.col("_ms") - F.lag("_ms").over(Window.partitionBy(*keys, "_critical", "_slice").orderBy("_ms"))
    close = F.coalesce((F.col("_gap") < threshold_ms).cast("long"), F.lit(0))
    same = F.col("_n") - 1 if threshold_ms > 0 else F.lit(0)
    slices = per_ms.withColumn("_gap", gap).groupBy(*keys, "_critical", "_slice").agg(
        F.sum("_n").alias("_n"), F.max("_seen").alias("_seen"), F.min("_ms").alias("_first"),
        F.max("_ms").alias("_last"), F.sum(F.when(F.col("_critical"), close + same).otherwise(0)).alias("_short"))
    border = F.col("_first") - F.lag("_last").over(Window.partitionBy(*keys, "_critical").orderBy("_slice"))
    across = F.when(F.col("_critical") & (F.col("_border") < threshold_ms), 1).otherwise(0)
    return slices.withColumn("_border", border).groupBy(*keys).agg(
        F.sum("_n").cast("long").alias("requests"), F.timestamp_millis(F.max("_seen")).alias("last_seen"),
        F.sum(F.col("_short") + across).cast("long").alias("short_gaps"))


def metric_vectors(df: DataFrame, critical: Column, window: str | None = None, slide: str | None = None,
                   weight: str | None = None, threshold_ms: int = GAP_LIMIT_MS) -> DataFrame:
    """One row per address and URL with all eight metrics and the time it was last seen.

    Requests of one address and URL carry the same metrics, so they are collapsed before any join. What is joined
    are aggregates; an address with very many URLs is split over several tasks by URL.
    """
    src = _with_window(df, window, slide)
    by_ip = _keys(window, ["remote_addr"])
    # A block has a bounded number of addresses, and its requests are the sum of theirs.
    of_block = Window.partitionBy(*_keys(window, ["ip_block"]))
    per_ip = (ip_metrics(src, critical, window, weight=weight).withColumn("ip_block", ip_block(F.col("remote_addr")))
              .withColumn("ip_block_count", F.sum("ip_count").over(of_block)))
    vectors = salted_join(url_profile(src, critical, threshold_ms, window, weight=weight), per_ip, by_ip, "left",
                          ["request"], URL_SALTS)
    zero = [c for c in METRICS.values() if c != "min_gap_ms"]
    return vectors.fillna(0, zero).fillna(MAX_INT, ["min_gap_ms"])


def attach_metrics(df: DataFrame, vectors: DataFrame, window: str | None = None, slide: str | None = None,
                   spread: Sequence[str] = ("event_time", "http_user_agent", "jsessionid")) -> DataFrame:
    """Every request with its metrics; a hot address and URL is split over many tasks.

    ``vectors`` is read more than once, so it is best a stored table.
    """
    src = _with_window(df, window, slide)
    keys = _keys(window, ["remote_addr", "request"])
    lookup = vectors.drop(*[c for c in vectors.columns if c in src.columns and c not in keys])
    return skew_join(src, lookup.drop("requests"), keys, "left", [c for c in spread if c in src.columns],
                     sizes=vectors.select(*keys, "requests"), rows="requests")


def cells(df: DataFrame, window: str, critical: Column | None = None) -> DataFrame:
    """Requests collapsed to what the metrics can tell apart, with a row count ``n``.

    Works on streams: with a watermark each window is emitted once, when it is complete, and every metric
    function then runs on the cells with ``weight="n"``.
    """
    win = F.window("event_time", window)
    return (df.withColumn("_ms", F.unix_millis("event_time"))
            .groupBy(win.alias("window"), "remote_addr", "request", "http_user_agent", "depcity", "arrcity",
                     "jsessionid", "_ms")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").alias("window_start"), "remote_addr", "request", "http_user_agent",
                    "depcity", "arrcity", "jsessionid", F.timestamp_millis("_ms").alias("event_time"), "n"))


def key_counts(df: DataFrame, keys: Sequence[str], window: str | None = None, slide: str | None = None,
               into: str = "n") -> DataFrame:
    """Rows per key and window: bookings or payments by block, purchaser, contact, passenger and so on."""
    return (_with_window(df, window, slide).groupBy(*_keys(window, keys))
            .agg(F.count(F.lit(1)).alias(into)))


def without_follow_up(first: DataFrame, then: DataFrame, keys: Sequence[str], window: str | None = None,
                      slide: str | None = None) -> DataFrame:
    """Keys with a row in ``first`` and none in ``then`` in the same window, with their row count."""
    a = key_counts(first, keys, window, slide)
    b = key_counts(then, keys, window, slide).drop("n")
    return a.join(b, _keys(window, keys), "left_anti")
