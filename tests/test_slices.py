"""Metrics merged from time slices equal those computed from the requests."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skywarden.operators.metrics import METRICS, metric_vectors
from skywarden.operators.slices import partials, rolled, seconds_of, slice_states, vectors_of
from skywarden.operators.tag import critical
from skywarden.plans import rules
from tests.test_metrics import COLUMNS, sample

FIELDS = ["window_start", "remote_addr", "request", "requests", "last_seen", *METRICS.values()]


def rows_of(df):
    return sorted(df.select(*FIELDS).collect())


@pytest.mark.parametrize("threshold", [0, 5000])
def test_slices_and_what_they_roll_up_to(spark, threshold):
    # Two days of requests, with an address that is there all the time and many that come once.
    rows, df = sample(spark, 900, 5, 2 * 86_400_000)
    df = df.withColumn("http_user_agent", F.when(F.rand(3) > 0.1, F.col("http_user_agent"))).withColumn(
        "depcity", F.when(F.rand(4) > 0.1, F.col("depcity"))).cache()
    pages = critical(rules.CRITICAL)
    parts = partials(slice_states(df, "5 minutes"), pages, threshold)
    assert rows_of(vectors_of(parts)) == rows_of(metric_vectors(df, pages, "5 minutes", threshold_ms=threshold))
    hours = rolled(parts, "1 hour", threshold)
    assert rows_of(vectors_of(hours)) == rows_of(metric_vectors(df, pages, "1 hour", threshold_ms=threshold))
    for finer in (hours, parts):
        days = rolled(finer, "1 day", threshold)
        assert rows_of(vectors_of(days)) == rows_of(metric_vectors(df, pages, "1 day", threshold_ms=threshold))


def test_one_state_row_per_slice_address_and_url(spark):
    _, df = sample(spark, 600)
    states = slice_states(df, "5 minutes")
    keys = df.select(F.window("event_time", "5 minutes"), "remote_addr", "request").distinct().count()
    assert states.count() == keys < 600 / 3


def test_gap_across_a_quiet_slice(spark):
    """The slice between the two critical ones has requests, but none of them critical."""
    at = [0, 299_000, 310_000, 601_000]
    rows = [(i, ms, "10.0.0.1", "/static" if ms == 310_000 else "/a/query.ao", "UA", "A", "B", "S") for i, ms in enumerate(at)]
    df = spark.createDataFrame(rows, COLUMNS.replace("event_time timestamp", "ms long")).withColumn(
        "event_time", F.timestamp_millis("ms"))
    parts = rolled(partials(slice_states(df, "5 minutes"), critical(rules.CRITICAL)), "1 hour")
    assert parts.addresses.first().min_gap_ms == 299_000
    got = {r.request: (r.ip_count, r.critical_count, r.min_gap_ms) for r in vectors_of(parts).collect()}
    assert got == {"/static": (4, 3, 299_000), "/a/query.ao": (4, 3, 299_000)}


def test_lengths():
    assert [seconds_of(x) for x in ("5 minutes", "1 hour", "1 day", "30 seconds")] == [300, 3600, 86_400, 30]
    with pytest.raises(ValueError):
        seconds_of("1 month")
