"""The plans are the ones meant: few scans, pruned columns, pushed filters, no joins of all pairs."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skywarden.operators import funnel as fn
from skywarden.operators import joins
from skywarden.operators import reports as rp
from skywarden.operators.metrics import gap_stats, metric_vectors
from skywarden.operators.tag import critical
from skywarden.plans import adapter, rules
from skywarden.plans.etl import Site, processed_lines
from skywarden.session import work_dir
from skywarden.sources.writers import of_behavior

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored_requests(spark):
    path = work_dir(spark, "requests")
    adapter.requests(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_vectors_read_the_input_twice(spark):
    """One pass for the address, one for address and URL; distinct counts need no repeated rows per count."""
    text = plan(metric_vectors(stored_requests(spark), critical(rules.CRITICAL), "1 day"))
    assert text.count("FileScan parquet") == 2
    for bad in ("Cartesian", "NestedLoop", "SinglePartition", "collect_", "Expand"):
        assert bad not in text


def test_no_window_runs_over_a_bare_address(spark):
    """Request times are ordered inside time slices; across slices only their summary rows are."""
    text = plan(gap_stats(stored_requests(spark), ["remote_addr"], window="1 day"))
    specs = [line for line in text.splitlines() if "Window [lag(_ms" in line]
    assert len(specs) == 1 and "_slice" in specs[0].split("windowspecdefinition(")[1].split(" ASC")[0]


def test_funnel_is_one_pass(spark):
    spiders = spark.createDataFrame([("a", "F")], "remote_addr string, flow_id string")
    reqs = stored_requests(spark)
    text = plan(fn.funnel(fn.stage_counts(reqs, spiders, ["flight_type"])))
    assert text.count("FileScan parquet") == 1
    assert "ReadSchema: struct<remote_addr:string,request:string,jsessionid:string,flight_type:string>" in text


def test_date_bounds_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate")
    for df in (rp.date_range(orders, "1996-01-01", "1996-12-31", "o_orderdate"), rp.same_day(orders, "1996-01-01", "o_orderdate"),
               rp.date_range(orders, "1996-01-01", "1996-12-31", "o_orderdate", by_day=True)):
        pushed = plan(df).split("PushedFilters:")[1].split("ReadSchema")[0]
        assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan" in pushed


def test_tags_are_tried_once(spark):
    lines = adapter.raw_lines(spark, SF)
    text = plan(of_behavior(processed_lines(lines, Site()), 0))
    assert text.count("passengers/.*$)\\z") <= text.count("Generate inline") * 2


def test_ranking_takes_the_top_only(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert "TakeOrderedAndProject" in plan(rp.page(orders, [F.col("o_totalprice").desc(), "o_orderkey"], 2, 10))


def test_lookup_is_broadcast_only_when_small(spark):
    big = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    small = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    assert "BroadcastHashJoin" in plan(joins.sized_join(big, small, ["l_orderkey"], "left", ["l_linenumber"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.sized_join(big, small, ["l_orderkey"], "left", ["l_linenumber"], max_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "_salt" in text
