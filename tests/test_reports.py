"""Monitoring, reports, readers, writers, keyed table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skywarden.functions import text, times
from skywarden.operators import monitor as mon
from skywarden.operators import reports as rp
from skywarden.operators.tag import search
from skywarden.plans.etl import Site, tagged_requests
from skywarden.session import work_dir
from skywarden.sources import keyed, readers, writers
from tests.test_records import SAMPLE


def line(server="s1", active="3", n=12):
    parts = ["NULL", "GET /a H", "GET", "", "", "", "ip", "ua", "t", server, "c", active]
    return "#CS#".join(parts[:n])


def test_server_figures(spark):
    lines = [(1, line()), (2, line(active="7")), (3, line("s2", "x")), (4, line("s3", "")), (5, line(n=9)), (6, line("s1", "bad"))]
    df = spark.createDataFrame(lines, "at int, value string")
    assert {r.server_addr: r.n for r in mon.server_counts(df).collect()} == {"s1": 3, "s2": 1, "s3": 1, "": 1}
    active = {r.server_addr: r.active_num for r in mon.active_connections(df, ["at"]).collect()}
    assert active == {"s1": 7, "s2": None, "": 1}
    snap = mon.link_snapshot(df.withColumn("g", F.lit(1)), ["at"], ["g"]).first()
    assert snap.value == '{"serversCountMap":{"":1,"s1":3,"s2":1,"s3":1},"activeNumMap":{"":1,"s1":7}}'


def test_throughput_quirks(spark):
    df = spark.createDataFrame([(0, 4, 10), (5, 5, 3)], "start_ms long, end_ms long, source_count long")
    assert [r.count_per_millis for r in mon.throughput(df).collect()] == [2.5, 0.0]
    assert [r.count_per_millis for r in mon.throughput(df, whole=True).collect()] == [2.0, 0.0]


def snaps(spark):
    rows = [("P1", "2024-01-01 10:00:00", "5", {"a": 1}), ("P2", "2024-01-01 10:40:00", "7", {"a": 2, "b": 1}),
            ("P3", "2024-01-02 00:00:00", "1", {})]
    return spark.createDataFrame(rows, "key string, end_time string, source_count string, servers_count_map map<string,int>"
                                 ).withColumns({"cost_time": F.lit("1"), "application_id": F.lit("x"),
                                                "count_per_millis": F.lit("1.0"), "application_unique_name": F.lit("n")})


def test_drain(spark):
    parent, child, stays = mon.drain(snaps(spark), "2024-01-01 11:00:00")
    assert [r.id for r in parent.collect()] == ["P1"]
    assert [(r.parent_id, r.ip_address, r.ip_value) for r in child.collect()] == [("P1", "a", 1.0)]
    assert sorted(r.key for r in stays.collect()) == ["P2", "P3"]
    # Repeating the move gives the same rows.
    assert parent.collect() == mon.drain(snaps(spark), "2024-01-01 11:00:00")[0].collect()


def test_snapshot_ranges(spark):
    keys = lambda df: sorted(r.key for r in df.collect())
    assert keys(mon.in_time_range(snaps(spark), "2024-01-01 10:00:00", "2024-01-02 00:00:00")) == ["P2"]
    assert keys(mon.in_time_range(snaps(spark), "", "null", today="2024-01-02")) == ["P1", "P2"]
    assert keys(mon.last_minutes(snaps(spark), 30, "2024-01-01 11:00:00")) == ["P2"]
    assert keys(mon.last_minutes(snaps(spark), 30, "2024-01-01 11:00:00", active=False)) == ["P1", "P2", "P3"]


def test_series_and_newest(spark):
    row = mon.forward_series(snaps(spark)).first()
    assert (row.value, row["sum"]) == (["5", "7", "1"], 13.0)
    assert mon.newest_snapshot(snaps(spark)).first().key == "P3"
    assert mon.newest_snapshot(snaps(spark).limit(0)).count() == 0
    assert {r.server_addr: r.n for r in mon.link_totals(snaps(spark)).collect()} == {"a": 3, "b": 1}
    assert mon.daily_flow(mon.drain(snaps(spark), "2025-01-01 00:00:00")[0], "2024-01-01").first().flow_num == 12.0


def test_rolling_totals_golden(spark):
    history = spark.createDataFrame([("s", 3, 5, 9), ("idle", 1, 2, 3)],
                                    "server_name string, before_yesterday_num int, yesterday_num int, last_three_days_num int")
    today = spark.createDataFrame([("s", 7), ("new", 4)], "server_addr string, n int")
    got = {r.server_name: (r.last_three_days_num, r.before_yesterday_num, r.yesterday_num)
           for r in mon.roll_server_totals(history, today).collect()}
    assert got == {"s": (15, 5, 7), "new": (4, 0, 4), "idle": (3, 1, 2)}


def test_pages_and_first(spark):
    df = spark.range(45).withColumn("v", F.col("id") % 3)
    rows = rp.page(df, [F.col("v").desc(), "id"], 3).collect()
    assert len(rows) == 5 and rows[0].v == 0
    assert rp.page_count(df).first() == (45, 3)
    assert rp.first_row(df, ["id"]).first().id == 0
    assert rp.page_count(df.limit(0)).first() == (0, 0)


def report_table(spark):
    rows = [(1, 0, 1.0, "2024-01-01 00:00:00"), (2, 0, 9.0, "2024-01-01 08:00:00"), (3, 1, 2.0, "2024-01-03 12:00:00")]
    return spark.createDataFrame(rows, "id int, kind int, value double, t string").select(
        "id", "kind", "value", F.col("t").cast("timestamp").alias("record_time"))


def test_date_ranges(spark):
    df = report_table(spark)
    ids = lambda x: sorted(r.id for r in x.collect())
    assert ids(rp.date_range(df, "2024-01-01", "2024-01-03")) == [1, 2]
    assert ids(rp.date_range(df, "2024-01-01", "2024-01-03", by_day=True)) == [1, 2, 3]
    assert ids(rp.date_range(df, "null", " ")) == [1, 2, 3]
    assert ids(rp.same_day(df, "2024-01-01")) == [1, 2]
    assert ids(rp.day_report(df, "2024-01-01", kind=0)) == [1, 2] and ids(rp.day_report(df, "", kind=0)) == [1, 2, 3]
    assert ids(rp.report(df, kind=1)) == [3] and ids(rp.report(df, kind="")) == [1, 2, 3]


def test_daily_series(spark):
    rows = rp.daily_series(report_table(spark), "2024-01-01", "2024-01-03", "kind", "value", [0, 1]).orderBy("day").collect()
    assert [(str(r.day), r["0"], r["1"]) for r in rows] == [
        ("2024-01-01", 1.0, None), ("2024-01-02", None, None), ("2024-01-03", None, 2.0)]


def test_health_and_speed(spark):
    assert rp.pipeline_health(spark.range(3)).first().sign == 0
    assert rp.pipeline_health(spark.range(0)).first().sign == 1
    df = spark.createDataFrame([(1234.5678,), (None,), (0.0,)], "v double")
    assert [r.s for r in df.select(rp.three_decimals(F.col("v")).alias("s")).collect()] == ["1234.568", "0", "0.000"]


def test_search_and_kinds(spark):
    df = spark.createDataFrame([("ab", "x"), ("b", "yab")], "a string, b string")
    assert search(df, ["a", "b"], "ab").count() == 2 and search(df, ["a"], "ab").count() == 1
    assert search(df, ["a"], " ").count() == 2


def test_day_difference(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-02-01 12:00:00"), ("2024-01-02 00:00:00", "2024-01-01 12:00:00"),
                                (None, "2024-01-01 00:00:00")], "a string, b string")
    a, b = F.col("a").cast("timestamp"), F.col("b").cast("timestamp")
    rows = df.select(times.days_between(a, b).alias("d"), times.is_expired(a, b).alias("x")).collect()
    assert [(r.d, r.x) for r in rows] == [(31, True), (0, False), (-1, False)]


def test_lists_and_percent(spark):
    row = spark.range(1).select(
        text.distinct_items(F.array(F.lit("b"), F.lit(None), F.lit("a"), F.lit("b"))).alias("d"),
        text.drop_empty(F.array(F.lit(""), F.lit(None), F.lit("a"))).alias("e"),
        text.comma_list(F.lit("a,,b,")).alias("c"), text.comma_list(F.lit(None).cast("string")).alias("n"),
        text.usage_percent(F.lit(2), F.lit(3)).alias("p"), text.usage_percent(F.lit(2), F.lit(3), True).alias("w")).first()
    assert (row.d, row.e, row.c, row.n, row.p, row.w) == (["b", "a"], ["a"], ["a", "", "b", ""], [], 66.7, 66.0)


def test_keyed_table(spark):
    root = work_dir(spark, "kv")
    at = "timestamp_seconds({0})"

    def rows(*items):
        return spark.createDataFrame(list(items), "key string, value string, e long, w long").selectExpr(
            "key", "value", at.format("e") + " AS expire_at", at.format("w") + " AS written_at")

    base = 1_704_067_200
    keyed.put(rows(("a", "1", base + 10, base), ("b", "1", base + 7200, base)), root, 0)
    keyed.put(rows(("a", "2", base + 20, base + 5)), root, 1)
    keyed.put(rows(("a", "2", base + 20, base + 5)), root, 1)  # the same batch again
    assert keyed.stored(spark, root).count() == 3
    now = "2024-01-01 00:00:15"
    assert sorted((r.key, r.value) for r in keyed.live(spark, root, now).collect()) == [("a", "2"), ("b", "1")]
    assert [r.key for r in keyed.live(spark, root, "2024-01-01 00:00:20").collect()] == ["b"]
    plan = keyed.live(spark, root, "2024-01-01 01:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(expire_hour" in plan
    assert keyed.drop_expired(spark, root, "2024-01-01 01:00:00") == 1
    assert [r.key for r in keyed.stored(spark, root).collect()] == ["b"]
    last = keyed.with_last(rows(("P1", "x", base, base), ("P2", "y", base, base + 1)), "P").collect()
    assert {r.key: r.value for r in last}["P_LAST"] == "y"


def test_recent_hours_prune_folders(spark):
    root = work_dir(spark, "hours")
    df = spark.range(0, 6).withColumn("t", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600))
    writers.append_hourly(df, root, "t")
    got = writers.read_recent_hours(spark, root, "2024-01-01 03:30:00", "id long")
    assert sorted((r.id, r.hh) for r in got.collect()) == [(2, "02"), (3, "03")]
    assert len(got.inputFiles()) == 2
    # One of the two hours is there, or none.
    assert [r.id for r in writers.read_recent_hours(spark, root, "2024-01-01 00:30:00", "id long").collect()] == [0]
    assert writers.read_recent_hours(spark, root, "2025-01-01 00:30:00", "id long").count() == 0


def test_compaction(spark):
    root, out = work_dir(spark, "arch"), work_dir(spark, "one")
    df = spark.range(0, 20).select(F.col("id").cast("string").alias("value"), F.lit("2024-01-01 05:10:00").cast("timestamp").alias("t"))
    for part in range(4):
        writers.write_hourly_batch(df.where(F.col("value") % 4 == part), root, "t", part)
    writers.compact_hour(spark, root, "2024-01-01", "05", out)
    text_df = spark.read.text(out)
    assert sorted(int(r.value) for r in text_df.collect()) == list(range(20))
    assert len(text_df.inputFiles()) == 1


def test_route(spark):
    df = spark.createDataFrame([("Query", "a"), ("Book", "b"), ("Other", "c")], "behavior_type string, value string")
    assert {r.value: r.topic for r in writers.route(df).collect()} == {"a": "processedQuery", "b": "processedBook"}
    assert [r.value for r in writers.of_behavior(df, 0).collect()] == ["a"]


def test_flow_loading(spark):
    process = spark.createDataFrame([("p1", "one", 0), ("p2", "two", 1), ("p3", "none", 0)], "id string, process_name string, status int")
    strategy = spark.createDataFrame([("p1", 50.0, 5.0), ("p2", 60.0, 6.0), ("p3", 70.0, 7.0)],
                                     "id string, crawler_blacklist_thresholds double, occ_blacklist_thresholds double")
    rules = spark.createDataFrame([("r2", "p1", "b", "t", 0, 1, 2.0, 3.0, 4), ("r1", "p1", "a", "t", 0, 0, 1.0, 0.0, 6),
                                   ("r3", "p1", "a", "t", 1, 0, 1.0, 0.0, 6), ("r4", "p1", "zz", "t", 0, 0, 1.0, 0.0, 6)],
                                  "id string, process_id string, rule_name string, rule_type string, crawler_type int, "
                                  "status int, arg0 double, arg1 double, score int")
    names = spark.createDataFrame([("a", "ip"), ("b", "userAgent")], "rule_name string, rule_real_name string")
    flows = readers.load_flows(readers.flow_rules(process, strategy, rules, names))
    assert [(f.flow_id, f.limit, [r.name for r in f.rules]) for f in flows] == [("p1", 50.0, ["ip", "userAgent"]), ("p3", 70.0, [])]
    occupy = readers.load_flows(readers.flow_rules(process, strategy, rules, names, status=1, crawler_type=1))
    assert [(f.flow_id, f.limit) for f in occupy] == [("p2", 6.0)]


def test_rule_loading(spark):
    table = spark.createDataFrame([("2", "0", "0", ".*", "GET", "true", "$.x"), ("1", "0", "1", ".*", "POST", "false", "")],
                                  "id string, flight_type string, behavior_type string, requestMatchExpression string, "
                                  "requestMethod string, isNormalGet string, query_depCity string")
    rules = readers.load_parse_rules(table, 0)
    assert len(rules) == 1 and rules[0].normal_get and rules[0].query == {"depCity": "$.x"}
    classify = spark.createDataFrame([(1, 0, "b"), (0, 1, "a"), (5, 0, "z")], "flight_type int, operation_type int, expression string")
    assert [r.expression for r in readers.load_classify_rules(classify)] == ["a", "b"]


def test_many_rules_stay_a_table(spark, monkeypatch):
    """Beyond the bound classify rules come as the table that is joined; a site takes either form. Rules that have to be
    compiled are refused."""
    monkeypatch.setattr(readers, "RULE_ROWS", 1)
    table = spark.createDataFrame([(0, 0, "^.*/query/.*$"), (0, 1, "^.*/new/.*$")],
                                  "flight_type int, operation_type int, expression string")
    many = readers.load_classify_rules(table)
    assert sorted(map(tuple, many.collect())) == [(0, 0, "^.*/query/.*$", 0), (0, 1, "^.*/new/.*$", 1)]
    monkeypatch.setattr(readers, "RULE_ROWS", 2)
    few = readers.load_classify_rules(table)
    assert [r.expression for r in few] == ["^.*/query/.*$", "^.*/new/.*$"]
    lines = spark.createDataFrame([(SAMPLE,), (SAMPLE.replace("query", "new"),)], "value string")
    tagged = [sorted(tagged_requests(lines, Site(classify=c)).select("request", "flight_type", "behavior_type").collect())
              for c in (many, few)]
    assert tagged[0] == tagged[1] and {r.behavior_type for r in tagged[0]} >= {"Query"}
    monkeypatch.setattr(readers, "RULE_ROWS", 0)
    flows = spark.createDataFrame([("f", "n", 1.0, 1, "ip", 0, 1.0, 0.0, 5)], "flow_id string, flow_name string, flow_limit "
                                  "double, id int, name string, status int, arg0 double, arg1 double, score int")
    with pytest.raises(ValueError):
        readers.load_flows(flows)


def test_host_status(spark):
    rows = [("system", 1, "h", 0.1, 0.1, 9_000_000, 4_000_000, 0.5, None, None, None, None),
            ("system", 2, "h", 0.2, 0.1234, 9_000_000, 5_000_000, 0.6, None, None, None, None),
            ("filesystem", 1, "h", None, None, None, None, None, "a", "/", 50_000_000, 10_000_000),
            ("filesystem", 2, "h", None, None, None, None, None, "a", "/", 50_000_000, 20_000_000),
            ("filesystem", 1, "h", None, None, None, None, None, "b", "/", 50_000_000, 0)]
    df = spark.createDataFrame(rows, "kind string, ts int, host string, cpu_system double, cpu_user double, mem_total long, "
                               "mem_used long, mem_used_p double, device string, mount string, fs_total long, fs_used long")
    row = mon.host_status(df).first()
    assert (row.cpu_rate, row.memory_info, row.disk_info, row.disk_rate) == (32.34, "5M/9M", "2G/10G", 20.0)


def test_work_dir_follows_the_cluster_setting(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
