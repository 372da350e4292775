"""Queries on server monitoring, report tables, ranking, paging and scalar helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.functions import codec, text, times
from skywarden.operators import funnel as fn
from skywarden.operators import monitor as mon
from skywarden.operators import reports as rp
from skywarden.operators.blacklist import latest_row
from skywarden.operators.scoring import rule_hits_per_period
from skywarden.operators.tag import optional_equal, search
from skywarden.plans import adapter
from skywarden.plans.catalog_metrics import _RATIO, _conv, _counts, _requests, _scored
from skywarden.plans.registry import cte, query
from skywarden.session import work_dir
from skywarden.sources import keyed
from skywarden.sources.daily import DailyTotals
from skywarden.sources.moves import SnapshotDrain
from skywarden.sources.paging import PagedTable
from skywarden.sources.readers import classify_rules, flow_limits, flow_rows_view, flow_rules, named_rules, parse_rules

_HOUR_NOW = "2024-01-20 00:00:00"

# --- hourly snapshots out of the raw lines ---

cte("hourly", ("slots",), """
SELECT date_trunc('hour', ts) AS h, count(*) AS source_count, min(epoch_us(ts) // 1000) AS start_ms,
 max(epoch_us(ts) // 1000) AS end_ms FROM slots GROUP BY 1""")
cte("hourly_servers", ("slots",), """
SELECT date_trunc('hour', ts) AS h, coalesce(s[10], '') AS server_addr, count(*) AS n FROM slots GROUP BY 1, 2""")
cte("snaps", ("hourly",), f"""
SELECT concat('CSANTI_MONITOR_DP', epoch_us(h) // 1000) AS key, h, source_count, end_ms - start_ms AS cost_time,
 CASE WHEN end_ms = start_ms THEN 0.0::DOUBLE ELSE source_count::DOUBLE / (end_ms - start_ms) END AS count_per_millis,
 strftime(make_timestamp(end_ms * 1000), '%Y-%m-%d %H:%M:%S') AS end_time FROM hourly""")


def _hour_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = adapter.raw_lines(spark, sf)
    return lines.withColumn("event_time", F.col("ts").cast("timestamp")).withColumn(
        "hour", F.date_trunc("hour", "event_time"))


def _hourly(spark: SparkSession, sf: str) -> DataFrame:
    """One row per hour: batch log columns and the per-server map, which has one entry per server of the site."""
    lines = _hour_lines(spark, sf)
    ms = F.unix_millis("event_time")
    per = (lines.withColumn("server_addr", F.coalesce(F.get(F.split("value", "#CS#"), F.lit(9)), F.lit("")))
           .groupBy("hour", "server_addr")
           .agg(F.count(F.lit(1)).alias("n"), F.min(ms).alias("start_ms"), F.max(ms).alias("end_ms")))
    return per.groupBy("hour").agg(
        F.sum("n").alias("source_count"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("server_addr", F.col("n").cast("int")))))
        .alias("servers_count_map"))


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    """Stored throughput snapshots, one per hour."""
    log = mon.throughput(_hourly(spark, sf).withColumns(
        {"application_id": F.lit("app-1"), "application_unique_name": F.lit("etl")}))
    return keyed.entries(log, mon.MONITOR_PREFIXES["process"], F.col("hour"), mon.throughput_snapshot(log),
                         mon.MONITOR_TTL_S)


_MONITORS: dict[tuple[str, str], str] = {}


def _monitor_root(spark: SparkSession, sf: str) -> str:
    """Folder of the stored snapshots, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MONITORS:
        root = work_dir(spark, "monitor")
        keyed.put(_entries(spark, sf), root, 0)
        _MONITORS[key] = root
    return _MONITORS[key]


def _snapshots(spark: SparkSession, sf: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """Stored snapshots, or those written between two times."""
    root = _monitor_root(spark, sf)
    rows = keyed.between(spark, root, low, high, mon.MONITOR_TTL_S) if low and high else keyed.stored(spark, root)
    return mon.decode_throughput(keyed.with_prefix(rows, mon.MONITOR_PREFIXES["process"]))


def _newest(spark: SparkSession, sf: str) -> DataFrame:
    return mon.newest_snapshot(mon.decode_throughput(keyed.newest_hour(spark, _monitor_root(spark, sf))))


@query("s16_decoded_snapshots", """
SELECT key, end_time, source_count::VARCHAR AS source_count, cost_time::VARCHAR AS cost_time, 'app-1' AS application_id
FROM snaps""", "snaps")
def _(spark, sf):
    return _snapshots(spark, sf).select("key", "end_time", "source_count", "cost_time", "application_id")


@query("s17_drained_parents", f"""
SELECT key AS id, source_count::DOUBLE AS source_count, end_time FROM snaps
WHERE end_time < '2024-01-19 23:30:00'""", "snaps")
def _(spark, sf):
    parent, _, _ = mon.drain(_snapshots(spark, sf), _HOUR_NOW)
    return parent.select("id", "source_count", times.second_text(F.col("end_time")).alias("end_time"))


@query("s17_drained_children", """
SELECT key AS parent_id, server_addr AS ip_address, n::DOUBLE AS ip_value FROM snaps JOIN hourly_servers USING (h)
WHERE end_time < '2024-01-19 23:30:00'""", "snaps", "hourly_servers")
def _(spark, sf):
    _, child, _ = mon.drain(_snapshots(spark, sf), _HOUR_NOW)
    return child.select("parent_id", "ip_address", "ip_value")


@query("s17_remaining", "SELECT key FROM snaps WHERE end_time >= '2024-01-19 23:30:00'", "snaps")
def _(spark, sf):
    _, _, stays = mon.drain(_snapshots(spark, sf), _HOUR_NOW)
    return stays.select("key")


@query("s17_moved_rows", f"""
SELECT 'parent' AS kind, key AS id, NULL AS ip_address FROM snaps WHERE end_time < '2024-01-19 23:30:00'
UNION ALL SELECT 'child', key, server_addr FROM snaps JOIN hourly_servers USING (h) WHERE end_time < '2024-01-19 23:30:00'
UNION ALL SELECT 'stays', key, NULL FROM snaps WHERE end_time >= '2024-01-19 23:30:00'""", "snaps", "hourly_servers")
def _(spark, sf):
    """The move out of the stored snapshots; it stops half way and is taken up again."""
    out = work_dir(spark, "s17")
    keyed.put(_entries(spark, sf), f"{out}/store", 0)
    drain = SnapshotDrain(spark, f"{out}/store", f"{out}/reports", mon.MONITOR_PREFIXES["process"])

    def stop(step: str) -> None:
        if step == "parents":
            raise InterruptedError(step)

    try:
        drain.run(_HOUR_NOW, stop)
    except InterruptedError:
        drain.run(_HOUR_NOW)
    none = F.lit(None).cast("string")
    newest = latest_row(keyed.stored(spark, f"{out}/store").select("key", "value", "expire_at", "written_at"), ["key"],
                        ["written_at", "expire_at", "value"]).where("value != ''")
    return (drain.table("parents").select(F.lit("parent").alias("kind"), "id", none.alias("ip_address"))
            .unionByName(drain.table("children").select(F.lit("child").alias("kind"), F.col("parent_id").alias("id"), "ip_address"))
            .unionByName(newest.select(F.lit("stays").alias("kind"), F.col("key").alias("id"), none.alias("ip_address"))))


@query("a13_server_counts", """
SELECT strftime(h, '%Y-%m-%d %H') AS hour, server_addr, n FROM hourly_servers""", "hourly_servers")
def _(spark, sf):
    out = mon.server_counts(_hour_lines(spark, sf), ["hour"])
    return out.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH"))


cte("active", ("slots",), """
SELECT date_trunc('day', ts) AS d, CASE WHEN coalesce(s[12], '') <> '' THEN s[10] ELSE '' END AS server_addr,
 arg_max(CASE WHEN coalesce(s[12], '') <> '' THEN s[12]::INTEGER ELSE 1 END, (ts, event_id)) AS active_num
FROM slots GROUP BY 1, 2""")


def _day_lines(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.raw_lines(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


@query("a14_active_connections", """
SELECT strftime(d, '%Y-%m-%d') AS day, server_addr, active_num FROM active""", "active")
def _(spark, sf):
    return mon.active_connections(_day_lines(spark, sf), ["ts", "event_id"], ["day"])


@query("a15_link_snapshot", """
SELECT strftime(c.d, '%Y-%m-%d') AS day, concat('{"serversCountMap":{', string_agg(concat('"', c.server_addr, '":', n), ','
 ORDER BY c.server_addr), '},"activeNumMap":{', string_agg(concat('"', c.server_addr, '":', active_num), ','
 ORDER BY c.server_addr), '}}') AS value
FROM (SELECT date_trunc('day', ts) AS d, coalesce(s[10], '') AS server_addr, count(*) AS n FROM slots GROUP BY 1, 2) c
JOIN active a ON a.d = c.d AND a.server_addr = c.server_addr GROUP BY 1""", "slots", "active")
def _(spark, sf):
    return mon.link_snapshot(_day_lines(spark, sf), ["ts", "event_id"], ["day"]).select("day", "value")


@query("a16_throughput", """
SELECT strftime(h, '%Y-%m-%d %H') AS hour, source_count, cost_time, round(count_per_millis, 12) AS count_per_millis,
 end_time FROM snaps""", "snaps")
def _(spark, sf):
    return mon.throughput(_hourly(spark, sf)).select(
        F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "source_count", "cost_time",
        F.round("count_per_millis", 12).alias("count_per_millis"), "end_time")


@query("a23_daily_flow", """
SELECT substr(end_time, 1, 10) AS day, sum(source_count)::DOUBLE AS flow_num FROM snaps
WHERE end_time < '2024-01-19 23:30:00' GROUP BY 1""", "snaps")
def _(spark, sf):
    parent, _, _ = mon.drain(_snapshots(spark, sf), _HOUR_NOW)
    return mon.daily_flow(parent).withColumn("day", F.col("day").cast("string"))


@query("a24_link_totals", "SELECT server_addr, sum(n)::BIGINT AS n FROM hourly_servers GROUP BY 1", "hourly_servers")
def _(spark, sf):
    return mon.link_totals(_snapshots(spark, sf))


@query("a25_spiders_found", """
SELECT count(DISTINCT CASE WHEN day = '2024-01-10' THEN remote_addr END) AS numspider,
 count(DISTINCT concat(day, remote_addr)) AS sumspider
FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, remote_addr FROM requests JOIN spiders USING (remote_addr))""",
       "requests", "spiders")
def _(spark, sf):
    reqs = _requests(spark, sf).select(F.to_date("event_time").alias("date"), "remote_addr").distinct()
    listed = adapter.spiders(spark, sf).select("remote_addr").distinct()
    found = reqs.join(listed, "remote_addr").groupBy("date").agg(F.count(F.lit(1)).alias("numspider"))
    return rp.spiders_found(found, "2024-01-10")


@query("a26_row_and_page_count", """
SELECT count(*) AS total, ceil(count(*) / 20.0)::BIGINT AS pages FROM lineitem
WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01'""")
def _(spark, sf):
    return rp.page_count(rp.date_range(_ranks(spark, sf), "1997-01-01", "1997-12-31", by_day=True), 20)


@query("a27_forward_series", """
SELECT substr(end_time, 1, 10) AS day, string_agg(end_time, ',' ORDER BY end_time) AS times,
 string_agg(source_count::VARCHAR, ',' ORDER BY end_time) AS vals, sum(source_count)::DOUBLE AS total
FROM snaps GROUP BY 1""", "snaps")
def _(spark, sf):
    out = mon.forward_series(_snapshots(spark, sf).withColumn("day", F.substring("end_time", 1, 10)), ["day"])
    return out.select("day", F.array_join("time", ",").alias("times"), F.array_join("value", ",").alias("vals"),
                      F.col("sum").alias("total"))


cte("hosts", (), """
SELECT CASE WHEN event_type = 'click' THEN 'filesystem' ELSE 'system' END AS kind, ts, concat('host', event_id % 3) AS host,
 value / 1000 AS cpu_system, value / 2000 AS cpu_user, (user_id + 1) * 3000000 AS mem_total, user_id * 1000000 AS mem_used,
 round(value / 1000, 4) AS mem_used_p, concat('sd', user_id % 2) AS device, concat('/m', user_id % 3) AS mount,
 (user_id + 10) * 50000000 AS fs_total, (user_id + 1) * 20000000 AS fs_used FROM events""")


def _hosts(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.read(spark, sf, "events").selectExpr(
        "CASE WHEN event_type = 'click' THEN 'filesystem' ELSE 'system' END AS kind", "ts",
        "concat('host', event_id % 3) AS host", "value / 1000 AS cpu_system", "value / 2000 AS cpu_user",
        "(user_id + 1) * 3000000 AS mem_total", "user_id * 1000000 AS mem_used", "round(value / 1000, 4) AS mem_used_p",
        "concat('sd', user_id % 2) AS device", "concat('/m', user_id % 3) AS mount",
        "(user_id + 10) * 50000000 AS fs_total", "(user_id + 1) * 20000000 AS fs_used")


@query("a28_host_status", """
SELECT s.host, round((cpu_system + cpu_user) * 100, 2) AS cpu_rate, round(mem_used_p * 100, 6) AS memory_rate,
 concat(mem_used // 1000000, 'M/', mem_total // 1000000, 'M') AS memory_info,
 concat(d.fs_used // 10000000, 'G/', d.fs_total // 10000000, 'G') AS disk_info,
 round(d.fs_used::DOUBLE / d.fs_total * 100, 2) AS disk_rate
FROM (SELECT * FROM hosts WHERE kind = 'system' QUALIFY row_number() OVER (PARTITION BY host ORDER BY ts DESC) = 1) s
LEFT JOIN (SELECT host, sum(fs_total)::BIGINT AS fs_total, sum(fs_used)::BIGINT AS fs_used FROM (
 SELECT * FROM hosts WHERE kind = 'filesystem'
 QUALIFY row_number() OVER (PARTITION BY host, device, mount ORDER BY ts DESC) = 1) GROUP BY 1) d USING (host)""", "hosts")
def _(spark, sf):
    return mon.host_status(_hosts(spark, sf)).drop("state_time").withColumn("memory_rate", F.round("memory_rate", 6))


@query("a29_distinct", """
SELECT 'rows' AS part, concat(remote_addr, '|', http_user_agent) AS item FROM requests GROUP BY 2
UNION ALL SELECT 'words', array_to_string(list_distinct_in_order, ',') FROM (
 SELECT list_filter(w, lambda x, i: list_position(w, x) = i) AS list_distinct_in_order FROM (
  SELECT string_split(text, ' ') AS w FROM conversations))""", "requests")
def _(spark, sf):
    rows = _requests(spark, sf).select("remote_addr", "http_user_agent").distinct().select(
        F.lit("rows").alias("part"), F.concat_ws("|", "remote_addr", "http_user_agent").alias("item"))
    words = adapter.read(spark, sf, "conversations").select(
        F.lit("words").alias("part"),
        F.array_join(text.distinct_items(F.split("text", " ")), ",").alias("item"))
    return rows.unionByName(words)


@query("f10_snapshot_range", """
SELECT 'given' AS kind, key FROM snaps WHERE end_time > '2024-01-05 00:00:00' AND end_time < '2024-01-09 12:00:00'
UNION ALL SELECT 'default', key FROM snaps WHERE end_time > '2024-01-14 00:00:00' AND end_time < '2024-01-15 00:00:00'
UNION ALL SELECT 'minutes', key FROM snaps WHERE end_time > '2024-01-19 20:00:00' AND end_time < '2024-01-20 00:00:00'""",
       "snaps")
def _(spark, sf):
    def written(low: str, high: str) -> DataFrame:
        return _snapshots(spark, sf, low, high)

    # A snapshot is written at the start of its hour and ends within it, so each range begins an hour early.
    given = mon.in_time_range(written("2024-01-04 23:00:00", "2024-01-09 12:00:00"), "2024-01-05 00:00:00",
                              "2024-01-09 12:00:00")
    default = mon.in_time_range(written("2024-01-13 23:00:00", "2024-01-15 00:00:00"), "", None, today="2024-01-15")
    minutes = mon.last_minutes(written("2024-01-19 19:00:00", _HOUR_NOW), 240, _HOUR_NOW)
    parts = [df.select(F.lit(kind).alias("kind"), "key")
             for kind, df in (("given", given), ("default", default), ("minutes", minutes))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


cte("server_days", ("slots",), """
SELECT strftime(ts, '%Y-%m-%d') AS day, coalesce(s[10], '') AS server_addr, count(*) AS n FROM slots GROUP BY 1, 2""")


@query("w4_rolling_server_totals", """
SELECT server_addr, day, n AS yesterday_num, coalesce(lag(n) OVER w, 0) AS before_yesterday_num,
 sum(n) OVER (PARTITION BY server_addr ORDER BY day ROWS 2 PRECEDING)::BIGINT AS last_three_days_num
FROM server_days WINDOW w AS (PARTITION BY server_addr ORDER BY day)""", "server_days")
def _(spark, sf):
    return mon.server_totals_by_day(mon.server_counts(_day_lines(spark, sf), ["day"]))


def _history_and_today(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    daily = mon.server_counts(_day_lines(spark, sf), ["day"])
    history = (mon.server_totals_by_day(daily).where("day = '2024-01-20' AND server_addr <> 'SRV2'")
               .drop("day").withColumnRenamed("server_addr", "server_name"))
    today = daily.where("day = '2024-01-21' AND server_addr <> 'SRV1'").select("server_addr", "n")
    return history, today


cte("server_hist", ("server_days",), """
SELECT * FROM (SELECT server_addr AS server_name, day, n AS y, coalesce(lag(n) OVER w, 0) AS b,
 sum(n) OVER (PARTITION BY server_addr ORDER BY day ROWS 2 PRECEDING)::BIGINT AS l3
FROM server_days WINDOW w AS (PARTITION BY server_addr ORDER BY day)) WHERE day = '2024-01-20' AND server_name <> 'SRV2'""")
cte("rolled", ("server_hist", "server_days"), """
SELECT coalesce(server_name, server_addr) AS server_name, CASE WHEN n IS NULL THEN b ELSE coalesce(y, 0) END AS
 before_yesterday_num, coalesce(n, y) AS yesterday_num,
 CASE WHEN n IS NULL THEN l3 ELSE n + coalesce(y, 0) + coalesce(b, 0) END AS last_three_days_num
FROM server_hist FULL JOIN (SELECT server_addr, n FROM server_days WHERE day = '2024-01-21' AND server_addr <> 'SRV1') t
ON server_name = server_addr""")


@query("j9_rolled_totals", "SELECT * FROM rolled", "rolled")
def _(spark, sf):
    return mon.roll_server_totals(*_history_and_today(spark, sf))


@query("j9_stored_totals", "SELECT * FROM rolled", "rolled")
def _(spark, sf):
    """The same from totals stored by day: the day's run reads the day before it and its own lines."""
    history, _ = _history_and_today(spark, sf)
    totals = DailyTotals(spark, work_dir(spark, "totals"))
    totals.start("2024-01-20", history)
    lines = _day_lines(spark, sf).where("ts >= TIMESTAMP_NTZ '2024-01-21' AND ts < TIMESTAMP_NTZ '2024-01-22'")
    return totals.roll("2024-01-21", mon.server_counts(lines, ["day"]).where("server_addr <> 'SRV1'"))


_VIEW_SQL = """
SELECT server_name, active_num, yesterday_num, before_yesterday_num, last_three_days_num FROM rolled
JOIN (SELECT server_addr AS server_name, active_num FROM active WHERE d = (SELECT max(d) FROM active)) USING (server_name)"""


def _server_view(spark: SparkSession, sf: str) -> DataFrame:
    links = mon.link_snapshot(_day_lines(spark, sf), ["ts", "event_id"], ["day"])
    kv = links.select(F.concat(F.lit(mon.MONITOR_PREFIXES["link"]), "day").alias("key"), "value")
    newest = mon.decode_link(kv).groupBy().agg(
        F.max_by(F.struct("servers_count_map", "active_num_map"), "key").alias("s")).select("s.*")
    return mon.server_view(mon.roll_server_totals(*_history_and_today(spark, sf)), newest)


@query("j8_server_active", "SELECT server_name, active_num, yesterday_num FROM (" + _VIEW_SQL + ")", "rolled", "active")
def _(spark, sf):
    return _server_view(spark, sf).select("server_name", "active_num", "yesterday_num")


@query("r13_server_view", _VIEW_SQL, "rolled", "active")
def _(spark, sf):
    return _server_view(spark, sf)


# --- report tables ---

cte("funnel_day", ("funnel",), "SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM funnel")


def _daily_counts(spark: SparkSession, sf: str, by=()) -> DataFrame:
    return _counts(spark, sf, ["day", *by])


def flow_info(spark: SparkSession, sf: str) -> DataFrame:
    """Daily volumes as the report table: type 0 all, 1 crawler."""
    vols = fn.volumes(_daily_counts(spark, sf), ["day"]).where("spider_tag IN ('all', '1')")
    kind = F.when(F.col("spider_tag") == "1", 1).otherwise(0)
    return vols.select(F.concat_ws("-", F.col("day").cast("string"), kind).alias("id"), kind.alias("flow_type"),
                       F.col("requests").cast("double").alias("flow_value"),
                       F.col("day").cast("timestamp").alias("record_time"))


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("record_time", F.date_format("record_time", "yyyy-MM-dd"))


_FLOW_INFO = """
SELECT concat(day, '-0') AS id, 0 AS flow_type, count(*)::DOUBLE AS flow_value, day AS record_time FROM funnel_day
GROUP BY day UNION ALL SELECT concat(day, '-1'), 1, count(*)::DOUBLE, day FROM funnel_day WHERE spider = '1' GROUP BY day"""


@query("r1_flow_volumes", f"SELECT * FROM ({_FLOW_INFO}) WHERE record_time BETWEEN '2024-01-05' AND '2024-01-20'",
       "funnel_day")
def _(spark, sf):
    return _with_day(rp.report(flow_info(spark, sf), "2024-01-05", "2024-01-20", ["record_time", "flow_type"]))


@query("w3_daily_series", f"""
SELECT strftime(d, '%Y-%m-%d') AS day, max(flow_value) FILTER (WHERE flow_type = 0) AS total,
 max(flow_value) FILTER (WHERE flow_type = 1) AS crawler
FROM (SELECT unnest(generate_series(DATE '2023-12-28', DATE '2024-02-03', INTERVAL 1 DAY)) AS d) c
LEFT JOIN ({_FLOW_INFO}) f ON f.record_time = strftime(d, '%Y-%m-%d') GROUP BY 1""", "funnel_day")
def _(spark, sf):
    out = rp.daily_series(flow_info(spark, sf), "2023-12-28", "2024-02-03", "flow_type", "flow_value", [0, 1])
    return out.select(F.col("day").cast("string").alias("day"), F.col("0").alias("total"), F.col("1").alias("crawler"))


@query("r2_query_rates", f"""
SELECT day AS record_time, spider AS user_type, {_RATIO} AS conversion_rate FROM funnel_day
WHERE day <= '2024-01-15' GROUP BY 1, 2""", "funnel_day")
def _(spark, sf):
    rates = fn.query_book(_daily_counts(spark, sf), ["day"]).select(
        F.col("day").cast("timestamp").alias("record_time"), F.col("spider_tag").alias("user_type"),
        F.col("query_book_ratio").alias("conversion_rate"))
    return _with_day(rp.report(rates, None, "2024-01-15", ["record_time", "user_type"]))


def _orders(spark: SparkSession, sf: str, n: int) -> DataFrame:
    return adapter.read(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", f"o_custkey % {n} AS type", "o_totalprice AS value", "o_orderdate AS record_time")


_RANGE = "o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1998-06-30'"


@query("r3_user_classes", f"""
SELECT o_orderkey AS id, o_custkey % 4 AS type, o_totalprice AS value,
 strftime(o_orderdate, '%Y-%m-%d') AS record_time FROM orders WHERE {_RANGE}""")
def _(spark, sf):
    return _with_day(rp.report(_orders(spark, sf, 4), "1996-03-01", "1998-06-30", ["record_time", "id"]))


@query("r4_agency_customers", f"""
SELECT o_orderkey AS id, o_totalprice AS value, strftime(o_orderdate, '%Y-%m-%d') AS record_time FROM orders
WHERE {_RANGE} AND o_custkey % 3 = 1""")
def _(spark, sf):
    rows = rp.report(_orders(spark, sf, 3), "1996-03-01", "1998-06-30", ["record_time", "id"], type=1)
    return _with_day(rows).drop("type")


@query("f8_date_range", """
SELECT 'both' AS bounds, o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
UNION ALL SELECT 'from', o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
UNION ALL SELECT 'open', o_orderkey FROM orders""")
def _(spark, sf):
    orders = adapter.read(spark, sf, "orders")
    parts = [rp.date_range(orders, a, b, "o_orderdate").select(F.lit(kind).alias("bounds"), "o_orderkey")
             for kind, a, b in (("both", "1996-01-01", "1996-12-31"), ("from", "1999-01-01", "null"), ("open", "", None))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("f9_same_day", "SELECT event_id FROM events WHERE ts >= DATE '2024-01-12' AND ts < DATE '2024-01-13'")
def _(spark, sf):
    return rp.same_day(adapter.read(spark, sf, "events"), "2024-01-12", "ts").select("event_id")


@query("f11_search", """
SELECT c_custkey FROM customer WHERE contains(c_name, '42') OR contains(c_mktsegment, 'MACH')""")
def _(spark, sf):
    return search(adapter.read(spark, sf, "customer"), ["c_name", "c_mktsegment"], "42" ).select("c_custkey").union(
        search(adapter.read(spark, sf, "customer").where(~F.col("c_name").contains("42")), ["c_mktsegment"], "MACH")
        .select("c_custkey"))


@query("f13_drop_empty", """
SELECT doc_id, len(list_filter(string_split(text, ' '), lambda x: x IS NOT NULL AND x <> '')) AS words FROM documents""")
def _(spark, sf):
    docs = adapter.read(spark, sf, "documents")
    return docs.select("doc_id", F.size(text.drop_empty(F.split("text", " "))).cast("long").alias("words"))


@query("r5_crawl_frequency", """
SELECT day AS record_time, flight_type, travel_type, count(*) AS n FROM funnel_day
WHERE spider = '1' AND has_session AND travel_type = 'OneWay' AND day >= '2024-01-10' GROUP BY ALL""", "funnel_day")
def _(spark, sf):
    reqs = _requests(spark, sf).withColumn("day", F.to_date("event_time"))
    trips = fn.spider_trips(reqs, adapter.spiders(spark, sf), ["day"]).withColumn(
        "record_time", F.col("day").cast("timestamp")).drop("day")
    return _with_day(rp.report(trips, "2024-01-10", None, ["record_time", "flight_type"], travel_type="OneWay"))


@query("r6_conversion_on_day", f"""
SELECT 'flight' AS kind, flight_type AS class, {_conv(2)} * 100 AS select_pct, {_conv(3)} * 100 AS pay_pct
FROM funnel_day WHERE day = '2024-01-08' GROUP BY 2
UNION ALL SELECT 'user', spider, {_conv(2)} * 100, {_conv(3)} * 100 FROM funnel_day WHERE day = '2024-01-08' GROUP BY 2
UNION ALL SELECT 'user', 'all', {_conv(2)} * 100, {_conv(3)} * 100 FROM funnel_day WHERE day = '2024-01-08'""", "funnel_day")
def _(spark, sf):
    counts = _daily_counts(spark, sf, ["flight_type"])
    flight = rp.day_report(fn.flight_conversion(counts, ["day"]), "2024-01-08", "day").select(
        F.lit("flight").alias("kind"), F.col("flight_type").alias("class"), "select_to_info", "info_to_pay")
    user = rp.day_report(fn.funnel(counts, ["day"]), "2024-01-08", "day").select(
        F.lit("user").alias("kind"), F.col("spider_tag").alias("class"), "select_to_info", "info_to_pay")
    both = flight.unionByName(user)
    return both.select("kind", "class", rp.percent(F.col("select_to_info")).alias("select_pct"),
                       rp.percent(F.col("info_to_pay")).alias("pay_pct"))


@query("r7_rule_hits", """
SELECT period, rule_name, count(*) AS hits FROM (
 SELECT strftime(w, '%Y-%m-%d') AS period, unnest(string_split(hit_rules, ',')) AS rule_name
 FROM flow_rows WHERE flow_score > flow_limit) GROUP BY 1, 2""", "flow_rows")
def _(spark, sf):
    hits = rule_hits_per_period(_scored(spark, sf), "day")
    return hits.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


@query("r8_model_accuracy", """
SELECT l_orderkey AS id, l_linenumber AS line, strftime(l_shipdate, '%Y-%m-%d') AS date, l_discount AS accuracy
FROM lineitem WHERE l_linenumber % 3 = 1 AND l_suppkey % 4 = 2""")
def _(spark, sf):
    rows = adapter.read(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS id", "l_linenumber AS line", "l_shipdate AS date", "l_linenumber % 3 AS timetype",
        "l_suppkey % 4 AS flowtype", "l_discount AS accuracy")
    out = rp.report(optional_equal(rows, "flowtype", 2), order=["date", "id", "line"], column="date", timetype=1)
    return out.select("id", "line", F.date_format("date", "yyyy-MM-dd").alias("date"), "accuracy")


cte("kind_speeds", ("requests",), """
SELECT behavior_type, h, CASE WHEN end_ms = start_ms THEN 0.0::DOUBLE ELSE n::DOUBLE / (end_ms - start_ms) END AS speed
FROM (SELECT behavior_type, date_trunc('hour', ts) AS h, count(*) AS n, min(epoch_us(ts) // 1000) AS start_ms,
 max(epoch_us(ts) // 1000) AS end_ms FROM requests WHERE behavior_type IN ('Query', 'Book') GROUP BY 1, 2)""")


def _kind_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Throughput snapshots of query and booking requests, one per hour under the prefix of their kind."""
    ms = F.unix_millis("event_time")
    kind = F.when(F.col("behavior_type") == "Query", mon.MONITOR_PREFIXES["query"]).otherwise(mon.MONITOR_PREFIXES["book"])
    hours = (_requests(spark, sf).where(F.col("behavior_type").isin("Query", "Book"))
             .groupBy(kind.alias("prefix"), F.date_trunc("hour", "event_time").alias("hour"))
             .agg(F.count(F.lit(1)).alias("source_count"), F.min(ms).alias("start_ms"), F.max(ms).alias("end_ms")))
    log = mon.throughput(hours.withColumns({
        "application_id": F.lit("app-2"), "application_unique_name": F.lit("scoring"),
        "servers_count_map": F.lit(None).cast("map<string,int>")}))
    return log.select(F.concat("prefix", F.unix_millis("hour").cast("string")).alias("key"),
                      mon.throughput_snapshot(log).alias("value"),
                      (F.col("hour") + F.make_dt_interval(secs=F.lit(mon.MONITOR_TTL_S))).alias("expire_at"),
                      F.col("hour").alias("written_at"))


@query("r9_speeds", """
SELECT printf('%.3f', (SELECT speed FROM kind_speeds WHERE behavior_type = 'Query' ORDER BY h DESC LIMIT 1)) AS realtime,
 printf('%.3f', (SELECT speed FROM kind_speeds WHERE behavior_type = 'Book' ORDER BY h DESC LIMIT 1)) AS near_realtime,
 '0' AS offline""", "kind_speeds")
def _(spark, sf):
    """Real time from the newest query snapshot, near real time from the newest booking snapshot."""
    root = work_dir(spark, "kinds")
    keyed.put(_kind_entries(spark, sf), root, 0)
    stored = keyed.stored(spark, root)

    snaps = mon.decode_throughput(stored).withColumn("kind", F.when(
        F.col("key").startswith(mon.MONITOR_PREFIXES["query"]), "query").otherwise("book"))
    newest = mon.newest_snapshot(snaps, ["kind"])

    def speed(kind: str):
        return rp.three_decimals(F.max(F.when(F.col("kind") == kind, F.col("count_per_millis").try_cast("double"))))

    return newest.agg(speed("query").alias("realtime"), speed("book").alias("near_realtime"), F.lit("0").alias("offline"))


@query("r10_pipeline_health", """
SELECT 'busy' AS part, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS sign FROM snaps
WHERE end_time > '2024-01-19 23:00:00' AND end_time < '2024-01-20 00:00:00'
UNION ALL SELECT 'idle', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM snaps WHERE end_time > '2025-01-01 00:00:00'""",
       "snaps")
def _(spark, sf):
    def health(now: str, low: str) -> DataFrame:
        # A snapshot is written at the start of its hour and ends within it.
        return rp.pipeline_health(mon.last_minutes(_snapshots(spark, sf, low, now), 60, now))

    busy, idle = health(_HOUR_NOW, "2024-01-19 22:00:00"), health("2025-06-01 00:00:00", "2025-05-31 22:00:00")
    return busy.withColumn("part", F.lit("busy")).unionByName(idle.withColumn("part", F.lit("idle")))


@query("r11_latest_server_traffic", """
SELECT server_addr, n::INTEGER AS n FROM hourly_servers WHERE h = (SELECT arg_max(h, (end_time, key)) FROM snaps)""",
       "hourly_servers", "snaps")
def _(spark, sf):
    return mon.server_traffic(_newest(spark, sf)).select("server_addr", "n")


@query("r12_yesterday", """
SELECT f.flow_num, s.numspider FROM (SELECT sum(source_count)::DOUBLE AS flow_num FROM snaps
 WHERE substr(end_time, 1, 10) = '2024-01-10') f,
(SELECT count(DISTINCT remote_addr) AS numspider FROM requests WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-11'
 AND remote_addr IN (SELECT remote_addr FROM spiders)) s""", "snaps", "requests", "spiders")
def _(spark, sf):
    parent, _, _ = mon.drain(_snapshots(spark, sf, "2024-01-10 00:00:00", "2024-01-10 23:59:59"), _HOUR_NOW)
    flow = mon.daily_flow(parent, "2024-01-10").select("day", "flow_num")
    reqs = rp.same_day(_requests(spark, sf), "2024-01-10", "event_time").select("remote_addr").distinct()
    found = (reqs.join(adapter.spiders(spark, sf).select("remote_addr").distinct(), "remote_addr", "left_semi")
             .agg(F.count(F.lit(1)).alias("numspider")).withColumn("day", F.lit("2024-01-10").cast("date")))
    return flow.join(found, "day").select("flow_num", "numspider")


# --- ranking and paging ---

@query("t1_route_ranking", """
SELECT depcity, arrcity, flight_date, count(*) AS grap_frequency FROM funnel
WHERE spider = '1' AND behavior_type = 'Query' GROUP BY ALL""", "funnel")
def _(spark, sf):
    queries = fn.tag_spiders(_requests(spark, sf), adapter.spiders(spark, sf), "inner", spread=["event_id"]).where(
        "behavior_type = 'Query' AND lower(flow_id) <> 'null'")
    return rp.ranking(rp.route_frequencies(queries), "grap_frequency", ["depcity", "arrcity", "flight_date"])


def _ranks(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.read(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "concat('CZ', l_partkey) AS flight_code", "l_extendedprice AS price",
        "l_quantity AS frequency", "l_shipdate AS record_time")


@query("t2_seat_ranking_page", """
SELECT l_orderkey, l_linenumber, concat('CZ', l_partkey) AS flight_code, l_extendedprice AS price,
 l_quantity AS frequency FROM lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01'
ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_extendedprice LIMIT 20 OFFSET 40""")
def _(spark, sf):
    rows = rp.date_range(_ranks(spark, sf), "1997-01-01", "1997-12-31", by_day=True)
    out = rp.page(rows, [F.col("frequency").desc(), "l_orderkey", "l_linenumber", "l_partkey", "price"], 3)
    return out.select("l_orderkey", "l_linenumber", "flight_code", "price", "frequency")


@query("t3_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50 OFFSET 50")
def _(spark, sf):
    return rp.page(adapter.read(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                   ["o_totalprice", "o_orderkey"], 2, 50)


@query("t3_deep_page", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
 l_partkey LIMIT 50 OFFSET 4950""")
def _(spark, sf):
    """The hundredth page of a table that was sorted into ranges: only the ranges it lies in are opened."""
    items = adapter.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    table = PagedTable(spark, work_dir(spark, "pages"), [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey"])
    table.store(items)
    return table.page(100, 50).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("t4_first_row", "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1")
def _(spark, sf):
    return rp.first_row(adapter.read(spark, sf, "orders"), [F.col("o_orderdate").desc(), "o_orderkey"]).select(
        "o_orderkey")


@query("t5_multi_key_sort", """
SELECT s_name AS process_name, (s_nationkey % 2)::INTEGER AS type, (1000 - s_suppkey % 50)::INTEGER AS create_date
FROM supplier ORDER BY create_date DESC, process_name""")
def _(spark, sf):
    rows = _process(spark, sf).join(_models(spark, sf), "id").select("process_name", "type", "create_date")
    return rows.orderBy(F.col("create_date").desc(), "process_name")


@query("t6_newest_snapshot", """
SELECT key, end_time FROM snaps ORDER BY end_time DESC, key DESC LIMIT 1""", "snaps")
def _(spark, sf):
    return _newest(spark, sf).select("key", "end_time")


@query("u1_bag_union", """
SELECT request, count(*) AS n FROM (SELECT request FROM requests WHERE ts < TIMESTAMP '2024-01-15'
UNION ALL SELECT request FROM requests WHERE ts >= TIMESTAMP '2024-01-10') GROUP BY 1""", "requests")
def _(spark, sf):
    reqs = _requests(spark, sf)
    both = reqs.where("event_time < '2024-01-15'").unionByName(reqs.where("event_time >= '2024-01-10'"))
    return both.groupBy("request").agg(F.count(F.lit(1)).alias("n"))


@query("u2_distinct_sets", """
SELECT remote_addr, http_user_agent, jsessionid FROM requests GROUP BY ALL""", "requests")
def _(spark, sf):
    return _requests(spark, sf).select("remote_addr", "http_user_agent", "jsessionid").distinct()


# --- configuration tables ---

def _process(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.read(spark, sf, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS id", "s_name AS process_name", "CAST(1000 - s_suppkey % 50 AS INT) AS create_date",
        "CAST(s_suppkey % 2 AS INT) AS status")


def _strategy(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.read(spark, sf, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS id", "s_acctbal AS crawler_blacklist_thresholds",
        "s_acctbal / 2 AS occ_blacklist_thresholds")


def _models(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.read(spark, sf, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS id", "CAST(s_nationkey % 2 AS INT) AS type")


def _rules(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.read(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey * 10 + l_linenumber AS STRING) AS id", "CAST(l_suppkey AS STRING) AS process_id",
        "concat('rule', l_partkey % 7) AS rule_name", "l_returnflag AS rule_type",
        "CAST(l_orderkey % 2 AS INT) AS crawler_type", "CAST(l_linenumber % 2 AS INT) AS status",
        "l_quantity AS arg0", "l_tax AS arg1", "CAST(l_linenumber AS INT) AS score")


def _rule_names(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.read(spark, sf, "part").selectExpr(
        "concat('rule', p_partkey % 7) AS rule_name", "concat('metric', p_partkey % 7) AS rule_real_name").distinct()


cte("named", (), """
SELECT (l_orderkey * 10 + l_linenumber)::VARCHAR AS id, l_suppkey::VARCHAR AS flow_id,
 concat('metric', l_partkey % 7) AS name, (l_linenumber % 2)::INTEGER AS status, l_quantity AS arg0, l_tax AS arg1
FROM lineitem WHERE l_orderkey % 2 = 0""")
cte("limits", (), """
SELECT s_suppkey::VARCHAR AS flow_id, s_name AS flow_name, s_acctbal AS flow_limit FROM supplier WHERE s_suppkey % 2 = 0""")


@query("s9_flow_rules", """
SELECT flow_id, flow_name, flow_limit, id, name, status, arg0, arg1 FROM limits LEFT JOIN named USING (flow_id)""",
       "limits", "named")
def _(spark, sf):
    return flow_rows_view(flow_rules(_process(spark, sf), _strategy(spark, sf), _rules(spark, sf),
                                     _rule_names(spark, sf)))


@query("j4_flow_limits", "SELECT * FROM limits", "limits")
def _(spark, sf):
    return flow_limits(_process(spark, sf), _strategy(spark, sf))


@query("j5_named_rules", "SELECT id, flow_id AS process_id, name, status, arg0, arg1 FROM named", "named")
def _(spark, sf):
    return named_rules(_rules(spark, sf), _rule_names(spark, sf)).drop("rule_type", "score")


@query("j6_process_models", """
SELECT s_name AS process_name, (s_nationkey % 2)::INTEGER AS type, (s_suppkey % 2)::INTEGER AS status FROM supplier""")
def _(spark, sf):
    return (_process(spark, sf).join(_models(spark, sf), "id").orderBy(F.col("create_date").desc(), "process_name")
            .select("process_name", "type", "status"))


@query("r14_rules_of_flow", """
SELECT (l_orderkey * 10 + l_linenumber)::VARCHAR AS id, concat('rule', l_partkey % 7) AS rule_name FROM lineitem
WHERE l_suppkey = 7""")
def _(spark, sf):
    return _rules(spark, sf).where("process_id = '7'").orderBy("rule_name", "id").select("id", "rule_name")


_PARSE = """CAST(p_partkey AS STRING) AS id, CAST(p_size % 2 AS INT) AS flight_type,
CAST(p_partkey % 3 AS INT) AS behavior_type, CAST(p_partkey % 2 = 0 AS STRING) AS isJson,
CAST(p_size % 3 = 0 AS STRING) AS isApplicationJson, CAST(p_partkey % 2 = 1 AS STRING) AS isXML,
CAST(p_size % 3 = 1 AS STRING) AS isTextXml, CAST(p_size % 3 = 2 AS STRING) AS isNormalForm,
CAST(p_size % 5 = 0 AS STRING) AS isNormalGet"""


def _parse_table(spark: SparkSession, sf: str) -> DataFrame:
    adapter.read(spark, sf, "part").createOrReplaceTempView("site_part")
    return spark.sql(f"SELECT {_PARSE} FROM site_part")


@query("s8_parse_rules", f"SELECT id, flight_type FROM (SELECT {_PARSE} FROM part) WHERE behavior_type = 1")
def _(spark, sf):
    return parse_rules(_parse_table(spark, sf), 1).select("id", "flight_type")


@query("f12_rules_of_kind", f"""
WITH p AS (SELECT {_PARSE} FROM part)
SELECT '0' AS kind, id FROM p WHERE isJson = 'true' AND isApplicationJson = 'true' AND flight_type = 0 AND behavior_type = 1
UNION ALL SELECT '1', id FROM p WHERE isJson = 'true' AND isApplicationJson = 'false' AND flight_type = 0 AND behavior_type = 1
UNION ALL SELECT '2', id FROM p WHERE isXML = 'true' AND isTextXml = 'true' AND flight_type = 0 AND behavior_type = 1
UNION ALL SELECT '3', id FROM p WHERE isXML = 'true' AND isNormalForm = 'true' AND flight_type = 0 AND behavior_type = 1
UNION ALL SELECT '4', id FROM p WHERE isXML = 'false' AND isJson = 'false' AND isNormalForm = 'true' AND flight_type = 0
 AND behavior_type = 1
UNION ALL SELECT '5', id FROM p WHERE isNormalGet = 'true' AND flight_type = 0 AND behavior_type = 1""")
def _(spark, sf):
    return rp.parse_rules_by_kind(_parse_table(spark, sf), 0, 1).select("kind", "id")


@query("s7_classify_rules", """
SELECT * FROM (SELECT (p_partkey % 3)::INTEGER AS flight_type, (p_size % 3)::INTEGER AS operation_type,
 concat('^.*/', p_name, '/.*$') AS expression,
 (p_partkey % 3 * 2 + p_size % 3)::INTEGER AS priority FROM part) WHERE flight_type < 2 AND operation_type < 2""")
def _(spark, sf):
    table = adapter.read(spark, sf, "part").selectExpr(
        "CAST(p_partkey % 3 AS INT) AS flight_type", "CAST(p_size % 3 AS INT) AS operation_type",
        "concat('^.*/', p_name, '/.*$') AS expression")
    return classify_rules(table)


@query("s6_lookup_column", "SELECT remote_addr AS ip_name FROM spiders", "spiders")
def _(spark, sf):
    from skywarden.sources.readers import load_lookup

    return load_lookup(adapter.spiders(spark, sf), "remote_addr", "ip_name")


# --- scalar helpers over whole tables ---

@query("x1_full_match", """
SELECT page_id, regexp_full_match(url, 'https?://[a-z.-]+/en/[0-9]+') AS matched FROM pages""")
def _(spark, sf):
    pages = adapter.read(spark, sf, "pages")
    return pages.select("page_id", text.full_match(F.col("url"), "https?://[a-z.-]+/en/[0-9]+").alias("matched"))


@query("x2_find_all", """
SELECT page_id, len(regexp_extract_all(html, '<a href'))::INTEGER AS links,
 array_to_string(regexp_extract_all(url, '[0-9]+'), ',') AS numbers FROM pages""")
def _(spark, sf):
    pages = adapter.read(spark, sf, "pages")
    return pages.select("page_id", F.regexp_count("html", F.lit("<a href")).alias("links"),
                        F.array_join(F.regexp_extract_all("url", F.lit("[0-9]+"), F.lit(0)), ",").alias("numbers"))


@query("x3_split", "SELECT page_id, len(string_split(url, '/'))::INTEGER AS parts FROM pages")
def _(spark, sf):
    return adapter.read(spark, sf, "pages").select("page_id", F.size(F.split("url", "/")).alias("parts"))


@query("x4_text_pieces", """
SELECT page_id, replace(split_part(url, '?', 1), 'https', 'http') AS bare, contains(url, 'utm_') AS tracked FROM pages""")
def _(spark, sf):
    return adapter.read(spark, sf, "pages").select(
        "page_id", F.replace(F.substring_index("url", "?", 1), F.lit("https"), F.lit("http")).alias("bare"),
        F.col("url").contains("utm_").alias("tracked"))


@query("x5_blank", """
SELECT event_id, jsessionid IS NULL OR trim(jsessionid) = '' OR lower(jsessionid) = 'null' AS blank FROM requests""",
       "requests")
def _(spark, sf):
    return _requests(spark, sf).select("event_id", text.is_blank(F.col("jsessionid")).alias("blank"))


@query("x6_escape_round_trip", """
SELECT conv_id, turn, md5(text) AS digest, true AS same FROM conversations""")
def _(spark, sf):
    rows = adapter.read(spark, sf, "conversations")
    back = codec.js_unescape(codec.js_escape(F.col("text")))
    return rows.select("conv_id", "turn", F.md5(back).alias("digest"),
                       (codec.url_decode(F.url_encode("text")) == F.col("text")).alias("same"))


@query("x7_md5", "SELECT page_id, upper(md5(html)) AS digest FROM pages")
def _(spark, sf):
    return adapter.read(spark, sf, "pages").select("page_id", codec.md5_upper(F.col("html")).alias("digest"))


@query("x8_json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k, false AS broken FROM events")
def _(spark, sf):
    events = adapter.read(spark, sf, "events")
    back = F.get_json_object(F.to_json(F.from_json("props", "struct<k:int>")), "$.k")
    return events.select("event_id", F.get_json_object("props", "$.k").alias("k"),
                         (back != F.get_json_object("props", "$.k")).alias("broken"))


@query("x9_xpath", """
SELECT event_id, array_to_string(regexp_extract_all(request_body, '<NAME>([^<]*)</NAME>', 1), ',') AS names,
 regexp_extract(request_body, '<USER>([^<]*)</USER>', 1) AS user_id FROM parsed WHERE starts_with(request_body, '<page><ORDER>')""",
       "parsed")
def _(spark, sf):
    from skywarden.functions.documents import with_xml_page, xpath_list, xpath_text
    from skywarden.operators.parse import parse_requests

    bodies = parse_requests(adapter.raw_lines(spark, sf)).where(F.col("request_body").startswith("<page><ORDER>"))
    paged = with_xml_page(bodies, F.col("request_body"))
    return paged.select("event_id", F.array_join(xpath_list(F.col("_page"), "//NAME/text()"), ",").alias("names"),
                        xpath_text(F.col("_page"), "//USER/text()").alias("user_id"))


@query("x10_dates", """
SELECT event_id, strftime(ts + INTERVAL 20 MINUTES, '%Y-%m-%d %H:%M:%S') AS later,
 strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before, strftime(ts, '%Y-%m-%d 00:00:00') AS day_start FROM events""")
def _(spark, sf):
    rows = _requests(spark, sf)
    t = F.col("event_time")
    return rows.select("event_id", times.second_text(times.add_minutes(t, 20)).alias("later"),
                       times.previous_day_text(t).alias("day_before"), times.day_start_text(t).alias("day_start"))


@query("x11_day_difference", """
SELECT o_orderkey, ((epoch_us(TIMESTAMP '1998-12-31 12:00:00') - epoch_us(o_orderdate)) // 86400000000)::INTEGER AS days,
 (epoch_us(TIMESTAMP '1998-12-31 12:00:00') - epoch_us(o_orderdate)) // 86400000000 > 30 AS expired
FROM orders WHERE o_orderdate <= TIMESTAMP '1998-12-31'""")
def _(spark, sf):
    orders = adapter.read(spark, sf, "orders").where("o_orderdate <= '1998-12-31'")
    now, at = F.lit("1998-12-31 12:00:00").cast("timestamp"), F.col("o_orderdate").cast("timestamp")
    return orders.select("o_orderkey", times.days_between(at, now).alias("days"), times.is_expired(at, now).alias("expired"))


@query("x12_map_default", """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '-') AS k, '-' AS other FROM events""")
def _(spark, sf):
    props = F.from_json("props", "map<string,string>")
    return adapter.read(spark, sf, "events").select(
        "event_id", text.map_get(props, "k", "-").alias("k"), text.map_get(props, "absent", "-").alias("other"))


@query("x13_array_figures", """
SELECT vec_id, len(embedding)::INTEGER AS n, list_max(embedding)::DOUBLE AS top, list_sort(embedding)[1]::DOUBLE AS low
FROM embeddings""")
def _(spark, sf):
    return adapter.read(spark, sf, "embeddings").select(
        "vec_id", F.size("embedding").alias("n"), F.array_max("embedding").cast("double").alias("top"),
        F.element_at(F.sort_array("embedding"), 1).cast("double").alias("low"))


@query("x14_usage_percent", """
SELECT p_partkey, round(p_size * 100.0::DOUBLE / (p_partkey + 60), 1) AS pct,
 (p_size * 100 // (p_partkey + 60))::DOUBLE AS whole_pct FROM part""")
def _(spark, sf):
    size, total = F.col("p_size"), F.col("p_partkey") + 60
    return adapter.read(spark, sf, "part").select(
        "p_partkey", text.usage_percent(size, total).alias("pct"),
        text.usage_percent(size, total, whole=True).alias("whole_pct"))


@query("x15_comma_list", "SELECT doc_id, len(string_split(text, ','))::INTEGER AS pieces FROM documents")
def _(spark, sf):
    docs = adapter.read(spark, sf, "documents")
    return docs.select("doc_id", F.size(text.comma_list(F.col("text"))).alias("pieces"))
