"""Queries on behaviour metrics, scoring, joins, funnels and the rule-form metrics."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.functions.register import register_functions
from skywarden.operators import funnel as fn
from skywarden.operators import metrics as mt
from skywarden.operators import scoring as sc
from skywarden.operators.blacklist import keep_if_absent, latest_row, newest_per_key, restore_blacklist
from skywarden.operators.joins import is_small, salted_join
from skywarden.operators.tag import critical, stage_tag
from skywarden.plans import adapter, rules
from skywarden.plans.catalog_records import _CRITICAL, STAGE_SQL
from skywarden.plans.registry import cte, query
from skywarden.plans.scoring import blacklisted, scored_vectors
from skywarden.session import work_dir

_BLOCK = ("CASE WHEN len(string_split(remote_addr, '.')) = 4 THEN concat(split_part(remote_addr, '.', 1), '.', "
          "split_part(remote_addr, '.', 2)) ELSE '' END")
cte("m", ("requests",), f"""
SELECT *, date_trunc('day', ts) AS w, epoch_us(ts) // 1000 AS ms, {_CRITICAL} AS crit, {_BLOCK} AS ip_block FROM requests""")


def _ip_sql(window: str) -> str:
    return f"""SELECT {window} AS w, remote_addr, count(*) AS ip_count, count(*) FILTER (WHERE crit) AS critical_count,
 count(DISTINCT http_user_agent) AS ua_count, count(DISTINCT concat(depcity, '->', arrcity)) AS trip_count,
 count(DISTINCT CASE WHEN crit THEN jsessionid END) AS session_count FROM m GROUP BY 1, 2"""


def _gap_sql(window: str, keys: str, limit: int) -> str:
    return f"""SELECT w, {keys}, min(g) AS min_gap_ms, count(*) FILTER (WHERE g < {limit}) AS short_gaps FROM (
 SELECT {window} AS w, {keys}, ms - lag(ms) OVER (PARTITION BY {window}, {keys} ORDER BY ms) AS g
 FROM m WHERE crit) GROUP BY ALL"""


_FIVE = "time_bucket(INTERVAL 5 MINUTES, ts)"
_HOUR = "date_trunc('hour', ts)"
_DAY = "date_trunc('day', ts)"


def _vectors_sql(window: str, limit: int) -> str:
    """All eight metrics by window, address and URL."""
    return f"""SELECT s.w, s.remote_addr, s.request, s.requests, b.ip_block_count, i.ip_count, i.critical_count, i.ua_count,
 i.trip_count, i.session_count, coalesce(g.min_gap_ms, 2147483647) AS min_gap_ms, coalesce(u.short_gaps, 0) AS short_gaps
FROM (SELECT {window} AS w, remote_addr, ip_block, request, count(*) AS requests FROM m GROUP BY ALL) s
JOIN ({_ip_sql(window)}) i ON i.w = s.w AND i.remote_addr = s.remote_addr
JOIN (SELECT {window} AS w, ip_block, count(*) AS ip_block_count FROM m GROUP BY ALL) b
 ON b.w = s.w AND b.ip_block = s.ip_block
LEFT JOIN ({_gap_sql(window, 'remote_addr', limit)}) g ON g.w = s.w AND g.remote_addr = s.remote_addr
LEFT JOIN ({_gap_sql(window, 'remote_addr, request', limit)}) u
 ON u.w = s.w AND u.remote_addr = s.remote_addr AND u.request = s.request"""


cte("ipm", ("m",), _ip_sql("w"))
cte("gaps", ("m",), _gap_sql("w", "remote_addr", rules.GAP_MS))
cte("ugaps", ("m",), _gap_sql("w", "remote_addr, request", rules.GAP_MS))
cte("blocks", ("m",), "SELECT w, ip_block, count(*) AS ip_block_count FROM m GROUP BY 1, 2")
cte("vec", ("m", "ipm", "gaps", "ugaps", "blocks"), """
SELECT s.w, s.remote_addr, s.request, s.requests, s.last_ms, ip_block_count, ip_count, critical_count, ua_count,
 trip_count, session_count, coalesce(gaps.min_gap_ms, 2147483647) AS min_gap_ms,
 coalesce(ugaps.short_gaps, 0) AS short_gaps
FROM (SELECT w, remote_addr, ip_block, request, count(*) AS requests, max(ms) AS last_ms FROM m GROUP BY ALL) s
JOIN ipm USING (w, remote_addr) JOIN blocks USING (w, ip_block) LEFT JOIN gaps USING (w, remote_addr)
LEFT JOIN ugaps USING (w, remote_addr, request)""")


def _flow_sql(order: int) -> str:
    """Score of one flow written out over the metric columns."""
    flow = rules.FLOWS[order]
    hit = {r.name: f"({mt.METRICS[r.name]} > {r.limit})" for r in flow.rules}
    on = [r for r in flow.rules if r.status == 0]
    n = " + ".join(f"{h}::INT" for h in hit.values())
    total = " + ".join(f"{hit[r.name]}::INT * {r.score}" for r in flow.rules)
    total_on = " + ".join(f"{hit[r.name]}::INT * {r.score}" for r in on)
    top = "greatest(" + ", ".join(f"{hit[r.name]}::INT * {r.score}" for r in on) + ", 0)"
    names = "concat_ws(',', " + ", ".join(f"CASE WHEN {hit[r.name]} THEN '{r.name}' END" for r in on) + ")"
    return f"""SELECT w, remote_addr, request, last_ms, {order} AS flow_order, '{flow.flow_id}' AS flow_id,
 n_hits, CASE WHEN n_hits = 0 OR sum_all = 0 THEN 0.0::DOUBLE ELSE (sum_all::DOUBLE / (n_hits * 10.0::DOUBLE)) *
 (CASE WHEN max_on > 6 THEN 60.0::DOUBLE ELSE max_on * 10.0::DOUBLE END
  + sum_on * 40.0::DOUBLE / sum_all::DOUBLE) END AS flow_score,
 {flow.limit}::DOUBLE AS flow_limit, hit_rules
FROM (SELECT *, {n} AS n_hits, {total} AS sum_all, {total_on} AS sum_on, {top} AS max_on, {names} AS hit_rules FROM vec)"""


cte("flow_rows", ("vec",), " UNION ALL ".join(f"({_flow_sql(i)})" for i in range(len(rules.FLOWS))))
# The first triggered flow of the most recent triggered result of each address.
cte("entries", ("flow_rows",), """
SELECT * FROM flow_rows WHERE flow_score > flow_limit
QUALIFY row_number() OVER (PARTITION BY remote_addr ORDER BY last_ms DESC, request DESC, flow_order) = 1""")


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.requests(spark, sf)


def _day(df: DataFrame, pattern: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumn("day", F.date_format("window_start", pattern)).drop("window_start")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return scored_vectors(_requests(spark, sf), rules.FLOWS, rules.CRITICAL, rules.WINDOW, rules.GAP_MS)


_D = "strftime(w, '%Y-%m-%d') AS day"


@query("a1_block_count", f"SELECT {_D}, ip_block, ip_block_count FROM blocks", "blocks")
def _(spark, sf):
    return _day(mt.block_metrics(_requests(spark, sf), rules.WINDOW))


def _ip_metric(name: str, column: str) -> None:
    @query(name, f"SELECT {_D}, remote_addr, {column} FROM ipm", "ipm")
    def _(spark, sf):
        counts = mt.ip_counts(_requests(spark, sf), critical(rules.CRITICAL), rules.WINDOW)
        return _day(counts).select("day", "remote_addr", column)


for _name, _column in (("a2_ip_count", "ip_count"), ("a3_critical_count", "critical_count"),
                       ("a4_agent_count", "ua_count"), ("a7_trip_count", "trip_count")):
    _ip_metric(_name, _column)


@query("a5_min_gap", f"SELECT {_D}, remote_addr, min_gap_ms FROM gaps", "gaps")
def _(spark, sf):
    return _day(mt.ip_min_gap(_requests(spark, sf), critical(rules.CRITICAL), rules.WINDOW))


@query("a6_short_gaps", f"SELECT {_D}, remote_addr, request, short_gaps FROM ugaps", "ugaps")
def _(spark, sf):
    return _day(mt.url_gap_counts(_requests(spark, sf), critical(rules.CRITICAL), rules.GAP_MS, rules.WINDOW))


@query("a8_session_count", f"SELECT {_D}, remote_addr, session_count FROM ipm WHERE critical_count > 0", "ipm")
def _(spark, sf):
    counts = mt.ip_counts(_requests(spark, sf), critical(rules.CRITICAL), rules.WINDOW)
    return _day(counts.where("critical_count > 0")).select("day", "remote_addr", "session_count")


@query("w1_consecutive_gaps", """
SELECT event_id, ms - lag(ms) OVER (PARTITION BY remote_addr ORDER BY ms, event_id) AS gap_ms FROM m""", "m")
def _(spark, sf):
    return mt.with_previous_time(_requests(spark, sf), ["remote_addr"]).select("event_id", "gap_ms")


_VEC = ("ip_block_count", "ip_count", "critical_count", "ua_count", "trip_count", "session_count", "min_gap_ms",
        "short_gaps")


@query("j1_metrics_per_request", f"SELECT event_id, {', '.join(_VEC)} FROM m JOIN vec USING (w, remote_addr, request)",
       "m", "vec")
def _(spark, sf):
    reqs = _requests(spark, sf)
    vectors = mt.metric_vectors(reqs, critical(rules.CRITICAL), rules.WINDOW, threshold_ms=rules.GAP_MS)
    out = work_dir(spark, "vectors")
    vectors.write.parquet(out)
    stored = spark.read.schema(vectors.schema).parquet(out)
    return mt.attach_metrics(reqs, stored, rules.WINDOW, spread=["event_id"]).select("event_id", *_VEC)


def _flow_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = _day(sc.flow_rows(_scored(spark, sf)))
    return rows.withColumns({"hit_rules": F.array_join("hit_rules", ","), "flow_score": F.round("flow_score", 9)})


_FR = "strftime(w, '%Y-%m-%d') AS day, remote_addr, request, flow_id"


@query("a9_flow_score", f"SELECT {_FR}, round(flow_score, 9) AS flow_score FROM flow_rows", "flow_rows")
def _(spark, sf):
    vectors = mt.metric_vectors(_requests(spark, sf), critical(rules.CRITICAL), rules.WINDOW, threshold_ms=rules.GAP_MS)

    def scores(flow, enabled_only: bool):
        wanted = [r for r in flow.rules if r.status == 0 or not enabled_only]
        return F.array_compact(F.array(*[F.when(sc.rule_hit(r), F.lit(float(r.score))) for r in wanted]))

    per_flow = F.array(*[F.struct(F.lit(f.flow_id).alias("flow_id"), scores(f, False).alias("all"),
                                  scores(f, True).alias("on")) for f in rules.FLOWS])
    rows = _day(vectors).select("day", "remote_addr", "request", F.explode(per_flow).alias("f"))
    return rows.select("day", "remote_addr", "request", "f.flow_id",
                       F.round(sc.flow_score(F.col("f.all"), F.col("f.on")), 9).alias("flow_score"))


@query("a10_rule_hits", f"SELECT {_FR}, hit_rules FROM flow_rows", "flow_rows")
def _(spark, sf):
    return _flow_rows(spark, sf).select("day", "remote_addr", "request", "flow_id", "hit_rules")


@query("a11_flow_result", f"""
SELECT {_FR}, round(flow_score, 9) AS flow_score, flow_limit, flow_score > flow_limit AS is_up_limited,
 last_ms AS hit_ms FROM flow_rows""", "flow_rows")
def _(spark, sf):
    return _flow_rows(spark, sf).select(
        "day", "remote_addr", "request", "flow_id", "flow_score", "flow_limit", "is_up_limited",
        F.unix_millis("hit_time").alias("hit_ms"))


@query("f4_triggered", f"""
SELECT DISTINCT {_D}, remote_addr, request FROM flow_rows WHERE flow_score > flow_limit""", "flow_rows")
def _(spark, sf):
    return _day(sc.triggered(_scored(spark, sf))).select("day", "remote_addr", "request")


@query("a12_latest_entry", """
SELECT remote_addr, flow_id, round(flow_score, 9) AS flow_score, hit_rules, last_ms AS hit_ms FROM entries""", "entries")
def _(spark, sf):
    return sc.latest_entries(_scored(spark, sf)).select(
        "remote_addr", "flow_id", F.round("flow_score", 9).alias("flow_score"),
        F.array_join("hit_rules", ",").alias("hit_rules"), F.unix_millis("hit_time").alias("hit_ms"))


@query("p33_blacklist_record", f"""
SELECT concat('{sc.CRAWLER_PREFIX}', remote_addr, ':', flow_id) AS key, (last_ms + 120000)::VARCHAR AS key_exp_time,
 concat_ws('|', flow_id, hit_rules, strftime(make_timestamp(last_ms * 1000), '%Y-%m-%d %H:%M:%S')) AS value_rest,
 round(flow_score, 9) AS flow_score FROM entries""", "entries")
def _(spark, sf):
    rows = blacklisted(_requests(spark, sf), rules.FLOWS, rules.CRITICAL, rules.WINDOW, rules.GAP_MS)
    return rows.select(
        "key", "key_exp_time", F.expr("substring(value, instr(value, '|') + 1)").alias("value_rest"),
        F.round(F.substring_index("value", "|", 1).cast("double"), 9).alias("flow_score"))


def _rule_table(spark: SparkSession) -> DataFrame:
    rows = [(f.flow_id, float(f.limit), i, r.name, r.status, float(r.limit), r.score, r.comparator)
            for f in rules.FLOWS for i, r in enumerate(f.rules)]
    return spark.createDataFrame(rows, "flow_id string, flow_limit double, rule_order int, name string, status int, "
                                       "limit double, score int, comparator string")


@query("j7_rules_by_join", f"""
SELECT {_FR}, round(flow_score, 9) AS flow_score, flow_limit, flow_score > flow_limit AS is_up_limited, hit_rules,
 last_ms AS hit_ms FROM flow_rows""", "flow_rows")
def _(spark, sf):
    vectors = mt.metric_vectors(_requests(spark, sf), critical(rules.CRITICAL), rules.WINDOW, threshold_ms=rules.GAP_MS)
    rows = sc.score_by_join(_day(vectors), _rule_table(spark), ["day", "remote_addr", "request"])
    return rows.select("day", "remote_addr", "request", "flow_id", F.round("flow_score", 9).alias("flow_score"),
                       "flow_limit", "is_up_limited", F.array_join("hit_rules", ",").alias("hit_rules"),
                       F.unix_millis("hit_time").alias("hit_ms"))


@query("g2_five_minute_metrics", f"""
SELECT strftime(i.w, '%Y-%m-%d %H:%M') AS window_at, remote_addr, ip_count, critical_count, ua_count, trip_count,
 session_count, min_gap_ms FROM ({_ip_sql(_FIVE)}) i
LEFT JOIN ({_gap_sql(_FIVE, 'remote_addr', 5000)}) g USING (w, remote_addr)""", "m")
def _(spark, sf):
    out = mt.ip_metrics(_requests(spark, sf), critical(rules.CRITICAL), "5 minutes")
    return out.withColumn("window_at", F.date_format("window_start", "yyyy-MM-dd HH:mm")).drop("window_start")


@query("g2_five_minute_vectors", f"""
SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_at, * EXCLUDE (w) FROM ({_vectors_sql(_FIVE, 5000)})""", "m")
def _(spark, sf):
    """All eight metrics, merged from slice states."""
    from skywarden.operators import slices

    parts = slices.partials(slices.slice_states(_requests(spark, sf), "5 minutes"), critical(rules.CRITICAL))
    return slices.vectors_of(parts).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_at"), "remote_addr", "request", "requests", *_VEC)


@query("g2_sliding_counts", """
SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_at, remote_addr, count(*) AS ip_count FROM (
 SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS w, remote_addr FROM m
 UNION ALL SELECT time_bucket(INTERVAL 5 MINUTES, ts) - INTERVAL 5 MINUTES, remote_addr FROM m) GROUP BY 1, 2""", "m")
def _(spark, sf):
    counts = mt.ip_counts(_requests(spark, sf), critical(rules.CRITICAL), "10 minutes", "5 minutes")
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_at"), "remote_addr", "ip_count")


@query("g2_whole_input_metrics", """
SELECT remote_addr, count(*) AS ip_count, count(DISTINCT http_user_agent) AS ua_count, min(g) AS min_gap_ms FROM (
 SELECT *, CASE WHEN crit THEN ms - lag(ms) OVER (PARTITION BY remote_addr, crit ORDER BY ms) END AS g FROM m)
GROUP BY 1""", "m")
def _(spark, sf):
    return mt.ip_metrics(_requests(spark, sf), critical(rules.CRITICAL)).select(
        "remote_addr", "ip_count", "ua_count", "min_gap_ms")


@query("n1_hourly_metrics", f"""
SELECT strftime(w, '%Y-%m-%d %H') AS hour, * EXCLUDE (w) FROM ({_vectors_sql(_HOUR, rules.GAP_MS)})""", "m")
def _(spark, sf):
    vectors = mt.metric_vectors(_requests(spark, sf), critical(rules.CRITICAL), "1 hour", threshold_ms=rules.GAP_MS)
    return _day(vectors, "yyyy-MM-dd HH").withColumnRenamed("day", "hour").select(
        "hour", "remote_addr", "request", "requests", *_VEC)


_KEYS = {"block": "ip_block", "purchaser": "userid", "name": "contact_name", "phone": "contact_phone",
         "passenger": "passenger", "name_phone": "name_phone"}


def _per_key_sql(where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, strftime(w, '%Y-%m-%d') AS day, {col} AS key_value, count(*) AS n FROM "
        f"(SELECT *, concat(contact_name, '/', contact_phone) AS name_phone FROM m) WHERE {where} GROUP BY ALL"
        for kind, col in _KEYS.items())


def _per_key(df: DataFrame) -> DataFrame:
    src = df.withColumns({"ip_block": mt.ip_block(F.col("remote_addr")),
                          "name_phone": F.concat_ws("/", "contact_name", "contact_phone")})
    keys = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(col).cast("string").alias("key_value"))
                     for kind, col in _KEYS.items()])
    unfolded = src.select("event_time", F.explode(keys).alias("k")).select("event_time", "k.*")
    return _day(mt.key_counts(unfolded, ["kind", "key_value"], "1 day")).select("kind", "day", "key_value", "n")


@query("n2_bookings_per_key", _per_key_sql("behavior_type = 'Book'"), "m")
def _(spark, sf):
    return _per_key(_requests(spark, sf).where("behavior_type = 'Book'"))


@query("n3_payments_per_key", _per_key_sql("request = '/upp_payment/pay/p'"), "m")
def _(spark, sf):
    return _per_key(_requests(spark, sf).where(stage_tag(F.col("request")) == "3"))


@query("n4_booked_not_paid", """
SELECT strftime(w, '%Y-%m-%d') AS day, userid, count(*) AS n FROM m b WHERE behavior_type = 'Book'
AND NOT EXISTS (SELECT 1 FROM m p WHERE p.w = b.w AND p.userid = b.userid AND p.request = '/upp_payment/pay/p')
GROUP BY 1, 2""", "m")
def _(spark, sf):
    reqs = _requests(spark, sf)
    return _day(mt.without_follow_up(reqs.where("behavior_type = 'Book'"),
                                     reqs.where(stage_tag(F.col("request")) == "3"), ["userid"], "1 day"))


# --- spider tag and funnel ---

cte("listed", ("spiders",), "SELECT remote_addr, min(flow_id) AS flow_id FROM spiders GROUP BY 1")
cte("funnel", ("requests", "listed"), f"""
SELECT r.*, {STAGE_SQL} AS stage, NOT contains(jsessionid, 'NULL') AS has_session, l.flow_id,
 CASE WHEN l.flow_id IS NULL OR lower(l.flow_id) = 'null' THEN '0' ELSE '1' END AS spider
FROM requests r LEFT JOIN listed l USING (remote_addr)""")


def _conv(step: int, where: str = "true") -> str:
    return (f"(count(*) FILTER (WHERE stage = '{step}' AND has_session AND {where}))::DOUBLE / "
            f"nullif(count(*) FILTER (WHERE stage = '{step - 1}' AND {where}), 0)")


def _counts(spark: SparkSession, sf: str, by=()) -> DataFrame:
    reqs = _requests(spark, sf).withColumn("day", F.to_date("event_time"))
    return fn.stage_counts(reqs, adapter.spiders(spark, sf), by)


@query("j2_spider_join_left", "SELECT event_id, flow_id FROM funnel", "funnel")
def _(spark, sf):
    return fn.tag_spiders(_requests(spark, sf), adapter.spiders(spark, sf), spread=["event_id"]).select(
        "event_id", "flow_id")


@query("j2_spider_join_inner", "SELECT event_id, flow_id FROM funnel WHERE flow_id IS NOT NULL", "funnel")
def _(spark, sf):
    return fn.tag_spiders(_requests(spark, sf), adapter.spiders(spark, sf), "inner", spread=["event_id"]).select(
        "event_id", "flow_id")


@query("j10_membership", """
SELECT event_id, 'listed' AS side FROM requests WHERE remote_addr IN (SELECT remote_addr FROM spiders)
UNION ALL SELECT event_id, 'other' FROM requests WHERE remote_addr NOT IN (SELECT remote_addr FROM spiders)""",
       "requests", "spiders")
def _(spark, sf):
    reqs = _requests(spark, sf).select("event_id", "remote_addr")
    listed = adapter.spiders(spark, sf).select("remote_addr").distinct()
    # The list goes to every executor only when it is counted as small.
    if is_small(listed):
        semi = reqs.join(F.broadcast(listed), "remote_addr", "left_semi")
        anti = reqs.join(F.broadcast(listed), "remote_addr", "left_anti")
    else:
        semi = salted_join(reqs, listed, ["remote_addr"], "left_semi", ["event_id"])
        anti = salted_join(reqs, listed, ["remote_addr"], "left_anti", ["event_id"])
    return (semi.select("event_id", F.lit("listed").alias("side"))
            .unionByName(anti.select("event_id", F.lit("other").alias("side"))))


@query("f6_stage_filters", """
SELECT flight_type, spider, stage, count(*) AS n, count(*) FILTER (WHERE has_session) AS n_session FROM funnel
GROUP BY ALL""", "funnel")
def _(spark, sf):
    counts = _counts(spark, sf, ["flight_type"])
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"stage{s}").alias("n"),
                                F.col(f"stage{s}_session").alias("n_session")) for s in "0123"])
    return (counts.select("flight_type", F.col("spider_tag").alias("spider"), F.explode(stages).alias("x"))
            .select("flight_type", "spider", "x.*").where("n > 0"))


@query("a17_flight_conversion", f"""
SELECT flight_type, {_conv(2)} AS select_to_info, {_conv(3)} AS info_to_pay FROM funnel GROUP BY 1""", "funnel")
def _(spark, sf):
    return fn.flight_conversion(_counts(spark, sf, ["flight_type"]))


def _by_tag_sql(expr: str, name: str) -> str:
    return (f"SELECT spider AS spider_tag, {expr} AS {name} FROM funnel GROUP BY 1 "
            f"UNION ALL SELECT 'all', {expr} FROM funnel")


@query("a18_select_conversion", _by_tag_sql(_conv(2), "select_to_info"), "funnel")
def _(spark, sf):
    return fn.funnel(_counts(spark, sf)).select("spider_tag", "select_to_info")


@query("a19_pay_conversion", _by_tag_sql(_conv(3), "info_to_pay"), "funnel")
def _(spark, sf):
    return fn.funnel(_counts(spark, sf)).select("spider_tag", "info_to_pay")


@query("a20_spider_trips", """
SELECT flight_type, travel_type, count(*) AS n FROM funnel WHERE spider = '1' AND has_session GROUP BY 1, 2""", "funnel")
def _(spark, sf):
    return fn.spider_trips(_requests(spark, sf), adapter.spiders(spark, sf))


_RATIO = """(CASE WHEN spider = '1' THEN count(*) FILTER (WHERE stage = '1' AND has_session)
 ELSE count(*) FILTER (WHERE stage = '1') END)::DOUBLE / nullif(count(*) FILTER (WHERE stage = '0'), 0)"""


@query("a21_query_book_ratio", f"""
SELECT spider AS spider_tag, {_RATIO} AS query_book_ratio FROM funnel GROUP BY 1""", "funnel")
def _(spark, sf):
    return fn.query_book(_counts(spark, sf))


@query("a22_volumes", _by_tag_sql("count(*)", "requests"), "funnel")
def _(spark, sf):
    return fn.volumes(_counts(spark, sf))


@query("d1_stage_function", "SELECT event_id, stage FROM funnel", "funnel")
def _(spark, sf):
    register_functions(spark)
    _requests(spark, sf).createOrReplaceTempView("site_requests")
    return spark.sql("SELECT event_id, Stage(request) AS stage FROM site_requests")


@query("d2_spider_function", "SELECT event_id, spider FROM funnel", "funnel")
def _(spark, sf):
    register_functions(spark)
    fn.tag_spiders(_requests(spark, sf), adapter.spiders(spark, sf), spread=["event_id"]).createOrReplaceTempView(
        "site_tagged")
    return spark.sql("SELECT event_id, Spider(flow_id) AS spider FROM site_tagged")


@query("d3_native_columns", """
SELECT spider, stage, count(*) AS n FROM funnel GROUP BY 1, 2""", "funnel")
def _(spark, sf):
    register_functions(spark)
    fn.tag_spiders(_requests(spark, sf), adapter.spiders(spark, sf), spread=["event_id"]).createOrReplaceTempView(
        "site_tagged")
    return spark.sql("SELECT Spider(flow_id) AS spider, Stage(request) AS stage, count(*) AS n FROM site_tagged "
                     "GROUP BY 1, 2")


# --- blacklist life cycle ---

# One backup row per noisy request: the same key is written again and again with a later expiry.
cte("backup", ("m",), """
SELECT (ms // 1000 * 1000 + 7200000)::VARCHAR AS key_exp_time, concat('CSANTI_ANTI_BLACK', remote_addr, ':f', user_id % 2) AS key,
 concat('45.0|f', user_id % 2, '|ip|', event_id) AS value FROM m WHERE crit""")
_NOW_MS = 1704067200000 + 29 * 86400000 + 20 * 3600000


def _backup(spark: SparkSession, sf: str) -> DataFrame:
    ms = F.unix_millis("event_time")
    marked = _requests(spark, sf).where(critical(rules.CRITICAL))
    return marked.select(
        (ms - ms % 1000 + 7_200_000).cast("string").alias("key_exp_time"),
        F.expr("concat('CSANTI_ANTI_BLACK', remote_addr, ':f', user_id % 2)").alias("key"),
        F.expr("concat('45.0|f', user_id % 2, '|ip|', event_id)").alias("value"))


@query("j3_newest_backup", """
SELECT b.key_exp_time, b.key, b.value FROM backup b JOIN (SELECT key, max(key_exp_time) AS key_exp_time FROM backup
 GROUP BY 1) g USING (key, key_exp_time)""", "backup")
def _(spark, sf):
    return newest_per_key(_backup(spark, sf))


@query("f7_still_valid", f"""
SELECT key, value, (key_exp_time::BIGINT - {_NOW_MS}) // 1000 AS ttl_s FROM backup
WHERE key_exp_time::BIGINT - {_NOW_MS} >= 1000 AND key NOT LIKE '%:f0'""", "backup")
def _(spark, sf):
    from skywarden.operators.blacklist import still_valid

    rows = _backup(spark, sf)
    current = rows.where(F.col("key").endswith(":f0")).select("key").distinct()
    return keep_if_absent(still_valid(rows, F.lit(_NOW_MS)), current, ["key"]).select("key", "value", "ttl_s")


@query("u3_keep_if_absent", """
SELECT key, max(key_exp_time) AS key_exp_time FROM backup WHERE key NOT LIKE '%10.1.%' GROUP BY 1""", "backup")
def _(spark, sf):
    rows = _backup(spark, sf)
    current = rows.where(F.col("key").contains("10.1.")).select("key").distinct()
    new = rows.groupBy("key").agg(F.max("key_exp_time").alias("key_exp_time"))
    return keep_if_absent(new, current, ["key"])


@query("g5_restore_switch", f"""
SELECT b.key, b.value, 'on' AS mode FROM backup b JOIN (SELECT key, max(key_exp_time) AS key_exp_time FROM backup
 GROUP BY 1) g USING (key, key_exp_time) WHERE key_exp_time::BIGINT - {_NOW_MS} >= 1000
 AND b.key NOT LIKE '%:f0'""", "backup")
def _(spark, sf):
    rows = _backup(spark, sf)
    current = rows.where(F.col("key").endswith(":f0")).select("key").distinct()
    on = restore_blacklist(rows, current, F.lit(_NOW_MS), True).select("key", "value", F.lit("on").alias("mode"))
    off = restore_blacklist(rows, current, F.lit(_NOW_MS), False).select("key", "value", F.lit("off").alias("mode"))
    return on.unionByName(off)


@query("w2_latest_per_address", """
SELECT remote_addr, arg_max(event_id, (ms, event_id)) AS event_id, max(ms) AS ms FROM m GROUP BY 1""", "m")
def _(spark, sf):
    rows = _requests(spark, sf).select("remote_addr", "event_id", F.unix_millis("event_time").alias("ms"))
    return latest_row(rows, ["remote_addr"], ["ms", "event_id"])
