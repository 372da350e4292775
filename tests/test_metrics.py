"""Metrics, joins, scoring and funnel against brute force and hand goldens."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skywarden.operators import funnel as fn
from skywarden.operators import joins
from skywarden.operators import metrics as mt
from skywarden.operators import scoring as sc
from skywarden.operators.blacklist import latest_row, newest_per_key, restore_blacklist
from skywarden.operators.tag import critical
from skywarden.plans import rules
from skywarden.plans.scoring import scored_vectors
from skywarden.schema import Flow, ScoreRule

COLUMNS = ("event_id long, event_time timestamp, remote_addr string, request string, http_user_agent string, "
           "depcity string, arrcity string, jsessionid string")
URLS = ["/a/query.ao", "/b/bookingnew/x", "/static"]


def sample(spark, n=600, seed=1, span_ms=1_500_000):
    """Requests in which one address holds most rows and many share a millisecond."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ms = 1_704_067_200_000 + rnd.randrange(span_ms) // rnd.choice([1, 1, 997]) 
        ip = "10.0.0.1" if rnd.random() < 0.6 else f"10.{rnd.randrange(3)}.0.{rnd.randrange(4)}"
        rows.append((i, ms, ip, rnd.choice(URLS), f"UA{rnd.randrange(4)}", f"C{rnd.randrange(3)}",
                     f"C{rnd.randrange(3)}", f"S{rnd.randrange(5)}"))
    df = spark.createDataFrame(rows, COLUMNS.replace("event_time timestamp", "ms long"))
    return rows, df.withColumn("event_time", F.timestamp_millis("ms")).drop("ms")


def is_critical(row):
    return row[3] != "/static"


def gaps_of(times):
    times = sorted(times)
    return [b - a for a, b in zip(times, times[1:])]


@pytest.mark.parametrize("slice_ms", [1000, 60_000, mt.SLICE_MS])
@pytest.mark.parametrize("threshold", [0, 5000])
def test_gaps_against_brute_force(spark, slice_ms, threshold):
    rows, df = sample(spark)
    by_key = defaultdict(list)
    for r in rows:
        by_key[r[2]].append(r[1])
    want = {k: (min(gaps_of(v), default=None), sum(g < threshold for g in gaps_of(v))) for k, v in by_key.items()}
    got = mt.gap_stats(df, ["remote_addr"], threshold, slice_ms=slice_ms).collect()
    assert {r.remote_addr: (r.min_gap_ms, r.short_gaps) for r in got} == want


def test_gap_goldens(spark):
    df = spark.createDataFrame([(t, "i") for t in (0, 1000, 7000)] + [(5, "one")], "ms long, remote_addr string"
                               ).withColumn("event_time", F.timestamp_millis("ms"))
    got = {r.remote_addr: (r.min_gap_ms, r.short_gaps) for r in mt.gap_stats(df, ["remote_addr"]).collect()}
    assert got == {"i": (1000, 1), "one": (None, 0)}


@pytest.mark.parametrize("slice_ms", [1000, mt.SLICE_MS])
def test_previous_times(spark, slice_ms):
    rows, df = sample(spark, 300)
    want = {}
    by_key = defaultdict(list)
    for r in rows:
        by_key[r[2]].append((r[1], r[0]))
    for v in by_key.values():
        v.sort()
        want[v[0][1]] = None
        want.update({b[1]: b[0] - a[0] for a, b in zip(v, v[1:])})
    got = mt.with_previous_time(df, ["remote_addr"], slice_ms=slice_ms).collect()
    assert {r.event_id: r.gap_ms for r in got} == want


def vectors_by_hand(rows, window_ms):
    ips, urls, blocks = defaultdict(list), defaultdict(list), defaultdict(int)
    for r in rows:
        w = r[1] // window_ms
        ips[w, r[2]].append(r)
        urls[w, r[2], r[3]].append(r)
        blocks[w, ".".join(r[2].split(".")[:2])] += 1
    out = {}
    for (w, ip, url), group in urls.items():
        mine = ips[w, ip]
        crit = [r for r in mine if is_critical(r)]
        out[w, ip, url] = {
            "requests": len(group), "ip_block_count": blocks[w, ".".join(ip.split(".")[:2])], "ip_count": len(mine),
            "critical_count": len(crit), "ua_count": len({r[4] for r in mine}),
            "trip_count": len({(r[5], r[6]) for r in mine}), "session_count": len({r[7] for r in crit}),
            "min_gap_ms": min(gaps_of([r[1] for r in crit]), default=mt.MAX_INT),
            "short_gaps": sum(g < 5000 for g in gaps_of([r[1] for r in group])) if is_critical(group[0]) else 0}
    return out


@pytest.mark.parametrize("weighted", [False, True])
def test_vectors_against_brute_force(spark, weighted):
    rows, df = sample(spark)
    want = vectors_by_hand(rows, 300_000)
    src = mt.cells(df, "5 minutes") if weighted else df
    got = mt.metric_vectors(src, critical(rules.CRITICAL), "5 minutes", weight="n" if weighted else None).collect()
    assert {(int(r.window_start.timestamp()) // 300, r.remote_addr, r.request): {k: r[k] for k in next(iter(want.values()))}
            for r in got} == want


def test_attached_metrics_keep_every_row(spark):
    rows, df = sample(spark)
    want = vectors_by_hand(rows, 300_000)
    vectors = mt.metric_vectors(df, critical(rules.CRITICAL), "5 minutes")
    got = mt.attach_metrics(df, vectors, "5 minutes", spread=["event_id"]).collect()
    assert len(got) == len(rows)
    by_id = {r.event_id: r for r in got}
    for row in rows:
        assert by_id[row[0]].short_gaps == want[row[1] // 300_000, row[2], row[3]]["short_gaps"]


def test_salted_joins_equal_plain_joins(spark):
    big = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    sizes = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for how in ("inner", "left"):
        want = sorted(big.join(small, "k", how).select("id", "k", "v").collect())
        assert sorted(joins.salted_join(big, small, ["k"], how, ["id"]).select("id", "k", "v").collect()) == want
        skew = joins.skew_join(big, small, ["k"], how, ["id"], sizes, "n", share=10)
        assert sorted(skew.select("id", "k", "v").collect()) == want
        assert sorted(joins.sized_join(big, small, ["k"], how, ["id"], 10).select("id", "k", "v").collect()) == want
    assert joins.hot_keys(sizes, ["k"], "n", share=10).collect() == [(0,)]
    for how in ("left_semi", "left_anti"):
        want = sorted(big.join(small, "k", how).collect())
        assert sorted(joins.salted_join(big, small, ["k"], how, ["id"]).select("id", "k").collect()) == sorted(
            (r.id, r.k) for r in want)
    with pytest.raises(ValueError):
        joins.salted_join(big, small, ["k"], "full_outer", ["id"])


GOLDEN = [([6, 8], [6, 8], 70.0), ([6, 8], [6], 54.0), ([5], [5], 45.0), ([7, 3, 2], [3, 2], 18.666667), ([4], [], 0.0),
          ([], [], 0.0), ([0], [0], 0.0)]


@pytest.mark.parametrize("scores, enabled, want", GOLDEN)
def test_flow_score_goldens(spark, scores, enabled, want):
    df = spark.createDataFrame([([float(x) for x in scores], [float(x) for x in enabled])], "a array<double>, b array<double>")
    assert df.select(sc.flow_score(F.col("a"), F.col("b")).alias("s")).first().s == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("scores, enabled, want", GOLDEN)
def test_compiled_flow_goldens(spark, scores, enabled, want):
    """The same figures through compiled rules: rules are hit by a metric of 1 above a limit of 0."""
    left = list(enabled)
    flow = Flow("f", "f", 10.0, tuple(
        ScoreRule("ip", 0 if s in left and not left.remove(s) else 1, 0, 0, s) for s in scores))
    vec = {c: 1 for c in mt.METRICS.values()}
    df = spark.createDataFrame([tuple(vec.values())], list(vec)).withColumn("last_seen", F.lit("2024-01-01").cast("timestamp"))
    result = sc.score(df, [flow]).first().flows_score[0]
    assert result.flow_score == pytest.approx(want, abs=1e-6)
    assert result.is_up_limited == (want > 10.0) and len(result.hit_rules) == len(enabled)


def test_rule_details(spark):
    flow = Flow("f", "f", 0.0, (ScoreRule("criticalPagesLessThanDefault", 0, 100, 1, 5),
                                ScoreRule("criticalPagesAccTime", 0, 10, 0, 3, "<"), ScoreRule("unknown", 0, -1, 0, 2)))
    vec = dict.fromkeys(mt.METRICS.values(), 2)
    df = spark.createDataFrame([tuple(vec.values())], list(vec)).withColumn("last_seen", F.lit("2024-01-01").cast("timestamp"))
    assert sc.score(df, [flow]).first().flows_score[0].hit_rules == [
        "criticalPagesLessThanDefault", "criticalPagesAccTime", "unknown"]


def test_rule_forms_agree(spark):
    _, df = sample(spark)
    flows = [Flow("f1", "a", 20.0, (ScoreRule("ip", 0, 3, 0, 6), ScoreRule("userAgent", 1, 1, 0, 5),
                                    ScoreRule("flightQuery", 0, 2, 0, 4), ScoreRule("unknown", 0, -1, 0, 2))),
             Flow("f3", "c", 1.0, (ScoreRule("criticalPagesAccTime", 0, 60_000, 0, 8, "<"),)),
             Flow("f2", "b", 5.0, (ScoreRule("criticalPagesLessThanDefault", 0, 0, 1, 9),))]
    scored = scored_vectors(df, flows, rules.CRITICAL)
    keys = ["window_start", "remote_addr", "request"]
    rows = [(f.flow_id, f.limit, i, r.name, r.status, float(r.limit), r.score, r.comparator)
            for f in flows for i, r in enumerate(f.rules)]
    table = spark.createDataFrame(rows, "flow_id string, flow_limit double, rule_order int, name string, status int, "
                                        "limit double, score int, comparator string")
    joined = {(*[r[k] for k in keys], r.flow_id): (round(r.flow_score, 9), r.hit_rules)
              for r in sc.score_by_join(scored.drop("flows_score"), table, keys).collect()}
    compiled = {(*[r[k] for k in keys], r.flow_id): (round(r.flow_score, 9), r.hit_rules)
                for r in sc.flow_rows(scored).collect()}
    assert joined == compiled and any(v == (0.0, []) for v in joined.values())
    # A score lies between zero and ten times the mean score of the exceeded rules.
    assert all(0 <= s <= 10 * 9 for s, _ in compiled.values())


def test_flow_pick(spark):
    flows = [Flow("quiet", "a", 1e9, (ScoreRule("ip", 0, 0, 0, 6),)), Flow("loud", "b", 1.0, (ScoreRule("ip", 0, 0, 0, 6),))]
    _, df = sample(spark, 50)
    scored = scored_vectors(df, flows, rules.CRITICAL)
    assert {r.flow_id for r in sc.latest_entries(scored).collect()} == {"loud"}
    assert {r.flow_id for r in sc.latest_entries(scored, "first").collect()} == {"quiet"}


def test_blacklist_record(spark):
    flows = [Flow("f1", "a", 1.0, (ScoreRule("ip", 0, 0, 0, 6), ScoreRule("userAgent", 0, 0, 0, 8)))]
    df = spark.createDataFrame([(1, "10.0.0.9", "/query.ao", "UA", "a", "b", "s")], "event_id int, remote_addr string, "
                               "request string, http_user_agent string, depcity string, arrcity string, jsessionid string"
                               ).withColumn("event_time", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    row = sc.blacklist(scored_vectors(df, flows, rules.CRITICAL)).first()
    assert row.key == "CSANTI_ANTI_BLACK10.0.0.9:f1"
    assert row.value == "70.0|f1|ip,userAgent|2024-01-01 10:00:00"
    assert int(row.key_exp_time) == 1704103200000 + 120_000
    back = sc.unpack_value(spark.createDataFrame([(row.value,)], "value string")).first()
    assert (back.flow_score, back.strategy_code, back.hit_rules) == (70.0, "f1", "ip,userAgent")


def test_restore(spark):
    backup = spark.createDataFrame([("2000", "a", "old"), ("9000", "a", "new"), ("9000", "a", "tie"), ("3000", "b", "gone"),
                                    ("9999", "c", "there"), ("1999", "d", "short")],
                                   "key_exp_time string, key string, value string")
    current = spark.createDataFrame([("c",)], "key string")
    rows = restore_blacklist(backup, current, F.lit(2500)).collect()
    assert sorted((r.key, r.value, r.ttl_s) for r in rows) == [("a", "new", 6), ("a", "tie", 6)]
    assert restore_blacklist(backup, current, F.lit(2500), restore=False).count() == 0
    assert {r.key: r.key_exp_time for r in newest_per_key(backup).collect()}["d"] == "1999"


def test_latest_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, t int, v string")
    assert sorted(latest_row(df, ["k"], ["t"]).collect()) == [("a", 2, "y"), ("b", 1, None)]


def funnel_rows(spark):
    rows = [("1", "/bookingnew/x", "S1", "National", "OneWay"), ("1", "/modules/permissionnew/p", "S1", "National", "OneWay"),
            ("1", "/modules/permissionnew/p", "NULL", "National", "OneWay"), ("2", "/bookingnew/x", "NULL", "Internatinal", "RoundTrip"),
            ("2", "/x/bookingnew/x", "S2", "International", "RoundTrip"), ("2", "/q", "S2", "National", "OneWay")]
    reqs = spark.createDataFrame([(r[0], "/a" + r[1], *r[2:]) for r in rows],
                                 "remote_addr string, request string, jsessionid string, flight_type string, travel_type string")
    spiders = spark.createDataFrame([("1", "F1"), ("1", "F2"), ("9", "F1")], "remote_addr string, flow_id string")
    return reqs, spiders


def test_spider_join_forms(spark):
    reqs, spiders = funnel_rows(spark)
    assert fn.tag_spiders(reqs, spiders).count() == 6
    assert fn.tag_spiders(reqs, spiders, "inner").count() == 3
    # As the old job ran it: addresses listed twice double their requests.
    assert fn.tag_spiders(reqs, spiders, "inner", dedup=False).count() == 6


def test_funnel_rates(spark):
    reqs, spiders = funnel_rows(spark)
    counts = fn.stage_counts(reqs, spiders, ["flight_type"])
    got = {r.flight_type: r.select_to_info for r in fn.flight_conversion(counts).collect()}
    assert got == {"National": 1.0, "International": 0.0}
    tags = {r.spider_tag: r.select_to_info for r in fn.funnel(counts).collect()}
    assert tags == {"1": 1.0, "0": 0.0, "all": pytest.approx(1 / 3)}
    both = {r.spider_tag: r.select_to_info for r in fn.funnel(counts, session_filter="both").collect()}
    assert both == {"1": 1.0, "0": 0.0, "all": 0.5}
    assert {r.spider_tag: r.requests for r in fn.volumes(counts).collect()} == {"1": 3, "0": 3, "all": 6}
    # No spider ever queried, so there is no ratio; normal users count bookings without a session too.
    assert {r.spider_tag: r.query_book_ratio for r in fn.query_book(counts).collect()} == {"1": None, "0": 2.0}
    trips = fn.spider_trips(reqs, spiders).collect()
    assert [(r.flight_type, r.travel_type, r.n) for r in trips] == [("National", "OneWay", 2)]


def test_keys_without_follow_up(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "userid string, d int")
    paid = spark.createDataFrame([("b", 1)], "userid string, d int")
    assert [(r.userid, r.n) for r in mt.without_follow_up(df, paid, ["userid"]).collect()] == [("a", 2)]


def test_many_rules_by_join_look_up_sorted_limits(spark):
    """3,000 rules of 3 flows with repeated limits of both kinds, one by one and by sorted limits."""
    rnd = random.Random(8)
    _, df = sample(spark, 200)
    vectors = mt.metric_vectors(df, critical(rules.CRITICAL), "5 minutes").cache()
    names = [*mt.METRICS, "unknown"]
    table = [(f"f{i % 3}", 20.0 + 3 * (i % 3), i, rnd.choice(names), rnd.choice([0, 0, 1]), float(rnd.randrange(0, 60)),
              rnd.randrange(0, 9), rnd.choice("><")) for i in range(3000)]
    keys = ["window_start", "remote_addr", "request"]
    want = {}
    for v in vectors.collect():
        for flow in ("f0", "f1", "f2"):
            hit = [r for r in table if r[0] == flow and (
                (lambda x: x < r[5] if r[7] == "<" else x > r[5])(v[mt.METRICS[r[3]]] if r[3] in mt.METRICS else 0))]
            total, on = sum(r[6] for r in hit), [r[6] for r in hit if r[4] == 0]
            score = total / (10 * len(hit)) * ((60 if max(on) > 6 else max(on) * 10) + 40 * sum(on) / total) if total and on else 0
            want[(*[v[k] for k in keys], flow)] = (round(score, 6), [r[3] for r in hit if r[4] == 0])
    rows = spark.createDataFrame(table, "flow_id string, flow_limit double, rule_order int, name string, status int, "
                                        "limit double, score int, comparator string")
    out = sc.score_by_join(vectors, rows, keys)
    assert {(*[r[k] for k in keys], r.flow_id): (round(r.flow_score, 6), r.hit_rules) for r in out.collect()} == want
    some = sc.score_by_join(vectors, rows, keys, lists="triggered").collect()
    assert {(*[r[k] for k in keys], r.flow_id): r.hit_rules for r in some} == {
        k: names if score > 20 + 3 * int(k[-1][1]) else [] for k, (score, names) in want.items()}
    # What is looked up has a row for each vector, metric and flow, however many rules there are.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
