"""Rule evaluation, flow scores and blacklist entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywarden.functions.times import second_text
from skywarden.operators.joins import is_small, salted_join
from skywarden.operators.metrics import METRICS
from skywarden.schema import Flow, ScoreRule

# Key prefixes and lifetimes of blacklist entries.
CRAWLER_PREFIX = "CSANTI_ANTI_BLACK"
OCCUPY_PREFIX = "CSANTI_OCP_BLACK"
BLACKLIST_TTL_S = 120

_FLOW_TYPE = ("struct<flow_id:string,flow_score:double,flow_limit:double,is_up_limited:boolean,"
              "strategy_code:string,hit_rules:array<string>,hit_time:timestamp>")


def flow_score_from(n: Column, sum_all: Column, sum_on: Column, max_on: Column) -> Column:
    """Score of a flow from count and sum of all exceeded rules, and sum and maximum of the enabled ones.

    No exceeded rule, or a zero sum, gives zero.
    """
    top = F.when(max_on > 6, F.lit(60.0)).otherwise(max_on * 10.0)
    mean = F.try_divide(sum_all, n * 10.0)
    share = F.try_divide(sum_on * 40.0, sum_all)
    return F.when((n > 0) & (sum_all != 0), mean * (top + share)).otherwise(F.lit(0.0))


def flow_score(all_scores: Column, on_scores: Column) -> Column:
    """The same from two score arrays."""
    def total(scores: Column) -> Column:
        return F.aggregate(scores, F.lit(0.0), lambda a, x: a + x.cast("double"))
    top = F.when(F.size(on_scores) > 0, F.array_max(on_scores).cast("double")).otherwise(F.lit(0.0))
    return flow_score_from(F.size(all_scores), total(all_scores), total(on_scores), top)


def rule_hit(rule: ScoreRule) -> Column:
    metric = METRICS.get(rule.name)
    value = F.col(metric) if metric else F.lit(0)
    return value < F.lit(rule.limit) if rule.comparator == "<" else value > F.lit(rule.limit)


def _flow_result(flow: Flow, hit_time: Column) -> Column:
    n, sum_all, sum_on, max_on = F.lit(0), F.lit(0.0), F.lit(0.0), F.lit(0.0)
    names = []
    for rule in flow.rules:
        hit = rule_hit(rule)
        n = n + hit.cast("int")
        sum_all = sum_all + F.when(hit, F.lit(float(rule.score))).otherwise(F.lit(0.0))
        if rule.status == 0:
            score = F.when(hit, F.lit(float(rule.score))).otherwise(F.lit(0.0))
            sum_on = sum_on + score
            max_on = F.greatest(max_on, score)
            names.append(F.when(hit, F.lit(rule.name)))
    score = flow_score_from(n, sum_all, sum_on, max_on)
    hits = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return F.struct(
        F.lit(flow.flow_id).alias("flow_id"), score.alias("flow_score"), F.lit(float(flow.limit)).alias("flow_limit"),
        (score > F.lit(float(flow.limit))).alias("is_up_limited"), F.lit(flow.flow_id).alias("strategy_code"),
        hits.alias("hit_rules"), hit_time.alias("hit_time"))


def score(df: DataFrame, flows: Sequence[Flow], hit_time: Column | None = None) -> DataFrame:
    """Add ``flows_score``: one result per flow, in flow order. Needs the metric columns.

    Each rule becomes one comparison, so nothing is shuffled however many rows there are.
    """
    when = hit_time if hit_time is not None else F.col("last_seen")
    results = F.array(*[_flow_result(f, when) for f in flows]) if flows else F.array()
    return df.withColumn("flows_score", results.cast(f"array<{_FLOW_TYPE}>"))


_STEP = "struct<limit:double,n:bigint,all:double,on:double,top:double,rule_order:int,name:string,enabled:boolean>"


def _thresholds(rules: DataFrame) -> DataFrame:
    """``metric, flows``: for each flow the limits of its rules on the metric in order, each with what it and the ones
    below it add up to, so that one lookup stands for all of a flow's rules on the metric."""
    signed = rules.select(
        F.when(F.col("name").isin(*METRICS), F.col("name")).otherwise("").alias("metric"), "flow_id", "rule_order", "name",
        (F.col("comparator") == "<").alias("below"), F.col("score").cast("double").alias("score"),
        (F.col("status") == 0).alias("enabled"), F.col("limit").cast("double").alias("limit"))
    # A rule that asks for less is one that asks for more of the negative.
    signed = signed.withColumn("limit", F.when(F.col("below"), -F.col("limit")).otherwise(F.col("limit")))
    order = Window.partitionBy("metric", "flow_id", "below").orderBy("limit", "rule_order").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    on = F.when(F.col("enabled"), F.col("score")).otherwise(0.0)
    steps = signed.select(
        "metric", "flow_id", "below", F.struct(
            "limit", F.count(F.lit(1)).over(order).alias("n"), F.sum("score").over(order).alias("all"),
            F.sum(on).over(order).alias("on"), F.max(on).over(order).alias("top"), "rule_order", "name", "enabled"
        ).cast(_STEP).alias("step"))
    per_flow = steps.groupBy("metric", "flow_id").agg(*[
        F.array_sort(F.collect_list(F.when(which, F.col("step"))), lambda x, y: (x["n"] - y["n"]).cast("int")).alias(name)
        for name, which in (("above", ~F.col("below")), ("beneath", F.col("below")))])
    return per_flow.groupBy("metric").agg(F.collect_list(F.struct("flow_id", "above", "beneath")).alias("flows"))


def _below(steps: Column, value: Column) -> Column:
    """How many limits are below a value, by halving."""
    start = F.struct(F.lit(0).alias("low"), F.size(steps).alias("high"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        less = F.get(steps, middle)["limit"] < value
        return F.when(at["low"] >= at["high"], at).otherwise(F.struct(
            F.when(less, middle + 1).otherwise(at["low"]).alias("low"),
            F.when(less, at["high"]).otherwise(middle).alias("high")))

    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(F.size(steps).cast("long")))), start, halve, lambda x: x["low"])


def score_by_join(df: DataFrame, rules: DataFrame, keys: Sequence[str], hit_time: str = "last_seen",
                  lists: str = "all") -> DataFrame:
    """The same for rule sets too large to compile: one row per key and flow, equal to ``flow_rows`` of ``score``.

    ``rules`` has flow_id, flow_limit, rule_order, name, status, limit, score and, unless all are ``>``, comparator.
    Each vector unfolds to its eight metrics, which meet the sorted limits of their metric and look up what those below
    the value add up to: the rows grow with metrics and flows, not with rules. A rule on an unknown metric sees zero.
    Flows without a hit come from the list of flows and score zero. ``lists="triggered"`` makes the list of hit rules
    for results above their limit only; others get an empty one.
    """
    if lists not in ("all", "triggered"):
        raise ValueError(f"lists are made for all or for triggered results: {lists}")
    if "comparator" not in rules.columns:
        rules = rules.withColumn("comparator", F.lit(">"))
    metrics = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(col).cast("double").alias("value"))
                        for name, col in METRICS.items()],
                      F.struct(F.lit("").alias("metric"), F.lit(0.0).alias("value")))
    limits = _thresholds(rules)
    few = is_small(rules)

    def looked_up(vectors: DataFrame) -> DataFrame:
        """``keys, flow_id, above, beneath`` and the numbers of limits met, a row for each metric and flow."""
        unfolded = vectors.select(*keys, F.explode(metrics).alias("m")).select(*keys, "m.metric", "m.value")
        # A row of limits holds all rules of its metric: their number decides, not that of the rows.
        met = (unfolded.join(F.broadcast(limits), "metric") if few
               else salted_join(unfolded, limits, ["metric"], "inner", keys))
        return met.select(*keys, "value", F.explode("flows").alias("f")).select(
            *keys, "f.*", _below(F.col("f.above"), F.col("value")).alias("_up"),
            _below(F.col("f.beneath"), -F.col("value")).alias("_down"))

    def hits() -> Column:
        both = F.concat(F.slice("above", F.lit(1), F.col("_up")), F.slice("beneath", F.lit(1), F.col("_down")))
        return F.transform(F.filter(both, lambda s: s["enabled"]), lambda s: F.struct(s["rule_order"], s["name"]))

    def names(found: Column) -> Column:
        return F.transform(F.array_sort(F.flatten(F.collect_list(found))), lambda x: x["name"])

    rows = looked_up(df)
    up, down = F.get("above", F.col("_up") - 1), F.get("beneath", F.col("_down") - 1)

    def both(name: str) -> Column:
        return F.coalesce(up[name], F.lit(0)) + F.coalesce(down[name], F.lit(0))

    listed = [names(hits()).alias("hit_rules")] if lists == "all" else []
    out = rows.groupBy(*keys, "flow_id").agg(
        F.sum(both("n")).alias("_n"), F.sum(both("all")).alias("_all"), F.sum(both("on")).alias("_on"),
        F.max(F.greatest(F.coalesce(up["top"], F.lit(0.0)), F.coalesce(down["top"], F.lit(0.0)))).alias("_max"), *listed)
    out = out.withColumn("_score", flow_score_from(F.col("_n"), F.col("_all"), F.col("_on"), F.col("_max")))
    # The result has a row for every flow, so the list of flows goes along with every key.
    flows = rules.groupBy("flow_id").agg(F.first("flow_limit").alias("flow_limit")).agg(
        F.collect_list(F.struct("flow_id", "flow_limit"))).scalar()
    every = df.select(*keys, F.col(hit_time).alias("hit_time"), F.explode(flows).alias("_f")).select(
        *keys, "hit_time", "_f.*")
    score = F.coalesce("_score", F.lit(0.0))
    found = every.join(out, [*keys, "flow_id"], "left").withColumn("_up", score > F.col("flow_limit"))
    if lists == "triggered":
        over = found.where("_up").select(*keys, "flow_id")
        lookups = looked_up(df.join(over.select(*keys).distinct(), list(keys), "left_semi"))
        some = lookups.join(over, [*keys, "flow_id"], "left_semi").groupBy(*keys, "flow_id").agg(
            names(hits()).alias("hit_rules"))
        found = found.join(some, [*keys, "flow_id"], "left")
    return found.select(
        *keys, "flow_id", score.alias("flow_score"), "flow_limit", F.col("_up").alias("is_up_limited"),
        F.col("flow_id").alias("strategy_code"),
        F.coalesce("hit_rules", F.array().cast("array<string>")).alias("hit_rules"), "hit_time")


def flow_rows(scored: DataFrame) -> DataFrame:
    """One row per scored key and flow."""
    keep = [c for c in scored.columns if c != "flows_score"]
    return scored.select(*keep, F.posexplode("flows_score").alias("flow_order", "_flow")).select(
        *keep, "flow_order", "_flow.*")


def triggered(scored: DataFrame) -> DataFrame:
    """Rows in which at least one flow is above its limit."""
    return scored.where(F.exists("flows_score", lambda f: f["is_up_limited"]))


def pick_flow(flow_pick: str = "triggered") -> Column:
    """The flow an entry reports: the first above its limit, or the first of all."""
    flows = F.col("flows_score")
    if flow_pick == "first":
        return F.get(flows, F.lit(0))
    return F.get(F.filter(flows, lambda f: f["is_up_limited"]), F.lit(0))


def latest_entries(scored: DataFrame, flow_pick: str = "triggered") -> DataFrame:
    """One row per address: its most recent triggered result. Ties go to the later URL."""
    order = F.struct("last_seen", "request")
    return (triggered(scored).withColumn("_flow", pick_flow(flow_pick))
            .groupBy("remote_addr").agg(F.max_by("_flow", order).alias("_flow"), F.max("last_seen").alias("last_seen"))
            .select("remote_addr", "last_seen", "_flow.*"))


def blacklist(scored: DataFrame, ttl_s: int = BLACKLIST_TTL_S, flow_pick: str = "triggered",
              prefix: str = CRAWLER_PREFIX, written_at: Column | None = None) -> DataFrame:
    """Blacklist entries in stored form: key, packed value and expiry."""
    entries = latest_entries(scored, flow_pick)
    at = written_at if written_at is not None else F.col("last_seen")
    return entries.select(
        "remote_addr", "flow_id", "flow_score", "hit_rules", "hit_time",
        F.concat(F.lit(prefix), "remote_addr", F.lit(":"), "flow_id").alias("key"),
        F.concat_ws("|", F.col("flow_score").cast("string"), "strategy_code", F.array_join("hit_rules", ","),
                    second_text(F.col("hit_time"))).alias("value"),
        (at + F.make_dt_interval(secs=F.lit(ttl_s))).alias("expire_at"),
        at.alias("written_at"),
    ).withColumn("key_exp_time", F.unix_millis("expire_at").cast("string"))


def unpack_value(df: DataFrame, column: str = "value") -> DataFrame:
    """Packed blacklist value back to columns."""
    parts = F.split(F.col(column), r"\|")
    return df.withColumns({
        "flow_score": F.get(parts, F.lit(0)).try_cast("double"), "strategy_code": F.get(parts, F.lit(1)),
        "hit_rules": F.get(parts, F.lit(2)), "hit_time": F.get(parts, F.lit(3))})


def rule_hits_per_period(scored: DataFrame, period: str = "day") -> DataFrame:
    """How often each enabled rule was hit per period, over the triggered results."""
    return (flow_rows(scored).where("is_up_limited")
            .select(F.date_trunc(period, "last_seen").alias("period"), F.explode("hit_rules").alias("rule_name"))
            .groupBy("period", "rule_name").agg(F.count(F.lit(1)).alias("hits")))
