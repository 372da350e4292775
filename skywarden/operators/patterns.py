"""Matching texts against tables of regular expressions of any size.

A rule's pattern is only tried on texts that hold a piece of text which every match must contain. Those pieces are drawn
from the patterns, and rules and texts meet in an equi-join on them; of what matches, the rule that comes first or last
is kept by an aggregate. Nothing of the rules is compiled into the plan or collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.operators.joins import sized_join
from skywarden.schema import BEHAVIOR_CODES, FLIGHT_CODES, code_of

# Length of an index key.
KEY = 4
# Parts in which texts meet the rules that no key can be drawn from.
UNKEYED_PARTS = 32


def required_text(pattern: str) -> str:
    """The longest text that every match of a pattern holds, as far as is plain to see; empty where nothing is.

    Alternatives, groups, classes and repeated characters promise nothing; flags and quoted parts promise nothing at all.
    """
    best, run, at, n = "", "", 0, len(pattern)

    def cut(keep: int | None = None) -> None:
        nonlocal best, run
        text = run if keep is None else run[:keep]
        best, run = max(best, text, key=len), ""

    while at < n:
        c = pattern[at]
        if c == "|":
            return ""
        if c == "(":
            cut()
            if pattern.startswith("(?", at) and not pattern.startswith(("(?:", "(?=", "(?!", "(?<"), at):
                return ""
            at = _past_group(pattern, at)
            continue
        if c == "[":
            cut()
            at = _past_class(pattern, at)
            continue
        if c in "*?{":
            # What stands before may be missing.
            cut(-1)
            at = pattern.find("}", at) + 1 if c == "{" else at + 1
            if not at:
                return ""
            at += at < n and pattern[at] in "?+"
            continue
        if c == "\\":
            if at + 1 >= n or pattern[at + 1] in "QExucpPkN0":
                return ""
            if pattern[at + 1].isalnum():
                cut()
            else:
                run += pattern[at + 1]
            at += 2
            continue
        if c in ".^$+":
            cut()
        else:
            run += c
        at += 1
    cut()
    return best


def _past_class(pattern: str, at: int) -> int:
    """Position behind the character class that opens at ``at``; classes may hold classes."""
    depth = 0
    while at < len(pattern):
        if pattern[at] == "\\":
            at += 1
        elif pattern[at] == "[":
            depth += 1
            # A bracket in front is a character of the class.
            at += pattern.startswith("[^]", at) * 2 or pattern.startswith("[]", at)
        elif pattern[at] == "]":
            depth -= 1
            if not depth:
                return at + 1
        at += 1
    return at


def _past_group(pattern: str, at: int) -> int:
    depth = 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 1
        elif c == "[":
            at = _past_class(pattern, at)
            continue
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if not depth:
                return at + 1
        at += 1
    return at


def _required(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for patterns in columns:
        yield pa.array([required_text(p or "") for p in patterns.to_pylist()], pa.string())


def _grams(text: Column) -> Column:
    """Distinct pieces of ``KEY`` characters."""
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - KEY + 1)), lambda i: F.substring(text, i, F.lit(KEY))))


def keyed_rules(rules: DataFrame, expression: str = "expression") -> DataFrame:
    """``rules`` with ``_key``: of the pieces a match must hold, the one that the fewest rules have; null for none."""
    required = F.arrow_udf(_required, "string")
    marked = rules.withColumn("_text", required(F.col(expression)))
    long = F.length("_text") >= KEY
    texts = marked.where(long).select("_text").distinct().select("_text", F.explode(_grams(F.col("_text"))).alias("_key"))
    rare = texts.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    keys = texts.join(rare, "_key").groupBy("_text").agg(F.min_by("_key", F.struct("_n", "_key")).alias("_key"))
    return marked.join(keys, "_text", "left").drop("_text")


def best_match(values: DataFrame, column: str, rules: DataFrame, order: str, payload: Sequence[str],
               also: Sequence[str] = (), last: bool = False) -> DataFrame:
    """``column, also, payload`` for those rows of ``values`` (distinct in ``column`` and ``also``) that a rule matches.

    A rule matches when its ``expression`` matches the whole text and the ``also`` columns are equal. Of several the one
    with the lowest ``order`` counts, or with the highest if ``last``; ``order`` has to be unique, or its ties equal.
    """
    keyed = keyed_rules(rules.select("expression", order, *also, *[p for p in payload if p not in (order, *also)]))
    named = {c: f"_r_{c}" for c in keyed.columns if c not in ("_key", *also)}
    keyed = keyed.withColumnsRenamed(named)
    texts = values.select(column, *also).where(F.col(column).isNotNull())
    met = sized_join(texts.withColumn("_key", F.explode(_grams(F.col(column)))), keyed.where(F.col("_key").isNotNull()),
                     ["_key", *also], "inner", spread=[column])
    # Rules without a key have to be tried on every text.
    part = F.pmod(F.xxhash64(column), F.lit(UNKEYED_PARTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(UNKEYED_PARTS - 1)))
    rest = keyed.where(F.col("_key").isNull()).drop("_key").withColumn("_part", every)
    tried = met.drop("_key").unionByName(
        texts.withColumn("_part", part).join(rest, ["_part", *also]).drop("_part"))
    hits = tried.where(F.rlike(F.col(column), F.concat(F.lit(r"\A(?:"), F.col(named["expression"]), F.lit(r")\z"))))
    pick = F.max_by if last else F.min_by
    found = hits.groupBy(column, *also).agg(
        pick(F.struct(*[F.col(named.get(p, p)).alias(p) for p in payload]), F.col(named[order])).alias("_rule"))
    return found.select(column, *also, *[F.col("_rule")[p].alias(p) for p in payload])


def tag_request_type_by_join(df: DataFrame, rules: DataFrame, column: str = "request",
                             spread: Sequence[str] = ()) -> DataFrame:
    """``flight_type`` and ``behavior_type`` as ``tag_request_type`` gives them, for a rule table of any size.

    ``rules`` has flight_type, operation_type, expression and priority (``readers.classify_rules``). Each URL is matched
    once, however many requests have it; ``spread`` names columns that split the requests of a hot URL.
    """
    plain = df.drop("flight_type", "behavior_type")
    names = rules.select(
        "expression", "priority", _name_of(F.col("flight_type"), FLIGHT_CODES).alias("flight_type"),
        _name_of(F.col("operation_type"), BEHAVIOR_CODES).alias("behavior_type"))
    found = best_match(plain.select(column).distinct(), column, names, "priority", ["flight_type", "behavior_type"])
    return sized_join(plain, found, [column], "left", spread=spread or [c for c in plain.columns if c != column]).select(
        *plain.columns, F.coalesce("flight_type", F.lit("Other")).alias("flight_type"),
        F.coalesce("behavior_type", F.lit("Other")).alias("behavior_type"))


def _name_of(code: Column, codes: dict[str, int]) -> Column:
    out = F.lit(None).cast("string")
    for name, number in codes.items():
        out = F.when(code == number, F.lit(name)).otherwise(out)
    return out


def match_parse_rule_by_join(df: DataFrame, rules: DataFrame, into: str = "rule_no",
                             spread: Sequence[str] = ()) -> DataFrame:
    """``into``: number of the parse rule that applies, the last one that matches, null when none does.

    ``rules`` has rule_no, requestMatchExpression, requestMethod and behavior_type (a code). Needs the tagged requests.
    """
    marked = df.withColumns({"_method": F.lower("request_method"), "_behavior": code_of(F.col("behavior_type"), BEHAVIOR_CODES)})
    also = ["_method", "_behavior"]
    table = rules.select("rule_no", F.col("requestMatchExpression").alias("expression"),
                         F.lower("requestMethod").alias("_method"), F.col("behavior_type").cast("int").alias("_behavior"))
    found = best_match(marked.select("request", *also).distinct(), "request", table, "rule_no", ["rule_no"], also, last=True)
    rest = [c for c in df.columns if c not in ("request", "behavior_type")]
    return sized_join(marked, found.withColumnRenamed("rule_no", into), ["request", *also], "left",
                      spread=spread or rest).select(*df.columns, into)
