"""Rule tables of any size match what trying every rule on every text matches."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from skywarden.operators import extract as ex
from skywarden.operators.patterns import (
    keyed_rules, match_parse_rule_by_join, required_text, tag_request_type_by_join,
)
from skywarden.operators.tag import tag_request_type
from skywarden.schema import ClassifyRule, ParseRule


@pytest.mark.parametrize("pattern, want", [
    (r"^.*/query/jaxb/.*$", "/query/jaxb/"), (r"^.*query\.ao.*$", "query.ao"), ("abc|def", ""), ("(abc)?defg", "defg"),
    ("abcd*", "abc"), ("abcd+ef", "abcd"), ("ab{2}cde", "cde"), ("ab[cd]efg", "efg"), (r"\d+abc\w", "abc"), ("(?i)abc", ""),
    ("a(b(c)d[)]e)fgh", "fgh"), (r"x[]]yz", "yz"), (r"x[^]a]yzz", "yzz"), ("", ""), (r"\Qa.b\E", ""), ("a??bcd", "bcd"),
    (r"/a\(b\)c", "/a(b)c"), ("(?:x|y)/path", "/path"), ("ab{", ""), (r"\x41bcd", ""), ("p[a-z&&[^q]]rest", "rest")])
def test_required_text(pattern, want):
    assert required_text(pattern) == want


def test_required_text_is_in_every_match():
    rnd = random.Random(2)
    parts = ["ab", "c", "/x", ".", ".*", "a?", "(b|c)", "[ab]", "c+", r"\.", "(?:ab)*", "b{1,2}", "d*", "^", "$"]
    for _ in range(3000):
        pattern = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6)))
        needed = required_text(pattern)
        for _ in range(20):
            text = "".join(rnd.choice("abc/x.d") for _ in range(rnd.randint(0, 8)))
            if re.fullmatch(pattern, text):
                assert needed in text, (pattern, text)


RULES = [ClassifyRule(0, 0, r"^.*/query/.*$"), ClassifyRule(0, 1, r"^.*/book(ing)?new/.*$"), ClassifyRule(1, 0, r"^.*/q.*$"),
         ClassifyRule(1, 1, r"/[ab]+"), ClassifyRule(0, 0, r"/exact\?a=1"), ClassifyRule(1, 1, r"^.*/query/x.*$")]
URLS = ["/query/x", "/bookingnew/1", "/booknew/1", "/q", "/abba", "/exact?a=1", "/exactXa=1", "", None, "/none", "/a/query/b"]


def classify_table(spark, rules):
    rows = [(r.flight_type, r.operation_type, r.expression, r.flight_type * 2 + r.operation_type) for r in rules]
    return spark.createDataFrame(rows, "flight_type int, operation_type int, expression string, priority int")


def test_request_types(spark):
    rows = [(i, URLS[i % len(URLS)], "old") for i in range(60)]
    df = spark.createDataFrame(rows, "event_id long, request string, flight_type string").repartition(4)
    want = tag_request_type(df, RULES).select("event_id", "request", "flight_type", "behavior_type")
    got = tag_request_type_by_join(df, classify_table(spark, RULES)).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    none = tag_request_type_by_join(df, classify_table(spark, RULES).limit(0))
    assert {(r.flight_type, r.behavior_type) for r in none.collect()} == {("Other", "Other")}


def test_parse_rules(spark):
    rules = [ParseRule(0, 0, "^.*query.*$", "POST"), ParseRule(0, 0, "^.*query/x.*$", "post"), ParseRule(0, 1, "^.*query.*$", "POST"),
             ParseRule(0, 0, "/q", "GET"), ParseRule(0, 0, ".*", "GET"), ParseRule(0, 1, "/[ab]+", "POST")]
    rows = [(i, URLS[i % len(URLS)], ["POST", "get", "Post", None][i % 4], ["Query", "Book", "Other"][i % 3]) for i in range(132)]
    df = spark.createDataFrame(rows, "event_id long, request string, request_method string, behavior_type string")
    table = spark.createDataFrame([(i, r.expression, r.method, r.behavior_type) for i, r in enumerate(rules)],
                                  "rule_no int, requestMatchExpression string, requestMethod string, behavior_type int")
    want = df.withColumn("rule_no", ex.matched_rule(rules))
    assert sorted(map(str, match_parse_rule_by_join(df, table).collect())) == sorted(map(str, want.collect()))


def test_fifty_thousand_rules(spark):
    """Rules that share most of their text get keys of their own part, so a text meets few of them."""
    rules = spark.range(50_000).select(
        (F.col("id") % 2).cast("int").alias("flight_type"), (F.floor(F.col("id") / 2) % 2).cast("int").alias("operation_type"),
        F.concat(F.lit("^.*/modules/page-"), F.lpad(F.conv(F.col("id").cast("string"), 10, 36), 4, "0"), F.lit("/.*$")
                 ).alias("expression")).withColumn("priority", F.col("flight_type") * 2 + F.col("operation_type"))
    df = spark.range(2000).select(F.col("id").alias("event_id"), F.concat(
        F.lit("/site/modules/page-"), F.lpad(F.conv((F.col("id") * 37).cast("string"), 10, 36), 4, "0"),
        F.lit("/index.html")).alias("request"))
    got = tag_request_type_by_join(df, rules).collect()
    name = {0: ("National", "Query"), 1: ("International", "Query"), 2: ("National", "Book"), 3: ("International", "Book")}
    assert {r.event_id: (r.flight_type, r.behavior_type) for r in got} == {
        i: name[i * 37 % 4] if i * 37 < 50_000 else ("Other", "Other") for i in range(2000)}
    assert keyed_rules(rules).groupBy("_key").count().agg(F.max("count")).first()[0] < 500
