"""Parsing, masking, tagging, extraction and the line format on hand-made records."""

from __future__ import annotations

import re
from hashlib import md5

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skywarden.functions import codec, documents, text
from skywarden.operators import extract as ex
from skywarden.operators.line import from_line, to_line
from skywarden.operators.mask import IDENTITY, PHONE, mask_pii
from skywarden.operators.parse import cookie_map, parse_requests
from skywarden.operators.tag import drop_noise_lines, flag_known_ip, spider_tag, stage_tag, travel_type
from skywarden.plans import rules
from skywarden.plans.etl import Site, process_lines
from skywarden.schema import ClassifyRule, ParseRule

# The one record that is known with all its results.
SAMPLE = "#CS#".join([
    "NULL", "POST /B2C40/query/jaxb/direct/query.ao HTTP/1.1", "POST", "application/x-www-form-urlencoded",
    "json=%7B%22depcity%22%3A%22CAN%22%2C%22arrcity%22%3A%22WUH%22%2C%22flightdate%22%3A%2220180220%22%2C"
    "%22adultnum%22%3A%221%22%2C%22childnum%22%3A%220%22%2C%22infantnum%22%3A%220%22%7D",
    "http://host/select.html?t=S&c1=CAN&c2=WUH&d1=2019-06-29", "192.168.80.1", "Mozilla/5.0",
    "2019-06-29T08:46:56+08:00", "192.168.80.83",
    "JSESSIONID=782121159357B98CA6112554CF44321E; userId4logCookie=13818791413", "3"])


def one(spark, expr, **cols):
    names = list(cols) or ["x"]
    values = list(cols.values()) or [None]
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(values)], schema).select(expr.alias("r")).first().r


def test_sample_record(spark):
    df = spark.createDataFrame([(SAMPLE,)], "value string")
    row = process_lines(df, Site()).first()
    assert row.request == "/B2C40/query/jaxb/direct/query.ao"
    assert row.jsessionid == "782121159357B98CA6112554CF44321E"
    assert row.userid == "D1279C812D20ABDB6612BA7AF1C5D13C"
    assert (row.flight_type, row.behavior_type, row.travel_type) == ("National", "Query", "OneWay")
    assert (row.depcity, row.arrcity, row.flight_date) == ("CAN", "WUH", "20180220")
    q = row.query_data
    assert (q.adultNum, q.childNum, q.infantNum, q.isEmpty, q.flightType, q.travelType) == ("1", "0", "0", False, 0, 0)
    assert row.book_data.contractPhone == "D41D8CD98F00B204E9800998ECF8427E"


def test_sample_line(spark):
    """The captured processed line, slot by slot, up to the referrer."""
    df = spark.createDataFrame([(SAMPLE,)], "value string")
    line = to_line(process_lines(df, Site())).first().value.split("#CS#")
    assert line[:11] == ["NULL", "POST", "/B2C40/query/jaxb/direct/query.ao", "192.168.80.1", "Mozilla/5.0",
                         "2019-06-29T08:46:56+08:00", "192.168.80.83", "false", "National", "Query", "OneWay"]
    assert line[16] == (
        '{"isEmpty":false,"flightType":0,"queryTime":"","queryUserId":"","queryUnUserId":"","queryIp":"",'
        '"depCity":"CAN","arrCity":"WUH","flightDate":"20180220","adultNum":"1","childNum":"0","infantNum":"0",'
        '"country":"","travelType":0}')
    assert line[17] == (
        '{"flightType":-1,"travelType":-1,"bookTime":"","bookUserId":"","bookUnUserId":"","bookIp":"","psgName":[],'
        '"psgType":[],"idType":[],"idCard":[],"contractName":"","contractPhone":"D41D8CD98F00B204E9800998ECF8427E",'
        '"bookAgent":"","depCity":[],"arrCity":[],"flightDate":[],"flightNo":[],"cabin":[]}')


def test_short_records(spark):
    df = spark.createDataFrame([("",), ("NULL#CS#GET",), ("NULL#CS#GET /a b#CS#GET",)], "value string")
    rows = parse_requests(df).collect()
    assert [r.request for r in rows] == ["", "", "/a"]
    assert all(r.jsessionid == "NULL" and r.remote_addr == "" for r in rows)


def test_noise(spark):
    urls = ["/x.css", "", " ", "/ok", "/x.cssy?z"]
    df = spark.createDataFrame([(f"NULL#CS#GET {u} H",) for u in urls], "value string")
    kept = parse_requests(drop_noise_lines(df, rules.NOISE)).select("request").collect()
    assert [r.request for r in kept] == ["/ok"]


@pytest.mark.parametrize("cookies, want", [
    ("a=1=2;b;a=3", {"a": "3"}), ("", {}), ("a=;b==;=c", {"": "c"}), ("k=%E5%8D%95", {"k": "单"}),
    ("k=%u4E2D%u56FD", {"k": "中国"}), ("k=%zz;j=1", {"j": "1"}), ("a==b", {"a": ""}), ("a=1;a=%zz", {"a": "1"}),
])
def test_cookies(spark, cookies, want):
    assert one(spark, cookie_map(F.col("c")), c=cookies) == want


def test_cookie_lookup_agrees_with_map(spark):
    df = spark.createDataFrame([("#CS#".join(["x"] * 10 + ["JSESSIONID=1; JSESSIONID=%zz; userId4logCookie=%u4E2D"]),)],
                               "value string")
    row = parse_requests(df).first()
    assert (row.jsessionid, row.userid) == ("1", "中")


def test_unescape_and_escape(spark):
    assert one(spark, codec.js_unescape(F.col("v")), v='a%20"b\\%E9%u00e9') == 'a "b\\éé'
    assert one(spark, codec.js_escape(F.col("v")), v="a é中~") == "a%20%u00E9%u4E2D~"
    assert one(spark, codec.js_unescape(codec.js_escape(F.col("v"))), v="x\n\t\"\\😀é") == "x\n\t\"\\😀é"


def mask_by_hand(value: str) -> str:
    for pattern in (PHONE, IDENTITY):
        out = value
        for hit in re.finditer(pattern, value, re.ASCII):
            out = out.replace(hit.group(), md5(hit.group().encode()).hexdigest().upper())
        value = out
    return value


def test_mask_golden(spark):
    df = spark.createDataFrame([("u=13818791413",), ("none 12",)], "value string")
    assert [r.value for r in mask_pii(df).collect()] == ["u=D1279C812D20ABDB6612BA7AF1C5D13C", "none 12"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="1358 0Xx9,47", max_size=60), min_size=1, max_size=40))
def test_mask_against_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r.value for r in mask_pii(df).collect()] == [mask_by_hand(v) for v in values]


@pytest.mark.parametrize("referrer, want", [
    ("x", "Unknown"), ("d=2019-06-29", "OneWay"), ("a=2019-06-29&b=2019-07-01", "RoundTrip"),
    ("2019-06-29 2019-06-30 2019-07-01", "Unknown"), ("2019-13-29", "Unknown")])
def test_travel_type(spark, referrer, want):
    assert one(spark, travel_type(F.col("r")), r=referrer) == want


def test_stage_and_spider(spark):
    urls = ["/a/bookingnew/x", "/ita/intl/zh/passengers/x", "/upp_payment/pay/x", "/q"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.s for r in df.select(stage_tag(F.col("u")).alias("s")).collect()] == ["1", "2", "3", "0"]
    ids = spark.createDataFrame([("f",), ("NULL",), (None,)], "f string")
    assert [r.s for r in ids.select(spider_tag(F.col("f")).alias("s")).collect()] == ["1", "0", "0"]


def test_class_order(spark):
    from skywarden.operators.tag import tag_request_type

    both = [ClassifyRule(1, 0, ".*q.*"), ClassifyRule(0, 1, ".*q.*"), ClassifyRule(0, 7, ".*")]
    df = spark.createDataFrame([("/q",), ("/z",)], "request string")
    rows = tag_request_type(df, both).collect()
    assert [(r.flight_type, r.behavior_type) for r in rows] == [("National", "Book"), ("Other", "Other")]


@pytest.mark.parametrize("address, want", [
    ("192.168.80.81", "192.168"), ("::1", ""), ("1.2.3", ""), ("1.2.3.4.5", ""), ("", "")])
def test_ip_block(spark, address, want):
    assert one(spark, text.ip_block(F.col("a")), a=address) == want


def test_known_addresses_with_and_without_broadcast(spark, monkeypatch):
    from skywarden.operators import joins

    df = spark.createDataFrame([(i, f"10.0.0.{i % 3}") for i in range(50)], "event_id int, remote_addr string")
    black = spark.createDataFrame([("10.0.0.1",), ("10.0.0.1",)], "ip_name string")
    want = {i: i % 3 == 1 for i in range(50)}
    assert {r.event_id: r.high_freq_ip for r in flag_known_ip(df, black, spread=["event_id"]).collect()} == want
    monkeypatch.setattr(joins, "is_small", lambda *a: False)
    assert {r.event_id: r.high_freq_ip for r in flag_known_ip(df, black, spread=["event_id"]).collect()} == want


BAD_PAGES = ["<page><A>1</A>", "<page><A>1<A></page>", "no", "", "<page>1</page> tail", "<page/>", None,
             "<page>a</page><page>b</page>", "<page>&nbsp;</page>"]


def test_malformed_pages_are_null(spark):
    df = spark.createDataFrame([(b,) for b in BAD_PAGES], "b string")
    rows = documents.with_xml_page(df, F.col("b")).collect()
    assert [r._page for r in rows] == [None] * len(BAD_PAGES)


def test_pages(spark):
    bodies = ['<?xml version="1.0"?><page><A>1</A><B>x</B><B>y</B></page> ', "junk<page><page>n</page><A>2</A></page>"]
    df = documents.with_xml_page(spark.createDataFrame([(b,) for b in bodies], "b string"), F.col("b"))
    rows = df.select(documents.xpath_text(F.col("_page"), "//A/text()").alias("a"),
                     documents.xpath_list(F.col("_page"), "//B/text()").alias("b"),
                     documents.xpath_list(F.col("_page"), "").alias("c")).collect()
    assert [(r.a, r.b, r.c) for r in rows] == [("1", ["x", "y"], []), ("2", [], [])]


@pytest.mark.parametrize("doc, want", [
    ('{"p":[{"f":"a"},{"f":"c"}]}', ["a", "c"]), ('{"p":[{"f":"a"}]}', ["a"]), ('{"p":[]}', []), ("bad", []),
    ('{"p":[{"f":"[x]"}]}', ["[x]"])])
def test_json_lists(spark, doc, want):
    assert one(spark, documents.as_list(F.get(documents.json_found(F.col("d"), ["", "$.p[*].f"]), F.lit(1))), d=doc) == want


def request(spark, **over):
    base = dict(request="/q", request_method="POST", content_type="", request_body="", flight_type="National",
                behavior_type="Query", travel_type="OneWay")
    base.update(over)
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} string" for k in base))


def test_last_matching_rule_wins(spark):
    first = ParseRule(0, 0, ".*", "post", normal_form=True, query={"depCity": "a"})
    second = ParseRule(0, 0, "/q", "POST", normal_form=True, query={"depCity": "b"})
    row = ex.extract_query(request(spark, request_body="a=1&b=2&b=%E5%8D%95"), [first, second]).first()
    assert row.query_data.depCity == "单"


def test_query_without_parameters_stays_empty(spark):
    rule = ParseRule(0, 0, ".*", "GET", normal_get=True, query={"depCity": "a"})
    rows = [ex.extract_query(request(spark, request_method="GET", request=u), [rule]).first().query_data
            for u in ("/q", "/q?", "/q?a", "/q?a=1?a=2")]
    assert [r.isEmpty for r in rows] == [True, True, True, False]
    assert rows[3].depCity == "1"


def test_behavior_code_in_flight_type(spark):
    df = request(spark, flight_type="International")
    assert ex.extract_query(df, [], "behavior").first().query_data.flightType == 0
    assert ex.extract_query(df, []).first().query_data.flightType == 1


def test_booking_from_form_json(spark):
    rule = ParseRule(1, 1, ".*", "POST", json=True, form_field="j", book={
        "psgFirName": "$.p[*].f", "psgName": "$.p[*].l", "idCard": "$.p[*].id", "contractPhone": "$.tel"})
    body = "j=%5B%7B%22p%22%3A%5B%7B%22f%22%3A%22A%22%2C%22l%22%3A%22B%22%2C%22id%22%3A%221%22%7D%5D%2C%22tel%22%3A%22" \
           "\\x222%22%7D%5D"
    row = ex.extract_book(request(spark, behavior_type="Book", request_body=body), [rule]).first().book_data
    assert row.psgName == ["AB"] and row.idCard == [md5(b"1").hexdigest().upper()]
    assert row.contractPhone == md5(b"2").hexdigest().upper() and row.flightType == 1
    empty = ex.extract_book(request(spark, behavior_type="Book", request_body="k=1"), [rule]).first().book_data
    assert empty.psgName == [] and empty.contractPhone == "D41D8CD98F00B204E9800998ECF8427E"


def test_booking_contact_is_cut(spark):
    rule = ParseRule(0, 1, ".*", "POST", text_xml=True, xml=True, book={
        "contractName": "//C/text()", "contractPhone": "//T/text()", "depCity": "//D/text()"})
    df = request(spark, behavior_type="Book", content_type="TEXT/XML",
                 request_body="<page><C>Li|x</C><T>1/2</T><D>a</D><D>b</D></page>")
    row = ex.extract_book(df, [rule]).first().book_data
    assert (row.contractName, row.contractPhone, row.depCity) == ("Li", md5(b"1").hexdigest().upper(), ["a", "b"])


def test_core_params_fall_back_to_booking(spark):
    rule = ParseRule(0, 1, ".*", "POST", text_xml=True, xml=True, book={"depCity": "//D/text()"})
    df = request(spark, behavior_type="Book", content_type="text/xml", request_body="<page><D>a</D><D>b</D></page>")
    df = ex.extract_book(ex.extract_query(df, []), [rule])
    assert ex.core_params(df).first().depcity == "ab"
    assert ex.core_params(df, book_fallback=False).first().depcity == ""


def test_line_round_trip(spark):
    df = process_lines(spark.createDataFrame([(SAMPLE,)], "value string"), Site())
    back = from_line(to_line(df).select("value")).first()
    src = df.first()
    for name in ("request", "remote_addr", "flight_type", "depcity", "userid", "http_referrer", "query_data"):
        assert back[name] == src[name]
    assert back.high_freq_ip is False and str(back.event_time) == "2019-06-29 08:46:56"


def test_blank(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t",), ("NuLL",), ("x",), (" null",)], "v string")
    assert [r.b for r in df.select(text.is_blank(F.col("v")).alias("b")).collect()] == [True] * 4 + [False] * 2


def test_sql_functions(spark):
    from skywarden.functions.register import register_functions

    register_functions(spark)
    row = spark.sql("SELECT Stage('/x/bookingnew/y') s, Spider('null') n, Spider('f') y").first()
    assert (row.s, row.n, row.y) == ("1", "0", "1")
