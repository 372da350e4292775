"""Queries on record parsing, masking, tagging and extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.functions.codec import cookie_decode, js_escape, md5_upper
from skywarden.functions.text import ip_block
from skywarden.functions.times import iso_millis
from skywarden.operators import extract as ex
from skywarden.operators.line import from_line, to_line
from skywarden.operators.mask import IDENTITY, PHONE, mask_pii, mask_text
from skywarden.operators.parse import clean_cookies, cookie_map, parse_requests, request_url, slot
from skywarden.operators.patterns import match_parse_rule_by_join, tag_request_type_by_join
from skywarden.operators.tag import (
    flag_known_ip, spider_tag, stage_tag, tag_request_type, tag_travel_type,
)
from skywarden.plans import adapter, rules
from skywarden.plans.etl import Site, process_lines, processed_lines, tagged_requests
from skywarden.plans.registry import QUERIES, cte, query, with_ctes  # noqa: F401
from skywarden.schema import ParseRule

# --- building blocks of the checking SQL ---

cte("slots", ("raw",), "SELECT event_id, ts, value, string_split(value, '#CS#') AS s FROM raw")
cte("parsed", ("slots",), """
SELECT event_id, ts, value, coalesce(string_split(coalesce(s[2], ''), ' ')[2], '') AS request,
 coalesce(s[3], '') AS request_method, coalesce(s[4], '') AS content_type, coalesce(s[5], '') AS request_body,
 coalesce(s[6], '') AS http_referrer, coalesce(s[7], '') AS remote_addr, coalesce(s[8], '') AS http_user_agent,
 coalesce(s[9], '') AS time_iso8601, coalesce(s[10], '') AS server_addr,
 regexp_replace(coalesce(s[11], ''), '\\s', '', 'g') AS cookies_str FROM slots""")
cte("kept", ("parsed",), r"""
SELECT * FROM parsed WHERE trim(request) <> '' AND NOT regexp_full_match(request, '^.*\.(css|js|png|jpg).*$')""")
_MASK = ("list_reduce(list_prepend({0}, regexp_extract_all({0}, '{1}')), "
         "lambda acc, hit: replace(acc, hit, upper(md5(hit))))")
_NAT_Q = r"regexp_full_match(request, '^.*/query/(jaxb/direct|xml)/query\.ao.*$')"
_NAT_B = "regexp_full_match(request, '^.*/bookingnew/.*$')"
_INT_Q = "regexp_full_match(request, '^.*/ita/intl/zh/(search|form)/.*$')"
_INT_B = "regexp_full_match(request, '^.*/ita/intl/zh/passengers/.*$')"
_DATE_RE = r"([0-9]{4})-(0[0-9]|1[0-2])-(0[0-9]|[12][0-9]|3[01])"
cte("typed", ("kept",), f"""
SELECT *, CASE WHEN {_NAT_Q} OR {_NAT_B} THEN 'National' WHEN {_INT_Q} OR {_INT_B} THEN 'International'
  ELSE 'Other' END AS flight_type,
 CASE WHEN {_NAT_Q} THEN 'Query' WHEN {_NAT_B} THEN 'Book' WHEN {_INT_Q} THEN 'Query' WHEN {_INT_B} THEN 'Book'
  ELSE 'Other' END AS behavior_type,
 CASE len(regexp_extract_all(http_referrer, '{_DATE_RE}')) WHEN 1 THEN 'OneWay' WHEN 2 THEN 'RoundTrip'
  ELSE 'Unknown' END AS travel_type FROM kept""")


def _last_param(text: str, key: str) -> str:
    return (f"coalesce(split_part(list_filter(string_split({text}, '&'), "
            f"lambda t: starts_with(t, '{key}=') AND rtrim(t, '=') <> '{key}')[-1], '=', 2), '')")


def _tag(name: str) -> str:
    return f"regexp_extract(request_body, '<{name}>([^<]*)</{name}>', 1)"


def _tags(name: str) -> str:
    return f"regexp_extract_all(request_body, '<{name}>([^<]*)</{name}>', 1)"


_Q = "split_part(request, '?', 2)"
_JSON = "url_decode(" + _last_param("request_body", "json") + ")"
_IS_GET = "regexp_full_match(request, '^.*/ita/intl/zh/search/.*$')"
_IS_FORM = "regexp_full_match(request, '^.*/ita/intl/zh/form/.*$')"
_IS_JSON = "regexp_full_match(request, '^.*/query/jaxb/.*$')"
_IS_XML = "regexp_full_match(request, '^.*/query/xml/.*$') AND ends_with(request_body, '</page>')"


def _field(get: str, form: str, json: str, xml: str) -> str:
    return (f"CASE WHEN {_IS_GET} THEN {get} WHEN {_IS_FORM} THEN {form} WHEN {_IS_JSON} THEN {json} "
            f"WHEN {_IS_XML} THEN {xml} ELSE '' END")


def _js(path: str) -> str:
    return f"coalesce(json_extract_string({_JSON}, '{path}'), '')"


# Query fields of every kept line, pulled out by plain string functions.
cte("queried", ("typed",), f"""
SELECT *, NOT (({_IS_GET}) OR ({_IS_FORM}) OR ({_IS_JSON}) OR ({_IS_XML})) AS q_empty,
 {_field(_last_param(_Q, 'dep'), _last_param('request_body', 'dep'), _js('$.depcity'), _tag('DEP'))} AS q_dep,
 {_field(_last_param(_Q, 'arr'), _last_param('request_body', 'arr'), _js('$.arrcity'), _tag('ARR'))} AS q_arr,
 {_field(_last_param(_Q, 'date'), _last_param('request_body', 'date'), _js('$.flightdate'), _tag('DATE'))} AS q_date,
 {_field(_last_param(_Q, 'adult'), _last_param('request_body', 'adult'), _js('$.adultnum'), _tag('ADULT'))} AS q_adult,
 {_field("''", "''", _js('$.childnum'), "''")} AS q_child,
 {_field("''", "''", _js('$.infantnum'), "''")} AS q_infant,
 {_field("''", 'url_decode(' + _last_param('request_body', 'country') + ')', "''", "''")} AS q_country,
 CASE flight_type WHEN 'National' THEN 0 WHEN 'International' THEN 1 ELSE -1 END AS flight_code,
 CASE travel_type WHEN 'OneWay' THEN 0 WHEN 'RoundTrip' THEN 1 ELSE -1 END AS travel_code FROM typed""")


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_requests(adapter.raw_lines(spark, sf))


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    """Kept lines, split and tagged, bodies unmasked."""
    from skywarden.operators.tag import drop_noise_lines

    df = parse_requests(drop_noise_lines(adapter.raw_lines(spark, sf), rules.NOISE))
    return tag_travel_type(tag_request_type(df, rules.CLASSIFY))


def _queried(spark: SparkSession, sf: str) -> DataFrame:
    return ex.extract_query(_tagged(spark, sf), rules.QUERY_RULES)


_SPLIT = ("request", "request_method", "content_type", "request_body", "http_referrer", "remote_addr",
          "http_user_agent", "time_iso8601", "server_addr")


@query("p1_split_record", f"SELECT event_id, {', '.join(_SPLIT)} FROM parsed", "parsed")
def _(spark, sf):
    return _parsed(spark, sf).select("event_id", *_SPLIT)


@query("p2_clean_cookies", "SELECT event_id, cookies_str FROM parsed", "parsed")
def _(spark, sf):
    return adapter.raw_lines(spark, sf).select("event_id", clean_cookies(slot(F.col("value"), 10)).alias("cookies_str"))


_COOKIE_PAIRS = """
pairs AS (SELECT event_id, i, rtrim(t, '=') AS t FROM (
 SELECT event_id, unnest(string_split(cookies_str, ';')) AS t, generate_subscripts(string_split(cookies_str, ';'), 1) AS i
 FROM parsed) WHERE contains(rtrim(t, '='), '=')),
cookies AS (SELECT event_id, split_part(t, '=', 1) AS k, arg_max(url_decode(split_part(t, '=', 2)), i) AS v
 FROM pairs GROUP BY 1, 2)"""


@query("p3_cookie_map", with_ctes("", "parsed").rstrip() + "," + _COOKIE_PAIRS + """
SELECT event_id, k AS cookie, v AS cookie_value FROM cookies""")
def _(spark, sf):
    cookies = adapter.raw_lines(spark, sf).select(
        "event_id", cookie_map(clean_cookies(slot(F.col("value"), 10))).alias("m"))
    return cookies.select("event_id", F.explode("m").alias("cookie", "cookie_value"))


@query("p4_cookie_decode", "SELECT doc_id, upper(md5(text)) AS decoded FROM documents")
def _(spark, sf):
    docs = adapter.spread_scan(adapter.read(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", md5_upper(cookie_decode(js_escape(F.col("text")))).alias("decoded"))


@query("p5_session_and_user", with_ctes("", "parsed").rstrip() + "," + _COOKIE_PAIRS + """
SELECT p.event_id, coalesce(s.v, 'NULL') AS jsessionid, coalesce(u.v, 'NULL') AS userid FROM parsed p
LEFT JOIN cookies s ON s.event_id = p.event_id AND s.k = 'JSESSIONID'
LEFT JOIN cookies u ON u.event_id = p.event_id AND u.k = 'userId4logCookie'""")
def _(spark, sf):
    return _parsed(spark, sf).select("event_id", "jsessionid", "userid")


@query("p6_mask_phones", f"SELECT doc_id, {_MASK.format('text', PHONE)} AS masked FROM documents")
def _(spark, sf):
    docs = adapter.spread_scan(adapter.read(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", mask_text(F.col("text"), PHONE).alias("masked"))


@query("p7_mask_identities", f"""
SELECT doc_id, {_MASK.format('t', IDENTITY)} AS masked FROM (
 SELECT doc_id, {_MASK.format('text', PHONE)} AS t FROM documents)""")
def _(spark, sf):
    docs = adapter.spread_scan(adapter.read(spark, sf, "documents").select("doc_id", "text"))
    return mask_pii(docs, "text").select("doc_id", F.col("text").alias("masked"))


@query("p8_digest", "SELECT doc_id, upper(md5(text)) AS digest FROM documents")
def _(spark, sf):
    return adapter.read(spark, sf, "documents").select("doc_id", md5_upper(F.col("text")).alias("digest"))


@query("p9_request_type", "SELECT event_id, flight_type, behavior_type FROM typed", "typed")
def _(spark, sf):
    return _tagged(spark, sf).select("event_id", "flight_type", "behavior_type")


@query("p9_rules_by_join", "SELECT event_id, flight_type, behavior_type FROM typed", "typed")
def _(spark, sf):
    """The same with the rules as a table that meets the URLs in a join."""
    table = spark.createDataFrame(
        [(r.flight_type, r.operation_type, r.expression, r.flight_type * 2 + r.operation_type) for r in rules.CLASSIFY],
        "flight_type int, operation_type int, expression string, priority int")
    return tag_request_type_by_join(_tagged(spark, sf), table, spread=["event_id"]).select(
        "event_id", "flight_type", "behavior_type")


@query("p10_travel_type", f"""
SELECT event_id, CASE len(regexp_extract_all(http_referrer, '{_DATE_RE}')) WHEN 1 THEN 'OneWay'
 WHEN 2 THEN 'RoundTrip' ELSE 'Unknown' END AS travel_type FROM parsed""", "parsed")
def _(spark, sf):
    return tag_travel_type(_parsed(spark, sf)).select("event_id", "travel_type")


@query("p11_known_address", """
SELECT event_id, remote_addr IN (SELECT remote_addr FROM spiders) AS high_freq_ip FROM requests""",
       "requests", "spiders")
def _(spark, sf):
    out = flag_known_ip(adapter.requests(spark, sf), adapter.spiders(spark, sf), spread=["event_id"])
    return out.select("event_id", "high_freq_ip")


@query("p12_matched_rule", f"""
SELECT event_id, CASE WHEN behavior_type <> 'Query' THEN -1 WHEN {_IS_FORM} AND request_method = 'POST' THEN 3
 WHEN {_IS_GET} AND request_method = 'GET' THEN 2 WHEN regexp_full_match(request, '^.*/query/xml/.*$') THEN 1
 WHEN {_IS_JSON} THEN 0 ELSE -1 END AS rule_no FROM typed""", "typed")
def _(spark, sf):
    return _tagged(spark, sf).select(
        "event_id", F.coalesce(ex.matched_rule(rules.QUERY_RULES), F.lit(-1)).alias("rule_no"))


@query("p12_rules_by_join", QUERIES["p12_matched_rule"].sql)
def _(spark, sf):
    table = spark.createDataFrame([(i, r.expression, r.method, r.behavior_type) for i, r in enumerate(rules.QUERY_RULES)],
                                  "rule_no int, requestMatchExpression string, requestMethod string, behavior_type int")
    return match_parse_rule_by_join(_tagged(spark, sf), table, spread=["event_id"]).select(
        "event_id", F.coalesce("rule_no", F.lit(-1)).alias("rule_no"))


def _fields(df: DataFrame, source: str = "query_data") -> DataFrame:
    q = F.col(source)
    return df.select("event_id", q["depCity"].alias("dep"), q["arrCity"].alias("arr"), q["flightDate"].alias("date"),
                     q["adultNum"].alias("adult"), q["country"].alias("country"))


_FIELDS = "event_id, q_dep AS dep, q_arr AS arr, q_date AS date, q_adult AS adult, q_country AS country"


@query("p13_query_from_url", f"SELECT {_FIELDS} FROM queried WHERE {_IS_GET}", "queried")
def _(spark, sf):
    return _fields(_queried(spark, sf).where(ex.rule_matches(rules.QUERY_RULES[2])))


@query("p14_query_from_form", f"SELECT {_FIELDS} FROM queried WHERE {_IS_FORM}", "queried")
def _(spark, sf):
    return _fields(_queried(spark, sf).where(ex.rule_matches(rules.QUERY_RULES[3])))


@query("p15_query_from_form_json", f"SELECT {_FIELDS} FROM queried WHERE {_IS_JSON}", "queried")
def _(spark, sf):
    return _fields(_queried(spark, sf).where(ex.rule_matches(rules.QUERY_RULES[0])))


@query("p16_query_from_json_body", """
SELECT event_id, json_extract_string(request_body, '$.seg.dep') AS dep,
 json_extract_string(request_body, '$.seg.arr') AS arr FROM parsed WHERE content_type = 'application/json'""", "parsed")
def _(spark, sf):
    rule = ParseRule(1, 0, ".*", "POST", application_json=True, json=True,
                     query={"depCity": "$.seg.dep", "arrCity": "$.seg.arr"})
    fields = ex.json_fields(F.col("request_body"), rule)
    bodies = _parsed(spark, sf).where("content_type = 'application/json'")
    return bodies.select("event_id", fields["depCity"].alias("dep"), fields["arrCity"].alias("arr"))


@query("p17_query_from_xml", f"SELECT {_FIELDS} FROM queried WHERE regexp_full_match(request, '^.*/query/xml/.*$')",
       "queried")
def _(spark, sf):
    return _fields(_queried(spark, sf).where(ex.rule_matches(rules.QUERY_RULES[1])))


@query("p18_fields_from_pairs", f"""
SELECT event_id, {_last_param(_Q, 'dep')} AS dep, {_last_param(_Q, 'arr')} AS arr, {_last_param(_Q, 'child')} AS child,
 coalesce(try_cast(nullif({_last_param(_Q, 'type')}, '') AS INTEGER), -1) AS travel_type FROM parsed
WHERE {_IS_GET}""", "parsed")
def _(spark, sf):
    gets = _parsed(spark, sf).where(F.col("request").rlike("^.*/ita/intl/zh/search/.*$"))
    gets = gets.withColumn("pairs", ex.url_pairs(F.col("request")))
    fields = ex.pairs_fields(F.col("pairs"), rules.QUERY_RULES[2])
    return gets.select("event_id", fields["depCity"].alias("dep"), fields["arrCity"].alias("arr"),
                       fields["childNum"].alias("child"), fields["travelType"].alias("travel_type"))


@query("p19_stamped_codes", """
SELECT event_id, q_empty AS is_empty, flight_code AS flight_type, travel_code AS travel_type FROM queried""", "queried")
def _(spark, sf):
    return _queried(spark, sf).select(
        "event_id", F.col("query_data.isEmpty").alias("is_empty"), F.col("query_data.flightType").alias("flight_type"),
        F.col("query_data.travelType").alias("travel_type"))


def _booked(spark: SparkSession, sf: str, rule: int) -> DataFrame:
    one = rules.BOOK_RULES[rule]
    b = F.col("book_data")
    return ex.extract_book(_tagged(spark, sf).where(ex.rule_matches(one)), rules.BOOK_RULES).select(
        "event_id", b["bookUserId"].alias("user_id"), F.array_join(b["psgName"], ",").alias("names"),
        F.array_join(b["idType"], ",").alias("id_types"), b["contractName"].alias("contact"),
        F.array_join(b["depCity"], ",").alias("dep"), F.array_join(b["cabin"], ",").alias("cabin"))


@query("p20_booking_from_xml", f"""
SELECT event_id, {_tag('USER')} AS user_id, array_to_string({_tags('NAME')}, ',') AS names,
 array_to_string({_tags('IDT')}, ',') AS id_types, split_part({_tag('CONTACT')}, '|', 1) AS contact,
 {_tag('DEP')} AS dep, {_tag('CABIN')} AS cabin FROM typed WHERE {_NAT_B}""", "typed")
def _(spark, sf):
    return _booked(spark, sf, 0)


def _jl(path: str) -> str:
    return f"json_extract_string(request_body, '$.passengers[*].{path}')"


@query("p21_booking_from_json", f"""
SELECT event_id, json_extract_string(request_body, '$.user') AS user_id,
 array_to_string(list_transform(list_zip({_jl('first')}, {_jl('last')}), lambda x: concat(x[1], x[2])), ',') AS names,
 array_to_string({_jl('idtype')}, ',') AS id_types, json_extract_string(request_body, '$.contact.name') AS contact,
 json_extract_string(request_body, '$.seg.dep') AS dep, json_extract_string(request_body, '$.seg.cabin') AS cabin
FROM typed WHERE {_INT_B}""", "typed")
def _(spark, sf):
    return _booked(spark, sf, 1)


@query("p22_booking_digests", f"""
SELECT event_id, flight_code AS flight_type, travel_code AS travel_type,
 upper(md5(CASE WHEN {_NAT_B} THEN split_part({_tag('TEL')}, '/', 1)
  ELSE json_extract_string(request_body, '$.contact.mobile') END)) AS phone,
 array_to_string(list_transform(CASE WHEN {_NAT_B} THEN {_tags('ID')} ELSE {_jl('id')} END,
  lambda x: upper(md5(x))), ',') AS ids
FROM queried WHERE behavior_type = 'Book'""", "queried")
def _(spark, sf):
    b = F.col("book_data")
    return ex.extract_book(_tagged(spark, sf).where("behavior_type = 'Book'"), rules.BOOK_RULES).select(
        "event_id", b["flightType"].alias("flight_type"), b["travelType"].alias("travel_type"),
        b["contractPhone"].alias("phone"), F.array_join(b["idCard"], ",").alias("ids"))


@query("p23_core_params", f"""
SELECT event_id, CASE WHEN {_NAT_B} THEN {_tag('DATE')} WHEN {_INT_B} THEN json_extract_string(request_body, '$.seg.date')
  ELSE q_date END AS flight_date,
 CASE WHEN {_NAT_B} THEN {_tag('DEP')} WHEN {_INT_B} THEN json_extract_string(request_body, '$.seg.dep')
  ELSE q_dep END AS depcity,
 CASE WHEN {_NAT_B} THEN {_tag('ARR')} WHEN {_INT_B} THEN json_extract_string(request_body, '$.seg.arr')
  ELSE q_arr END AS arrcity FROM queried""", "queried")
def _(spark, sf):
    return process_lines(adapter.raw_lines(spark, sf), Site()).select("event_id", "flight_date", "depcity", "arrcity")


_BOOK_DEFAULT = ('{"flightType":-1,"travelType":-1,"bookTime":"","bookUserId":"","bookUnUserId":"","bookIp":"",'
                 '"psgName":[],"psgType":[],"idType":[],"idCard":[],"contractName":"",'
                 '"contractPhone":"D41D8CD98F00B204E9800998ECF8427E","bookAgent":"","depCity":[],"arrCity":[],'
                 '"flightDate":[],"flightNo":[],"cabin":[]}')


def _nn(expr: str) -> str:
    return f"coalesce(nullif({expr}, ''), 'NULL')"


@query("p24_processed_line", with_ctes("", "queried", "parsed").rstrip() + "," + _COOKIE_PAIRS + f"""
SELECT q.event_id, concat_ws('#CS#', 'NULL', request_method, request, remote_addr, http_user_agent, time_iso8601,
 {_nn('server_addr')}, 'false', flight_type, behavior_type, travel_type, {_nn('q_date')}, {_nn('q_dep')},
 {_nn('q_arr')}, coalesce(s.v, 'NULL'), coalesce({_MASK.format('upper(md5(u.v))', IDENTITY)}, 'NULL'),
 concat('{{"isEmpty":', q_empty, ',"flightType":', flight_code,
  ',"queryTime":"","queryUserId":"","queryUnUserId":"","queryIp":"","depCity":"', q_dep, '","arrCity":"', q_arr,
  '","flightDate":"', q_date, '","adultNum":"', q_adult, '","childNum":"', q_child, '","infantNum":"', q_infant,
  '","country":"', q_country, '","travelType":', travel_code, '}}'),
 '{_BOOK_DEFAULT}', http_referrer) AS line
FROM queried q LEFT JOIN cookies s ON s.event_id = q.event_id AND s.k = 'JSESSIONID'
LEFT JOIN cookies u ON u.event_id = q.event_id AND u.k = 'userId4logCookie'
WHERE behavior_type = 'Query'""")
def _(spark, sf):
    lines = processed_lines(adapter.raw_lines(spark, sf), Site(), keep=["event_id"])
    return lines.where("behavior_type = 'Query'").select("event_id", F.col("value").alias("line"))


@query("p25_line_round_trip", """
SELECT event_id, request, remote_addr, http_user_agent, false AS high_freq_ip, flight_type, behavior_type, travel_type,
 flight_date, depcity, arrcity, jsessionid, userid, epoch_ms(date_trunc('second', ts)) AS event_ms FROM requests""",
       "requests")
def _(spark, sf):
    lines = to_line(adapter.requests(spark, sf).withColumn("high_freq_ip", F.lit(False))).select("event_id", "value")
    return from_line(lines).select(
        "event_id", "request", "remote_addr", "http_user_agent", "high_freq_ip", "flight_type", "behavior_type",
        "travel_type", "flight_date", "depcity", "arrcity", "jsessionid", "userid",
        F.unix_millis("event_time").alias("event_ms"))


@query("p26_xml_fields", f"""
SELECT event_id, concat('name', i - 1) AS node_key, v AS node_value FROM (
 SELECT event_id, unnest({_tags('NAME')}) AS v, generate_subscripts({_tags('NAME')}, 1) AS i FROM typed WHERE {_NAT_B})
UNION ALL SELECT event_id, 'dep0', {_tag('DEP')} FROM typed WHERE {_NAT_B}""", "typed")
def _(spark, sf):
    bodies = _tagged(spark, sf).where(ex.rule_matches(rules.BOOK_RULES[0])).select("event_id", "request_body")
    nodes = ex.xml_fields(bodies, "request_body", {"name": "//PSG/NAME/text()", "dep": "//DEP/text()"})
    return nodes.select("event_id", F.col("key").alias("node_key"), F.col("value").alias("node_value"))


@query("p27_xml_travel_type", f"""
SELECT event_id, CASE WHEN NOT ends_with(request_body, '</page>') THEN 'Unknown' ELSE
 CASE {_tag('SEGTYPE')} WHEN 'S' THEN 'OneWay' WHEN 'R' THEN 'RoundTrip' ELSE 'Unknown' END END AS xml_travel_type
FROM parsed WHERE content_type = 'text/xml'""", "parsed")
def _(spark, sf):
    bodies = _parsed(spark, sf).where("content_type = 'text/xml'").select("event_id", "request_body")
    return ex.xml_travel_type(bodies, "request_body").select("event_id", "xml_travel_type")


@query("p28_json_map", "SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS val FROM events")
def _(spark, sf):
    events = ex.json_map(adapter.read(spark, sf, "events"), "props")
    return events.select("event_id", F.explode("json_map").alias("name", "val"))


@query("p29_address_block", """
SELECT event_id, CASE WHEN len(string_split(remote_addr, '.')) = 4
 THEN concat(split_part(remote_addr, '.', 1), '.', split_part(remote_addr, '.', 2)) ELSE '' END AS ip_block
FROM requests""", "requests")
def _(spark, sf):
    return adapter.requests(spark, sf).select("event_id", ip_block(F.col("remote_addr")).alias("ip_block"))


@query("p30_time_to_millis", "SELECT event_id, epoch_ms(date_trunc('second', ts)) AS ms FROM events")
def _(spark, sf):
    return adapter.requests(spark, sf).select("event_id", iso_millis(F.col("time_iso8601")).alias("ms"))


_STAGE = """CASE WHEN regexp_full_match({0}, '^.*/bookingnew/.*$') OR regexp_full_match({0}, '^.*/bookingGroup/.*$')
 OR regexp_full_match({0}, '^.*/ita/intl/zh/shop/.*$') THEN '1'
 WHEN regexp_full_match({0}, '^.*/modules/permissionnew/.*$') OR regexp_full_match({0}, '^.*/ita/intl/zh/passengers/.*$')
 THEN '2' WHEN regexp_full_match({0}, '^.*upp_payment/pay/.*$') THEN '3' ELSE '0' END"""
STAGE_SQL = _STAGE.format("request")


@query("p31_stage_tag", f"""
SELECT event_id, {STAGE_SQL} AS stage FROM (SELECT event_id, request FROM requests
 UNION ALL SELECT -1 - event_id, request FROM parsed)""", "requests", "parsed")
def _(spark, sf):
    lines = adapter.raw_lines(spark, sf).select(
        (-1 - F.col("event_id")).alias("event_id"), request_url(F.col("value")).alias("request"))
    both = adapter.requests(spark, sf).select("event_id", "request").unionByName(lines)
    return both.select("event_id", stage_tag(F.col("request")).alias("stage"))


@query("p32_spider_tag", """
SELECT remote_addr, flow_id, CASE WHEN flow_id IS NULL OR lower(flow_id) = 'null' THEN '0' ELSE '1' END AS spider
FROM (SELECT remote_addr, flow_id FROM spiders UNION ALL SELECT remote_addr, NULL FROM requests)""",
       "spiders", "requests")
def _(spark, sf):
    plain = adapter.requests(spark, sf).select("remote_addr", F.lit(None).cast("string").alias("flow_id"))
    both = adapter.spiders(spark, sf).select("remote_addr", "flow_id").unionByName(plain)
    return both.select("remote_addr", "flow_id", spider_tag(F.col("flow_id")).alias("spider"))


# --- filters on records ---

@query("f1_noise_filter", "SELECT event_id, request FROM kept", "kept")
def _(spark, sf):
    return tagged_requests(adapter.raw_lines(spark, sf), Site()).select("event_id", "request")


_CRITICAL = (r"(regexp_full_match(request, '^.*query\.ao.*$') OR regexp_full_match(request, '^.*bookingnew.*$'))")


@query("f2_critical_pages", f"SELECT event_id, {_CRITICAL} AS is_critical FROM requests", "requests")
def _(spark, sf):
    from skywarden.operators.tag import critical

    return adapter.requests(spark, sf).select("event_id", critical(rules.CRITICAL).alias("is_critical"))


@query("f3_behavior_route", "SELECT event_id, behavior_type FROM requests WHERE behavior_type = 'Book'", "requests")
def _(spark, sf):
    from skywarden.sources.writers import of_behavior

    return of_behavior(adapter.requests(spark, sf), 1).select("event_id", "behavior_type")


@query("f5_known_session", "SELECT event_id, jsessionid FROM requests WHERE NOT contains(jsessionid, 'NULL')", "requests")
def _(spark, sf):
    from skywarden.operators.tag import with_known_session

    return with_known_session(adapter.requests(spark, sf)).select("event_id", "jsessionid")
