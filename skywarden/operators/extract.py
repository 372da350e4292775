"""Query and booking records out of request bodies, driven by parse rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skywarden.functions.codec import md5_upper, url_decode
from skywarden.functions.documents import (
    as_list, json_found, json_text, with_xml_page, xpath_list, xpath_text, xpath_texts,
)
from skywarden.functions.text import full_match, key_values, last_value
from skywarden.schema import (
    BEHAVIOR_CODES, BOOK_SCHEMA, FLIGHT_CODES, QUERY_SCHEMA, TRAVEL_CODES, ParseRule, code_of,
)

QUERY_FIELDS = ("depCity", "arrCity", "flightDate", "adultNum", "childNum", "infantNum", "country")
BOOK_TEXTS = ("bookUserId", "bookUnUserId", "contractName", "contractPhone")
BOOK_JSON = ("bookUserId", "contractName", "contractPhone", "psgFirName", "psgName", "idType", "idCard", "depCity",
             "arrCity", "flightDate", "flightNo", "cabin")
BOOK_LISTS = ("psgName", "psgType", "idType", "idCard", "depCity", "arrCity", "flightDate", "cabin")


def url_pairs(request: Column) -> Column:
    """Parameters between the first and the second question mark, not decoded."""
    return key_values(F.coalesce(F.get(F.split(request, r"\?"), F.lit(1)), F.lit("")), "&")


def form_pairs(body: Column) -> Column:
    """Form parameters with decoded values."""
    return F.transform(
        key_values(body, "&"),
        lambda p: F.struct(p["k"].alias("k"), url_decode(p["v"]).alias("v")))


def rule_matches(rule: ParseRule) -> Column:
    """Method and behavior equal, URL matched as a whole."""
    behavior = code_of(F.col("behavior_type"), BEHAVIOR_CODES)
    return ((F.lower("request_method") == rule.method.lower())
            & (behavior == rule.behavior_type)
            & full_match(F.col("request"), rule.expression))


def matched_rule(rules: Sequence[ParseRule]) -> Column:
    """Number of the rule that applies: the last one that matches, null when none does."""
    out = F.lit(None).cast("int")
    for i, rule in enumerate(rules):
        out = F.when(rule_matches(rule), F.lit(i)).otherwise(out)
    return out


def _record(schema: T.StructType, values: dict[str, Column]) -> Column:
    cols = []
    for f in schema.fields:
        rest = F.array() if f.dataType.typeName() == "array" else F.lit("")
        cols.append(values.get(f.name, rest).cast(f.dataType).alias(f.name))
    return F.struct(*cols)


def _by_rule(number: Column, values: dict[int, Column], rest: Column) -> Column:
    """The value that goes with the matched rule."""
    out = rest
    for i, value in values.items():
        out = F.when(number == i, value).otherwise(out)
    return out


def _to_int(value: Column) -> Column:
    return F.coalesce(F.trim(value).try_cast("int"), F.lit(-1))


def _blank_to_empty(value: Column) -> Column:
    return F.when(F.trim(value) == "", F.lit("")).otherwise(value)


def pair_value(pairs: Column, key: str | None) -> Column:
    return F.coalesce(last_value(pairs, key or ""), F.lit(""))


def pairs_fields(pairs: Column, rule: ParseRule) -> dict[str, Column]:
    """Query fields out of parameters; a travel type that is no number is unknown."""
    out = {f: pair_value(pairs, rule.query.get(f)) for f in QUERY_FIELDS}
    out["travelType"] = _to_int(pair_value(pairs, rule.query.get("travelType")))
    return out


def json_fields(document: Column, rule: ParseRule) -> dict[str, Column]:
    return {f: json_text(document, rule.query.get(f)) for f in QUERY_FIELDS}


def xml_query_fields(texts: Column, rule: ParseRule) -> dict[str, Column]:
    """Query fields out of the texts at the rule's XPaths, in field order."""
    return {f: _blank_to_empty(F.coalesce(F.get(texts, F.lit(i)), F.lit("")))
            for i, f in enumerate(QUERY_FIELDS)}


def _query_kind(rule: ParseRule) -> str | None:
    """Which reader a rule asks for."""
    method = rule.method.upper()
    if method == "GET" and rule.normal_get:
        return "url"
    if method != "POST":
        return None
    if rule.normal_form:
        return "form"
    if rule.json and rule.form_field:
        return "json"
    return "xml" if rule.text_xml and rule.xml else None


def extract_query(df: DataFrame, rules: Sequence[ParseRule], flight_type: str = "flight") -> DataFrame:
    """Add ``query_data``. Needs the parsed request columns and the three type tags.

    ``flight_type="behavior"`` stores the behavior code in the record's flight type, as older readers expect.
    Each body is taken apart once: rule number, then parameters or page, then JSON text, then fields.
    """
    kinds = {i: _query_kind(r) for i, r in enumerate(rules)}

    def of(*names: str) -> list[int]:
        return [i for i, kind in kinds.items() if kind in names]

    number, body = F.col("_rule"), F.col("request_body")
    df = df.withColumn("_rule", matched_rule(rules))
    pairs = F.when(number.isin(of("url")), url_pairs(F.col("request"))) if of("url") else F.lit(None)
    pairs = F.when(number.isin(of("form", "json")), form_pairs(body)).otherwise(pairs)
    df = df.withColumn("_pairs", pairs.cast("array<struct<k:string,v:string>>"))
    df = df.withColumn("_doc", _by_rule(
        number, {i: last_value(F.col("_pairs"), rules[i].form_field) for i in of("json")}, F.lit(None).cast("string")))
    if of("xml"):
        is_xml = number.isin(of("xml")) & (F.lower("content_type") == "text/xml") & (body != "")
        df = with_xml_page(df, F.when(is_xml, body))
    else:
        df = df.withColumn("_page", F.lit(None).cast("string"))
    df = df.withColumn("_texts", _by_rule(
        number, {i: xpath_texts(F.col("_page"), [rules[i].query.get(f) for f in QUERY_FIELDS]) for i in of("xml")},
        F.lit(None).cast("array<string>")))

    readers = {"url": ("_pairs", pairs_fields), "form": ("_pairs", pairs_fields), "json": ("_doc", json_fields),
               "xml": ("_texts", xml_query_fields)}
    per_rule = {i: readers[kind][1](F.col(readers[kind][0]), rules[i]) for i, kind in kinds.items() if kind}
    values = {f: _by_rule(number, {i: v[f] for i, v in per_rule.items()}, F.lit("")) for f in QUERY_FIELDS}
    # A record is filled when its reader found something to read.
    values["isEmpty"] = ~F.coalesce(
        (F.size("_pairs") > 0) & number.isin(of("url", "form")) | (F.trim("_doc") != "") | F.col("_page").isNotNull(),
        F.lit(False))
    values["flightType"] = (code_of(F.col("behavior_type"), BEHAVIOR_CODES) if flight_type == "behavior"
                            else code_of(F.col("flight_type"), FLIGHT_CODES))
    values["travelType"] = code_of(F.col("travel_type"), TRAVEL_CODES)
    return (df.withColumn("query_data", _record(QUERY_SCHEMA, values))
            .drop("_rule", "_pairs", "_doc", "_page", "_texts"))


def form_json(text: Column) -> Column:
    """JSON text of a form field without one pair of outer brackets."""
    return F.when(text.startswith("[") & text.endswith("]"),
                  F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)


def xml_book_fields(page: Column, texts: Column, rule: ParseRule) -> dict[str, Column]:
    """Booking fields by XPath; contact name ends at a bar, contact phone at a slash."""
    out = {name: xpath_list(page, rule.book.get(name)) for name in BOOK_LISTS}
    for i, name in enumerate(BOOK_TEXTS):
        out[name] = F.coalesce(F.get(texts, F.lit(i)), F.lit(""))
    out["contractName"] = F.substring_index(out["contractName"], "|", 1)
    out["contractPhone"] = F.substring_index(out["contractPhone"], "/", 1)
    return out


def json_book_fields(found: Column) -> dict[str, Column]:
    """Booking fields out of the values at the JSON paths; passenger names are first and last name joined."""
    at = {name: F.get(found, F.lit(i)) for i, name in enumerate(BOOK_JSON)}
    out = {name: F.coalesce(at[name], F.lit("")) for name in ("bookUserId", "contractName", "contractPhone")}
    both = F.zip_with(as_list(at["psgFirName"]), as_list(at["psgName"]), lambda a, b: F.when(
        a.isNotNull(), F.concat(a, F.coalesce(b, F.lit("")))))
    out["psgName"] = F.filter(both, lambda x: x.isNotNull())
    for name in ("idType", "idCard"):
        out[name] = as_list(at[name])
    for name in ("depCity", "arrCity", "flightDate", "flightNo", "cabin"):
        out[name] = F.filter(F.array(at[name]), lambda x: x.isNotNull())
    return out


def extract_book(df: DataFrame, rules: Sequence[ParseRule]) -> DataFrame:
    """Add ``book_data`` with contact phone and identity numbers digested."""
    number, body, content = F.col("_rule"), F.col("request_body"), F.lower("content_type")
    xml = [i for i, r in enumerate(rules) if r.text_xml and r.xml]
    plain = [i for i, r in enumerate(rules) if not r.normal_form and r.application_json and r.json]
    field = [i for i, r in enumerate(rules) if not r.normal_form and r.json and not r.application_json and r.form_field]
    df = df.withColumn("_rule", matched_rule(rules))
    if xml:
        df = with_xml_page(df, F.when(number.isin(xml) & (content == "text/xml") & (body != ""), body))
    else:
        df = df.withColumn("_page", F.lit(None).cast("string"))
    df = df.withColumn("_texts", _by_rule(
        number, {i: xpath_texts(F.col("_page"), [rules[i].book.get(n) for n in BOOK_TEXTS]) for i in xml},
        F.lit(None).cast("array<string>")))
    document = F.when(number.isin(plain) & (content == "application/json"), body)
    for i in field:
        document = F.when(number == i, form_json(last_value(form_pairs(body), rules[i].form_field))).otherwise(document)
    # Quotes that were escaped as \\x22 are dropped.
    df = df.withColumn("_doc", F.trim(F.replace(document, F.lit("\\x22"), F.lit(""))))
    df = df.withColumn("_found", _by_rule(
        number, {i: json_found(F.col("_doc"), [rules[i].book.get(n) for n in BOOK_JSON]) for i in [*plain, *field]},
        F.lit(None).cast("array<string>")))

    per_rule = {}
    for i, rule in enumerate(rules):
        fields = {}
        if i in plain or i in field:
            fields = json_book_fields(F.col("_found"))
        if i in xml:
            pages = xml_book_fields(F.col("_page"), F.col("_texts"), rule)
            fields = {n: F.when(F.col("_page").isNotNull(), v).otherwise(fields[n]) if n in fields else v
                      for n, v in {**fields, **pages}.items()}
        per_rule[i] = fields
    values = {}
    for f in BOOK_SCHEMA.fields:
        rest = F.array().cast("array<string>") if f.dataType.typeName() == "array" else F.lit("")
        values[f.name] = _by_rule(number, {i: v[f.name] for i, v in per_rule.items() if f.name in v}, rest)
    values["contractPhone"] = md5_upper(values["contractPhone"])
    values["idCard"] = F.transform(values["idCard"], md5_upper)
    # Only national and international rules stamp the type codes.
    known = {i: r.flight_type for i, r in enumerate(rules) if r.flight_type in (0, 1)}
    values["flightType"] = _by_rule(number, {i: F.lit(code) for i, code in known.items()}, F.lit(-1))
    values["travelType"] = _by_rule(
        number, {i: code_of(F.col("travel_type"), TRAVEL_CODES) for i in known}, F.lit(-1))
    return df.withColumn("book_data", _record(BOOK_SCHEMA, values)).drop("_rule", "_page", "_texts", "_doc", "_found")


def core_params(df: DataFrame, book_fallback: bool = True) -> DataFrame:
    """``flight_date``, ``depcity``, ``arrcity`` from the query record, else from the booking record."""
    out = {}
    for column, name in (("flight_date", "flightDate"), ("depcity", "depCity"), ("arrcity", "arrCity")):
        value = F.col("query_data")[name]
        if book_fallback:
            value = F.when(F.coalesce(value, F.lit("")) != "", value).otherwise(
                F.coalesce(F.array_join(F.col("book_data")[name], ""), F.lit("")))
        out[column] = F.coalesce(value, F.lit(""))
    return df.withColumns(out)


def xml_fields(df: DataFrame, column: str, paths: dict[str, str]) -> DataFrame:
    """One row per node found: ``key`` is the path name followed by the node number."""
    def nodes(name: str, path: str) -> Column:
        return F.transform(
            xpath_list(F.col("_page"), path),
            lambda v, i: F.struct(F.concat(F.lit(name), i.cast("string")).alias("key"), v.alias("value")))

    found = F.array(*[nodes(name, path) for name, path in paths.items()])
    return (with_xml_page(df, F.col(column))
            .withColumn("_node", F.explode(F.flatten(found)))
            .select(*df.columns, "_node.key", "_node.value"))


def xml_travel_type(df: DataFrame, column: str) -> DataFrame:
    """``xml_travel_type`` by the segment type of the first page element: S one way, R round trip."""
    body = F.col(column)
    # The document ends with the first closing root tag, whatever follows.
    cut = F.when(body.contains("</page>"), F.concat(F.substring_index(body, "</page>", 1), F.lit("</page>")))
    return (with_xml_page(df, cut)
            .withColumn("_segment", xpath_text(F.col("_page"), "//SEGTYPE/text()"))
            .withColumn("xml_travel_type", F.when(F.col("_segment") == "S", "OneWay")
                        .when(F.col("_segment") == "R", "RoundTrip").otherwise("Unknown"))
            .drop("_page", "_segment"))


def json_map(df: DataFrame, column: str, into: str = "json_map") -> DataFrame:
    """JSON object to a string map; text that is no object gives an empty map."""
    return df.withColumn(into, F.coalesce(
        F.from_json(F.col(column), "map<string,string>"), F.create_map().cast("map<string,string>")))
