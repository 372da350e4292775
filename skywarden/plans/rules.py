"""A small site configuration: noise, critical pages, classes, parse rules and scoring flows."""

from __future__ import annotations

from skywarden.schema import ClassifyRule, Flow, ParseRule, ScoreRule

NOISE = [r"^.*\.(css|js|png|jpg).*$"]
CRITICAL = [r"^.*query\.ao.*$", r"^.*bookingnew.*$"]

CLASSIFY = [
    ClassifyRule(0, 0, r"^.*/query/(jaxb/direct|xml)/query\.ao.*$"),
    ClassifyRule(0, 1, r"^.*/bookingnew/.*$"),
    ClassifyRule(1, 0, r"^.*/ita/intl/zh/(search|form)/.*$"),
    ClassifyRule(1, 1, r"^.*/ita/intl/zh/passengers/.*$"),
]

_FORM = {"depCity": "dep", "arrCity": "arr", "flightDate": "date", "adultNum": "adult", "childNum": "child",
         "infantNum": "infant", "country": "country", "travelType": "type"}

QUERY_RULES = [
    ParseRule(0, 0, r"^.*/query/jaxb/.*$", "POST", json=True, form_field="json", query={
        "depCity": "$.depcity", "arrCity": "$.arrcity", "flightDate": "$.flightdate", "adultNum": "$.adultnum",
        "childNum": "$.childnum", "infantNum": "$.infantnum"}),
    ParseRule(0, 0, r"^.*/query/xml/.*$", "POST", text_xml=True, xml=True, query={
        "depCity": "//DEP/text()", "arrCity": "//ARR/text()", "flightDate": "//DATE/text()",
        "adultNum": "//ADULT/text()"}),
    ParseRule(1, 0, r"^.*/ita/intl/zh/search/.*$", "GET", normal_get=True, query=_FORM),
    ParseRule(1, 0, r"^.*/ita/intl/zh/form/.*$", "POST", normal_form=True, query=_FORM),
]

BOOK_RULES = [
    ParseRule(0, 1, r"^.*/bookingnew/.*$", "POST", text_xml=True, xml=True, book={
        "bookUserId": "//USER/text()", "psgName": "//PSG/NAME/text()", "psgType": "//PSG/TYPE/text()",
        "idType": "//PSG/IDT/text()", "idCard": "//PSG/ID/text()", "contractName": "//CONTACT/text()",
        "contractPhone": "//TEL/text()", "depCity": "//DEP/text()", "arrCity": "//ARR/text()",
        "flightDate": "//DATE/text()", "cabin": "//CABIN/text()"}),
    ParseRule(1, 1, r"^.*/ita/intl/zh/passengers/.*$", "POST", application_json=True, json=True, book={
        "bookUserId": "$.user", "psgFirName": "$.passengers[*].first", "psgName": "$.passengers[*].last",
        "idType": "$.passengers[*].idtype", "idCard": "$.passengers[*].id", "contractName": "$.contact.name",
        "contractPhone": "$.contact.mobile", "depCity": "$.seg.dep", "arrCity": "$.seg.arr",
        "flightDate": "$.seg.date", "flightNo": "$.seg.no", "cabin": "$.seg.cabin"}),
]

# Limits suit one-day windows: a busy address makes a few dozen requests there.
FLOWS = [
    Flow("f1", "daily volume", 30.0, (
        ScoreRule("ip", 0, 18, 0, 6), ScoreRule("criticalPages", 0, 8, 0, 7), ScoreRule("userAgent", 1, 3, 0, 5),
        ScoreRule("ipBlock", 0, 115, 0, 8), ScoreRule("flightQuery", 0, 11, 0, 4))),
    Flow("f2", "fast clicks", 25.0, (
        ScoreRule("criticalPagesLessThanDefault", 0, 0, 0, 9), ScoreRule("criticalCookies", 0, 5, 0, 3),
        ScoreRule("criticalPagesAccTime", 1, 3_600_000, 0, 2))),
]
# Gap limit that goes with these flows.
GAP_MS = 600_000
WINDOW = "1 day"
