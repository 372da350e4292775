"""Column layouts and code tables shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field separator of raw and processed lines.
SEPARATOR = "#CS#"

# Type names and their codes.
BEHAVIOR_CODES = {"Query": 0, "Book": 1, "Other": -1}
FLIGHT_CODES = {"National": 0, "International": 1, "Other": -1}
TRAVEL_CODES = {"OneWay": 0, "RoundTrip": 1, "Unknown": -1}

# The processed line, slot by slot.
LINE_SLOTS = [
    "source_data", "request_method", "request", "remote_addr", "http_user_agent", "time_iso8601",
    "server_addr", "high_freq_ip", "flight_type", "behavior_type", "travel_type", "flight_date",
    "depcity", "arrcity", "jsessionid", "userid", "query_json", "book_json", "http_referrer",
]

# JSON field names of the query and booking records.
QUERY_SCHEMA = T.StructType([
    T.StructField("isEmpty", T.BooleanType()),
    T.StructField("flightType", T.IntegerType()),
    T.StructField("queryTime", T.StringType()),
    T.StructField("queryUserId", T.StringType()),
    T.StructField("queryUnUserId", T.StringType()),
    T.StructField("queryIp", T.StringType()),
    T.StructField("depCity", T.StringType()),
    T.StructField("arrCity", T.StringType()),
    T.StructField("flightDate", T.StringType()),
    T.StructField("adultNum", T.StringType()),
    T.StructField("childNum", T.StringType()),
    T.StructField("infantNum", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("travelType", T.IntegerType()),
])

_LIST = T.ArrayType(T.StringType())
BOOK_SCHEMA = T.StructType([
    T.StructField("flightType", T.IntegerType()),
    T.StructField("travelType", T.IntegerType()),
    T.StructField("bookTime", T.StringType()),
    T.StructField("bookUserId", T.StringType()),
    T.StructField("bookUnUserId", T.StringType()),
    T.StructField("bookIp", T.StringType()),
    T.StructField("psgName", _LIST),
    T.StructField("psgType", _LIST),
    T.StructField("idType", _LIST),
    T.StructField("idCard", _LIST),
    T.StructField("contractName", T.StringType()),
    T.StructField("contractPhone", T.StringType()),
    T.StructField("bookAgent", T.StringType()),
    T.StructField("depCity", _LIST),
    T.StructField("arrCity", _LIST),
    T.StructField("flightDate", _LIST),
    T.StructField("flightNo", _LIST),
    T.StructField("cabin", _LIST),
])

SPIDER_SCHEMA = "remote_addr string, flow_id string, score string, strategic_id string"
BACKUP_SCHEMA = "key_exp_time string, key string, value string"
KEYED_SCHEMA = "key string, value string, expire_at timestamp, written_at timestamp"


def code_of(value: Column, codes: dict[str, int]) -> Column:
    """Name to code; unknown names get the code of the rest class."""
    out = F.lit(-1)
    for name, code in codes.items():
        out = F.when(value == name, F.lit(code)).otherwise(out)
    return out


@dataclass(frozen=True)
class ClassifyRule:
    flight_type: int
    operation_type: int
    expression: str


@dataclass(frozen=True)
class ParseRule:
    """How to pull query or booking fields out of one kind of request.

    ``query`` and ``book`` map record fields to parameter names, JSON paths or XPaths, by format.
    """

    flight_type: int
    behavior_type: int
    expression: str
    method: str
    normal_get: bool = False
    normal_form: bool = False
    application_json: bool = False
    text_xml: bool = False
    json: bool = False
    xml: bool = False
    form_field: str = ""
    query: dict[str, str] = field(default_factory=dict)
    book: dict[str, str] = field(default_factory=dict)

    def __hash__(self) -> int:
        return hash((self.expression, self.method, self.behavior_type, self.flight_type))


@dataclass(frozen=True)
class ScoreRule:
    """One threshold test on a metric. ``status`` 0 is enabled."""

    name: str
    status: int
    arg0: float
    arg1: float
    score: int
    comparator: str = ">"

    @property
    def limit(self) -> float:
        # Fixed value: the one metric that is held against the second argument.
        return self.arg1 if self.name == "criticalPagesLessThanDefault" else self.arg0


@dataclass(frozen=True)
class Flow:
    flow_id: str
    name: str
    limit: float
    rules: tuple[ScoreRule, ...]
