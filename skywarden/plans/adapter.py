"""Access-log tables derived from the given event table.

Every derivation is one SELECT that Spark and the checking engine evaluate alike, so both sides start from the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.operators.joins import salted_join
from skywarden.session import work_dir

_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"
_TS = "CAST(ts AS STRING)"
_DAY = f"substr({_TS}, 1, 10)"
_DAY8 = f"replace({_DAY}, '-', '')"
_ISO = f"concat({_DAY}, 'T', substr({_TS}, 12, 8), '+08:00')"
_PHONE = "concat('138', lpad(CAST(user_id AS STRING), 8, '0'))"
_ID = "concat('1101011990', lpad(CAST(user_id AS STRING), 8, '0'))"
_IP = "CASE WHEN user_id % 50 = 49 THEN '::1' ELSE concat('10.', user_id % 3, '.', user_id % 7, '.1') END"

REQUEST_COLUMNS = {
    "event_id": "event_id",
    "ts": "ts",
    "user_id": "user_id",
    "remote_addr": _IP,
    "request": (
        "CASE event_type WHEN 'view' THEN '/B2C40/query/jaxb/direct/query.ao' "
        "WHEN 'click' THEN '/B2C40/modules/bookingnew/main/select.html' "
        "WHEN 'signup' THEN '/modules/permissionnew/p' WHEN 'purchase' THEN '/upp_payment/pay/p' "
        "ELSE '/B2C40/dist/main/css/flight.css' END"),
    "request_method": "CASE WHEN event_type IN ('view', 'purchase') THEN 'POST' ELSE 'GET' END",
    "http_user_agent": "concat('UA', event_id % 4)",
    "time_iso8601": _ISO,
    "server_addr": "concat('SRV', event_id % 3)",
    "jsessionid": "CASE WHEN event_id % 11 = 0 THEN 'NULL' ELSE concat('S', event_id % 9) END",
    "userid": "concat('U', user_id)",
    "depcity": f"concat('C', {_K} % 5)",
    "arrcity": f"concat('C', {_K} % 4)",
    "flight_date": f"concat('201802', lpad(CAST({_K} % 28 + 1 AS STRING), 2, '0'))",
    "flight_type": "CASE user_id % 2 WHEN 0 THEN 'National' ELSE 'International' END",
    "behavior_type": "CASE event_type WHEN 'view' THEN 'Query' WHEN 'click' THEN 'Book' ELSE 'Other' END",
    "travel_type": "CASE user_id % 3 WHEN 0 THEN 'OneWay' WHEN 1 THEN 'RoundTrip' ELSE 'Unknown' END",
    "contact_name": "concat('N', user_id % 13)",
    "contact_phone": _PHONE,
    "passenger": f"concat('P', {_K} % 10)",
}

_METHOD = "CASE WHEN event_type IN ('click', 'error') THEN 'GET' ELSE 'POST' END"
_URL = f"""CASE event_type
 WHEN 'view' THEN CASE WHEN user_id % 5 = 0 THEN '/B2C40/query/xml/query.ao'
   ELSE '/B2C40/query/jaxb/direct/query.ao' END
 WHEN 'click' THEN concat('/ita/intl/zh/search/?dep=C', {_K} % 5, '&arr=C', {_K} % 4, '&date=', {_DAY8},
   '&adult=', {_K} % 3, '&type=', CASE WHEN {_K} % 6 = 0 THEN 'x' ELSE CAST({_K} % 2 AS STRING) END, '&flag')
 WHEN 'signup' THEN '/ita/intl/zh/form/query'
 WHEN 'purchase' THEN CASE WHEN user_id % 2 = 0 THEN '/B2C40/bookingnew/book' ELSE '/ita/intl/zh/passengers/book' END
 ELSE CASE WHEN event_id % 10 = 0 THEN '' ELSE '/B2C40/dist/main/css/flight.css' END END"""
_CONTENT = """CASE event_type
 WHEN 'view' THEN CASE WHEN user_id % 5 = 0 THEN 'text/xml' ELSE 'application/x-www-form-urlencoded' END
 WHEN 'signup' THEN 'application/x-www-form-urlencoded'
 WHEN 'purchase' THEN CASE WHEN user_id % 2 = 0 THEN 'text/xml' ELSE 'application/json' END ELSE '' END"""
_PSG_XML = (f"concat('<PSG><NAME>A', {_K}, '</NAME><TYPE>ADT</TYPE><IDT>NI</IDT><ID>', {_ID}, '</ID></PSG>', "
            f"CASE WHEN {_K} % 2 = 0 THEN concat('<PSG><NAME>B', {_K}, '</NAME><TYPE>CHD</TYPE><IDT>PP</IDT>"
            f"<ID>E', {_K}, '</ID></PSG>') ELSE '' END)")
_PSG_JSON = (f"concat('{{\"first\":\"A\",\"last\":\"L', {_K}, '\",\"idtype\":\"NI\",\"id\":\"', {_ID}, '\"}}', "
             f"CASE WHEN {_K} % 2 = 0 THEN concat(',{{\"first\":\"B\",\"last\":\"M', {_K}, '\",\"idtype\":\"PP\","
             f"\"id\":\"E', {_K}, '\"}}') ELSE '' END)")
_BODY = f"""CASE event_type
 WHEN 'view' THEN CASE WHEN user_id % 5 = 0 THEN concat('<?xml version="1.0"?><page><DEP>C', {_K} % 5,
   '</DEP><ARR>C', {_K} % 4, '</ARR><DATE>', {_DAY8}, '</DATE><ADULT>', {_K} % 3, '</ADULT>',
   CASE {_K} % 3 WHEN 0 THEN '<SEGTYPE>S</SEGTYPE>' WHEN 1 THEN '<SEGTYPE>R</SEGTYPE>' ELSE '' END,
   CASE WHEN {_K} % 7 = 0 THEN '' ELSE '</page>' END)
  ELSE concat('json=%7B%22depcity%22%3A%22C', {_K} % 5, '%22%2C%22arrcity%22%3A%22C', {_K} % 4,
   '%22%2C%22flightdate%22%3A%22', {_DAY8}, '%22%2C%22adultnum%22%3A%22', {_K} % 3,
   '%22%2C%22childnum%22%3A%220%22%2C%22infantnum%22%3A%220%22%7D&x=1') END
 WHEN 'signup' THEN concat('dep=C', {_K} % 5, '&arr=old&date=', {_DAY8}, '&adult=', {_K} % 3,
   '&country=%E4%B8%AD%E5%9B%BD&type=', {_K} % 2, '&arr=C', {_K} % 4)
 WHEN 'purchase' THEN CASE WHEN user_id % 2 = 0 THEN concat('<page><ORDER><USER>U', user_id, '</USER>', {_PSG_XML},
   '<CONTACT>Li|x</CONTACT><TEL>', {_PHONE}, '/1</TEL><DEP>C', {_K} % 5, '</DEP><ARR>C', {_K} % 4, '</ARR><DATE>',
   {_DAY8}, '</DATE><CABIN>Y</CABIN></ORDER></page>')
  ELSE concat('{{"user":"U', user_id, '","passengers":[', {_PSG_JSON}, '],"contact":{{"name":"Li","mobile":"',
   {_PHONE}, '"}},"seg":{{"dep":"C', {_K} % 5, '","arr":"C', {_K} % 4, '","date":"', {_DAY8},
   '","no":"CZ', {_K}, '","cabin":"F"}}}}') END
 ELSE '' END"""
_REFERRER = f"""concat('http://host/select.html?t=S&c1=C', {_K} % 5,
 CASE WHEN {_K} % 4 >= 1 THEN concat('&d1=', {_DAY}) ELSE '' END,
 CASE WHEN {_K} % 4 >= 2 THEN concat('&d2=', {_DAY}) ELSE '' END,
 CASE WHEN {_K} % 4 >= 3 THEN '&d3=2024-12-31' ELSE '' END)"""
_COOKIES = f"""concat('JSESSIONID=', CASE WHEN event_id % 11 = 0 THEN '' ELSE concat('S', event_id % 9) END,
 '; userId4logCookie=', {_PHONE}, '; lang=%E5%8D%95; a=1=2; b; a=', event_id % 4)"""

RAW_COLUMNS = {
    "event_id": "event_id",
    "ts": "ts",
    "value": f"""concat('NULL#CS#', {_METHOD}, ' ', {_URL}, ' HTTP/1.1#CS#', {_METHOD}, '#CS#', {_CONTENT}, '#CS#',
 {_BODY}, '#CS#', {_REFERRER}, '#CS#', {_IP}, '#CS#', 'UA', event_id % 4, '#CS#', {_ISO},
 CASE WHEN event_id % 17 = 0 THEN '' ELSE concat('#CS#SRV', event_id % 3, '#CS#', {_COOKIES}, '#CS#', {_K}) END)""",
}

SPIDER_COLUMNS = {
    "remote_addr": "remote_addr",
    "flow_id": "CASE WHEN user_id % 7 = 3 AND user_id % 3 = 0 THEN 'null' ELSE concat('F', user_id % 3) END",
    "score": "CAST(round(value) AS STRING)",
    "strategic_id": "concat('ST', user_id % 2)",
}


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def _sql(columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(_select(columns))} FROM events"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed requests, ``event_time`` being the event's time."""
    return (read(spark, sf_dir, "events").selectExpr(*_select(REQUEST_COLUMNS))
            .withColumn("event_time", F.col("ts").cast("timestamp")))


_STAGED: dict[tuple[str, str], str] = {}


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread an input of fewer files than there are cores; larger inputs are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw access records, written once per session as the log that the parsing queries scan.

    Reading them from a table keeps the cost of making them up out of every parsing step.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        path = work_dir(spark, "raw")
        events = spread_scan(read(spark, sf_dir, "events"))
        events.selectExpr(*_select(RAW_COLUMNS)).write.parquet(path)
        _STAGED[key] = path
    return spark.read.schema("event_id long, ts timestamp_ntz, value string").parquet(_STAGED[key])


def staged_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the staged raw lines."""
    return _STAGED[(spark.sparkContext.applicationId, sf_dir)]


def spiders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses whose errors cost more than the average error does, once per error and so with repeats."""
    errors = (read(spark, sf_dir, "events").where("event_type = 'error'")
              .select("user_id", "value", F.expr(_IP).alias("remote_addr"),
                      F.expr("CAST(round(value * 100) AS BIGINT)").alias("cents")))
    totals = errors.groupBy("remote_addr").agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n"))
    mean = totals.agg((F.sum("cents").cast("double") / F.sum("n")).alias("mean"))
    listed = totals.where(F.col("cents") > F.col("n") * mean.scalar()).select("remote_addr")
    # The listed addresses are aggregates of the errors; a hot one is spread over the errors' columns.
    return salted_join(errors, listed, ["remote_addr"], "left_semi", ["user_id", "value"], 4).selectExpr(
        *_select(SPIDER_COLUMNS))


REQUESTS_SQL = _sql(REQUEST_COLUMNS)
RAW_SQL = _sql(RAW_COLUMNS)
SPIDERS_SQL = f"""SELECT {', '.join(_select(SPIDER_COLUMNS))} FROM (
 SELECT user_id, value, {_IP} AS remote_addr FROM events WHERE event_type = 'error') WHERE remote_addr IN (
 SELECT {_IP} FROM events WHERE event_type = 'error' GROUP BY 1
 HAVING sum(CAST(round(value * 100) AS BIGINT)) > count(*) * (SELECT sum(CAST(round(value * 100) AS BIGINT))::DOUBLE
  / count(*) FROM events WHERE event_type = 'error'))"""
