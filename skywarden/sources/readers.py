"""Scans of logs, lists and lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.operators.joins import is_small
from skywarden.schema import LINE_SLOTS, SEPARATOR, SPIDER_SCHEMA, ClassifyRule, Flow, ParseRule, ScoreRule

# Most rows of a rule table that are turned into column expressions; larger ones are joined.
RULE_ROWS = 10_000


def read_raw(spark: SparkSession, fmt: str = "text", options: dict[str, str] | None = None, path: str | None = None,
             streaming: bool = False, schema: str | None = None) -> DataFrame:
    """Raw lines as one ``value`` column from a message topic or from files, as batch or stream."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**(options or {}))
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    if "value" in df.columns and dict(df.dtypes)["value"] == "binary":
        df = df.withColumn("value", F.col("value").cast("string"))
    return df


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Processed lines as string columns, without the leading source slot."""
    parts = F.split("value", SEPARATOR)
    return spark.read.text(path).select(
        *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(LINE_SLOTS) if n != "source_data"])


def read_spider_list(spark: SparkSession, path: str) -> DataFrame:
    """Bar-delimited spider list."""
    return spark.read.csv(path, sep="|", schema=SPIDER_SCHEMA)


def table(spark: SparkSession, source: dict[str, str] | str) -> DataFrame:
    """A lookup table: a parquet path, or reader options with their ``format`` (JDBC and others)."""
    if isinstance(source, str):
        return spark.read.parquet(source)
    options = dict(source)
    return spark.read.format(options.pop("format", "jdbc")).options(**options).load()


def load_lookup(df: DataFrame, column: str, into: str | None = None) -> DataFrame:
    """One column of a lookup table."""
    return df.select(F.col(column).alias(into or column))


def _rule_rows(df: DataFrame) -> list:
    """Rule rows on the driver, after a check that they are few enough to become expressions of a plan."""
    if not is_small(df, RULE_ROWS):
        raise ValueError(f"more than {RULE_ROWS} rules: match_parse_rule_by_join and score_by_join take them as a table")
    return df.collect()


def classify_rules(df: DataFrame) -> DataFrame:
    """Classify rules in the order their classes are tried: national before international, query before booking."""
    known = df.where(F.col("flight_type").isin(0, 1) & F.col("operation_type").isin(0, 1))
    return known.select("flight_type", "operation_type", "expression",
                        (F.col("flight_type") * 2 + F.col("operation_type")).alias("priority"))


def load_classify_rules(df: DataFrame) -> list[ClassifyRule] | DataFrame:
    """Classify rules as a site takes them: a list, or the table itself where it is long."""
    rules = classify_rules(df)
    if not is_small(rules, RULE_ROWS):
        return rules
    return [ClassifyRule(r.flight_type, r.operation_type, r.expression) for r in rules.orderBy("priority").collect()]


def parse_rules(df: DataFrame, behavior: int) -> DataFrame:
    """Parse rules of one behavior."""
    return df.where(F.col("behavior_type").cast("int") == behavior)


def load_parse_rules(df: DataFrame, behavior: int) -> list[ParseRule]:
    out = []
    for r in _rule_rows(parse_rules(df, behavior).orderBy("id")):
        row = r.asDict()

        def flag(name: str, row=row) -> bool:
            return str(row.get(name, "false")).lower() == "true"

        def paths(prefix: str, row=row) -> dict[str, str]:
            return {k[len(prefix):]: v for k, v in row.items() if k.startswith(prefix) and v}

        out.append(ParseRule(
            int(row["flight_type"]), int(row["behavior_type"]), row["requestMatchExpression"], row["requestMethod"],
            flag("isNormalGet"), flag("isNormalForm"), flag("isApplicationJson"), flag("isTextXml"), flag("isJson"),
            flag("isXML"), row.get("formDataField") or "", paths("query_"), paths("book_")))
    return out


def flow_limits(process: DataFrame, strategy: DataFrame, status: int = 0, crawler_type: int = 0) -> DataFrame:
    """Flows of a status with their blacklist limit; crawler type 1 uses the limit against seat holding."""
    limit = "occ_blacklist_thresholds" if crawler_type == 1 else "crawler_blacklist_thresholds"
    return (process.where(F.col("status") == status).join(strategy.select("id", F.col(limit).alias("flow_limit")), "id")
            .select(F.col("id").alias("flow_id"), F.col("process_name").alias("flow_name"), "flow_limit"))


def named_rules(rules: DataFrame, names: DataFrame, crawler_type: int = 0) -> DataFrame:
    """Rules of a crawler type with the metric they test."""
    return rules.where(F.col("crawler_type") == crawler_type).join(names, "rule_name").select(
        "id", "process_id", F.col("rule_real_name").alias("name"), "rule_type", "status", "arg0", "arg1", "score")


def flow_rules(process: DataFrame, strategy: DataFrame, rules: DataFrame, names: DataFrame, status: int = 0,
               crawler_type: int = 0) -> DataFrame:
    """One row per flow and rule; a flow without rules has one row with empty rule columns."""
    flows = flow_limits(process, strategy, status, crawler_type)
    named = named_rules(rules, names, crawler_type).withColumnRenamed("process_id", "flow_id")
    return flows.join(named, "flow_id", "left")


def flow_rows_view(rows: DataFrame) -> DataFrame:
    """The columns of ``flow_rules`` that scoring reads."""
    return rows.select("flow_id", "flow_name", "flow_limit", "id", "name", "status", "arg0", "arg1")


def load_flows(rows: DataFrame) -> list[Flow]:
    """Flows as objects out of ``flow_rules``, rules in id order."""
    flows: dict[str, dict] = {}
    for r in _rule_rows(rows.orderBy("flow_id", "id")):
        flow = flows.setdefault(str(r.flow_id), {"name": r.flow_name, "limit": float(r.flow_limit), "rules": []})
        if r.name is not None:
            flow["rules"].append(ScoreRule(r.name, int(r.status), float(r.arg0), float(r.arg1), int(r.score)))
    return [Flow(k, f["name"], f["limit"], tuple(f["rules"])) for k, f in flows.items()]
