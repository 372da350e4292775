"""Queries on sources, sinks and streams: each runs its stream or write to the end and reads the result back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.operators.line import to_line
from skywarden.operators.slices import slice_states
from skywarden.operators.tag import critical
from skywarden.plans import adapter, rules
from skywarden.plans.catalog_metrics import _DAY, _FIVE, _HOUR, _VEC, _requests, _vectors_sql
from skywarden.plans.catalog_records import with_ctes
from skywarden.plans.catalog_reports import _entries, flow_info
from skywarden.plans.etl import Site, processed_lines
from skywarden.plans.registry import cte, query
from skywarden.schema import BACKUP_SCHEMA
from skywarden.session import work_dir
from skywarden.sources import folders, keyed, writers
from skywarden.sources.archive import HourArchive
from skywarden.sources.readers import read_processed, read_raw, read_spider_list
from skywarden.streaming import jobs, live
from skywarden.streaming.lookups import (SCORING_TABLES, BatchTables, ChangeFlags, Lookups, VersionedTables,
                                         scoring_config)
from skywarden.streaming.windows import WindowTables, metric_batches

_RAW_SCHEMA = "event_id long, ts timestamp_ntz, value string"


def _raw_folder(spark: SparkSession, sf: str) -> str:
    """Folder of the staged raw lines."""
    adapter.raw_lines(spark, sf)
    return adapter.staged_path(spark, sf)


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@query("s1_stream_source", "SELECT event_id, md5(value) AS digest FROM raw", "raw")
def _(spark, sf):
    out = work_dir(spark, "s1")
    stream = read_raw(spark, "parquet", path=_raw_folder(spark, sf), streaming=True, schema=_RAW_SCHEMA)
    _finish(stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/cp")
            .trigger(availableNow=True).start(f"{out}/rows"))
    return spark.read.schema(_RAW_SCHEMA).parquet(f"{out}/rows").select("event_id", F.md5("value").alias("digest"))


@query("s2_resumed_offsets", "SELECT event_id FROM raw", "raw")
def _(spark, sf):
    """Half the files, a restart from the checkpoint, then the rest: every row once."""
    out = work_dir(spark, "s2")
    lines = adapter.raw_lines(spark, sf).select("event_id", "value")

    def each(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/rows"))

    for half in (0, 1):
        lines.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{out}/in")
        stream = read_raw(spark, "parquet", path=f"{out}/in", streaming=True, schema="event_id long, value string")
        _finish(jobs.start(stream, each, f"{out}/cp", interval=None))
    return spark.read.schema("event_id long, value string, batch int").parquet(f"{out}/rows").select("event_id")


@query("s3_routed_lines", """
SELECT event_id, CASE behavior_type WHEN 'Query' THEN 'processedQuery' ELSE 'processedBook' END AS topic FROM typed
WHERE behavior_type IN ('Query', 'Book')""", "typed")
def _(spark, sf):
    out = work_dir(spark, "s3")
    routed = writers.route(processed_lines(adapter.raw_lines(spark, sf), Site(), keep=["event_id"]))
    routed.select("event_id", "topic", "value").write.partitionBy("topic").parquet(out)
    return spark.read.schema("event_id long, value string, topic string").parquet(out).select("event_id", "topic")


_PROCESSED = ("request_method", "request", "remote_addr", "http_user_agent", "time_iso8601", "server_addr",
              "flight_type", "behavior_type", "travel_type", "flight_date", "depcity", "arrcity", "jsessionid", "userid")


@query("s4_processed_scan", f"""
SELECT {', '.join(_PROCESSED)}, 'false' AS high_freq_ip, 'NULL' AS query_json FROM requests""", "requests")
def _(spark, sf):
    out = work_dir(spark, "s4")
    lines = to_line(_requests(spark, sf).withColumn("high_freq_ip", F.lit(False)))
    lines.select("value").write.text(out)
    return read_processed(spark, out).select(*_PROCESSED, "high_freq_ip", "query_json")


@query("s5_spider_list_scan", "SELECT remote_addr, flow_id, score, strategic_id FROM spiders", "spiders")
def _(spark, sf):
    out = work_dir(spark, "s5")
    listed = adapter.spiders(spark, sf)
    listed.select(F.concat_ws("|", *listed.columns).alias("value")).write.text(out)
    return read_spider_list(spark, out)


@query("s10_refreshed_lookup", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN remote_addr IN (SELECT remote_addr FROM spiders WHERE flow_id = 'F0')
 ELSE remote_addr IN (SELECT remote_addr FROM spiders WHERE flow_id = 'F1') END AS flagged FROM requests""",
       "requests", "spiders")
def _(spark, sf):
    """The list changes between two batches; the raised flag makes the second batch use the new one."""
    out = work_dir(spark, "s10")
    listed = adapter.spiders(spark, sf)
    current = {"flow": "F0"}
    flags = ChangeFlags(spark, f"{out}/flags")
    lookups = Lookups({"black": lambda: listed.where(F.col("flow_id") == current["flow"])
                       .select("remote_addr").distinct().withColumn("flagged", F.lit(True))},
                      flags, {"black": "BlackIPChangeFlag"})

    def each(batch: DataFrame, batch_id: int) -> None:
        lookups.refresh()
        tagged = batch.join(lookups["black"], "remote_addr", "left").select(
            "event_id", F.coalesce("flagged", F.lit(False)).alias("flagged"), F.lit(batch_id).alias("batch"))
        (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
         .parquet(f"{out}/rows"))

    rows = _requests(spark, sf).select("event_id", "remote_addr")
    for half, flow in ((0, "F0"), (1, "F1")):
        if flow != current["flow"]:
            current["flow"] = flow
            flags.put("BlackIPChangeFlag", "true")
        rows.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{out}/in")
        stream = jobs.read_file_stream(spark, f"{out}/in", "event_id long, remote_addr string")
        _finish(jobs.start(stream, each, f"{out}/cp", interval=None))
    return spark.read.schema("event_id long, flagged boolean, batch int").parquet(f"{out}/rows").select(
        "event_id", "flagged")


@query("s11_appended_results", """
SELECT concat(day, '-0') AS id, count(*)::DOUBLE AS flow_value FROM funnel_day GROUP BY day
UNION ALL SELECT concat(day, '-1'), count(*)::DOUBLE FROM funnel_day WHERE spider = '1' GROUP BY day""", "funnel_day")
def _(spark, sf):
    out = work_dir(spark, "s11")
    info = flow_info(spark, sf)
    writers.append_result(info.where("flow_type = 0"), out)
    writers.append_result(info.where("flow_type = 1"), out)
    return spark.read.schema("id string, flow_value double").parquet(out)


cte("backup_hours", ("backup",), """
SELECT *, make_timestamp(key_exp_time::BIGINT * 1000) AS expires FROM backup""")


_BACKUPS: dict[tuple[str, str], str] = {}


def _backup_table(spark: SparkSession, sf: str) -> str:
    """Backup of blacklist entries in hourly folders, written once per session."""
    from skywarden.plans.catalog_metrics import _backup

    key = (spark.sparkContext.applicationId, sf)
    if key not in _BACKUPS:
        out = work_dir(spark, "backup")
        rows = _backup(spark, sf).withColumn("at", F.timestamp_millis(F.col("key_exp_time").cast("long")))
        writers.append_hourly(rows, out, "at")
        _BACKUPS[key] = out
    return _BACKUPS[key]


@query("s12_hourly_append", """
SELECT strftime(expires, '%Y-%m-%d') AS dt, strftime(expires, '%H') AS hh, key, value FROM backup_hours""", "backup_hours")
def _(spark, sf):
    out = _backup_table(spark, sf)
    return spark.read.schema(f"{BACKUP_SCHEMA}, dt string, hh string").parquet(out).select("dt", "hh", "key", "value")


@query("s13_recent_hours", """
SELECT key, value FROM backup_hours WHERE expires >= TIMESTAMP '2024-01-15 11:00:00'
AND expires < TIMESTAMP '2024-01-15 13:00:00'""", "backup_hours")
def _(spark, sf):
    return writers.read_recent_hours(spark, _backup_table(spark, sf), "2024-01-15 12:20:00",
                                     BACKUP_SCHEMA).select("key", "value")


@query("s14_archived_lines", """
SELECT event_id, md5(value) AS digest, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hh FROM raw""", "raw")
def _(spark, sf):
    out = work_dir(spark, "s14")
    stream = read_raw(spark, "parquet", path=_raw_folder(spark, sf), streaming=True, schema=_RAW_SCHEMA)
    _finish(jobs.run_archive(stream, f"{out}/rows", "ts", f"{out}/cp", interval=None))
    rows = spark.read.schema(f"{_RAW_SCHEMA}, dt string, hh string, batch int").parquet(f"{out}/rows")
    return rows.select("event_id", F.md5("value").alias("digest"), "dt", "hh")


@query("s14_compacted_archive", """
SELECT event_id, md5(value) AS digest FROM raw WHERE strftime(ts, '%Y-%m-%d') IN ('2024-01-10', '2024-01-11')""", "raw")
def _(spark, sf):
    """Two days of the archive, written in three batches; compacted between the second and the third, and again after."""
    out = work_dir(spark, "s14c")
    days = ("2024-01-10", "2024-01-11")
    lines = adapter.raw_lines(spark, sf).where(F.date_format("ts", "yyyy-MM-dd").isin(*days))
    archive = HourArchive(spark, f"{out}/rows", _RAW_SCHEMA)
    hours = [(day, f"{hour:02d}") for day in days for hour in (0, 6, 12, 18)]

    def add(part: int) -> None:
        lines.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{out}/in")
        stream = read_raw(spark, "parquet", path=f"{out}/in", streaming=True, schema=_RAW_SCHEMA)
        # Folders of six hours each keep their number low here.
        slot = F.date_trunc("day", "ts") + F.make_dt_interval(hours=F.floor(F.hour("ts") / 6).cast("int") * 6)
        _finish(jobs.run_archive(stream.withColumn("at", slot), f"{out}/rows", "at", f"{out}/cp", interval=None))

    def compact() -> None:
        upto = folders.committed_batch(spark, f"{out}/cp")
        for day, hour in hours:
            archive.compact(day, hour, upto)

    add(0)
    add(1)
    compact()
    add(2)
    compact()
    for day, hour in hours[:4]:
        archive.clean(day, hour)
    found = archive.read(*hours[0])
    for day, hour in hours[1:]:
        found = found.unionByName(archive.read(day, hour))
    return found.select("event_id", F.md5("value").alias("digest"))


@query("s15_keyed_live_view", """
SELECT key FROM snaps WHERE h + INTERVAL 120 SECONDS > TIMESTAMP '2024-01-18 07:00:30'
UNION ALL SELECT 'CSANTI_MONITOR_DP_LAST'""", "snaps")
def _(spark, sf):
    out = work_dir(spark, "s15")
    keyed.put(keyed.with_last(_entries(spark, sf), "CSANTI_MONITOR_DP"), out, 0)
    return keyed.live(spark, out, "2024-01-18 07:00:30").select("key")


# --- streams ---

@query("g1_micro_batches", "SELECT remote_addr, count(*) AS n FROM requests GROUP BY 1", "requests")
def _(spark, sf):
    """Counts per micro-batch, added up afterwards."""
    out = work_dir(spark, "g1")
    _requests(spark, sf).select("event_id", "remote_addr").repartition(4, "event_id").write.parquet(f"{out}/in")

    def each(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy("remote_addr").agg(F.count(F.lit(1)).alias("n")).withColumn("batch", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
         .parquet(f"{out}/rows"))

    stream = jobs.read_file_stream(spark, f"{out}/in", "event_id long, remote_addr string", max_files=2)
    _finish(jobs.start(stream, each, f"{out}/cp", interval=None))
    rows = spark.read.schema("remote_addr string, n long, batch int").parquet(f"{out}/rows")
    return rows.groupBy("remote_addr").agg(F.sum("n").alias("n"))


_REQ_SCHEMA = ("event_id long, event_time timestamp, remote_addr string, request string, http_user_agent string, "
               "depcity string, arrcity string, jsessionid string")
_REQ_COLUMNS = ("event_id", "event_time", "remote_addr", "request", "http_user_agent", "depcity", "arrcity", "jsessionid")


def _request_stream(spark: SparkSession, sf: str, out: str) -> DataFrame:
    _requests(spark, sf).select(*_REQ_COLUMNS).write.parquet(f"{out}/in")
    return jobs.read_file_stream(spark, f"{out}/in", _REQ_SCHEMA)


_VECTORS = ("window_start timestamp, remote_addr string, request string, requests long, last_seen timestamp, "
            + ", ".join(f"{c} long" for c in _VEC) + ", window_length string, batch int")
# End of the newest slice that the watermark lets finish.
_NEWEST = f"""(SELECT max({_FIVE}) + INTERVAL 5 MINUTES FROM m
 WHERE {_FIVE} + INTERVAL 5 MINUTES <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM m))"""


def _window_stream(spark: SparkSession, sf: str, out: str, longer: tuple[str, ...], threshold_ms: int) -> DataFrame:
    """Vectors of every finished window, out of a stream of five-minute slices."""
    slices = slice_states(_request_stream(spark, sf, out).withWatermark("event_time", "1 minute"), "5 minutes")
    tables = WindowTables(spark, f"{out}/partials", "5 minutes", longer, threshold_ms)
    _finish(jobs.start(slices, metric_batches(tables, lambda: critical(rules.CRITICAL), f"{out}/rows"), f"{out}/cp",
                       interval=None))
    return spark.read.schema(_VECTORS).parquet(f"{out}/rows")


@query("g2_streamed_metrics", f"""
SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_at, * EXCLUDE (w) FROM ({_vectors_sql(_FIVE, 5000)})
WHERE w + INTERVAL 5 MINUTES <= {_NEWEST}""", "m")
def _(spark, sf):
    """All eight metrics over event-time windows, each emitted once it is complete."""
    rows = _window_stream(spark, sf, work_dir(spark, "g2"), (), 5000)
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_at"), "remote_addr", "request",
                       "requests", *_VEC)


@query("n1_rolled_metrics", f"""
SELECT '1 hour' AS window_length, strftime(w, '%Y-%m-%d %H:%M') AS window_at, * EXCLUDE (w)
FROM ({_vectors_sql(_HOUR, rules.GAP_MS)}) WHERE w + INTERVAL 1 HOUR <= {_NEWEST}
UNION ALL SELECT '1 day', strftime(w, '%Y-%m-%d %H:%M'), * EXCLUDE (w)
FROM ({_vectors_sql(_DAY, rules.GAP_MS)}) WHERE w + INTERVAL 1 DAY <= {_NEWEST}""", "m")
def _(spark, sf):
    """The same over hours and days, merged from the slices of one stream."""
    rows = _window_stream(spark, sf, work_dir(spark, "n1"), ("1 hour", "1 day"), rules.GAP_MS)
    return rows.where(F.col("window_length") != "5 minutes").select(
        "window_length", F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_at"), "remote_addr", "request",
        "requests", *_VEC)


@query("g3_late_rows", """
SELECT count(*) FILTER (WHERE time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES <=
 (SELECT max(ts) FROM events WHERE event_id % 2 = 0) - INTERVAL 10 MINUTES) AS late_rows
FROM events WHERE event_id % 2 = 1""")
def _(spark, sf):
    """The odd events arrive after the even ones; those whose window is closed by then are dropped and counted."""
    out = work_dir(spark, "g3")
    rows = _requests(spark, sf).select("event_id", "event_time")
    log = jobs.BatchLog(spark, f"{out}/log", every=3)
    spark.streams.addListener(log)
    for half in (0, 1):
        rows.where(F.col("event_id") % 2 == half).repartition(4).write.mode("append").parquet(f"{out}/in")
        stream = jobs.read_file_stream(spark, f"{out}/in", "event_id long, event_time timestamp")
        # Every row is a group of its own, so that rows dropped by the watermark count one by one.
        counts = (stream.withWatermark("event_time", "10 minutes")
                  .groupBy(F.window("event_time", "5 minutes"), "event_id").count())
        _finish(counts.writeStream.outputMode("append").format("noop").option("checkpointLocation", f"{out}/cp")
                .trigger(availableNow=True).start())
    log.close()
    return jobs.late_rows(jobs.read_batch_log(spark, f"{out}/log"))


def _score_stream(spark: SparkSession, sf: str, out: str, watermark: str | None) -> jobs.ScoringSinks:
    lines = to_line(_requests(spark, sf).withColumn("high_freq_ip", F.lit(False))).select("value")
    lines.write.parquet(f"{out}/in")
    sinks = jobs.ScoringSinks(f"{out}/live", f"{out}/backup", f"{out}/scored")
    config = jobs.ScoringConfig(rules.FLOWS, rules.CRITICAL, rules.WINDOW, watermark, rules.GAP_MS)
    stream = read_raw(spark, "parquet", path=f"{out}/in", streaming=True, schema="value string")
    _finish(jobs.run_scoring(stream, lambda: config, sinks, f"{out}/cp", interval=None))
    return sinks


# Lines carry whole seconds, so the checking side cuts its times to seconds before it scores.
def _by_second(sql_name: str) -> str:
    """Checking SQL of the scoring chain with the request times cut to seconds."""
    text = with_ctes(f"SELECT * FROM {sql_name}", sql_name)
    return text.replace("requests AS (", "requests AS (SELECT * EXCLUDE (ts), date_trunc('second', ts) AS ts FROM (", 1
                        ).replace("FROM events), m AS", "FROM events)), m AS", 1)


@query("g4_streamed_blacklist", f"""
SELECT remote_addr, flow_id, round(flow_score, 9) AS flow_score, hit_rules, last_ms AS hit_ms
FROM ({_by_second('flow_rows')}) WHERE flow_score > flow_limit AND w < DATE '2024-01-30'
QUALIFY row_number() OVER (PARTITION BY remote_addr ORDER BY last_ms DESC, request DESC, flow_order) = 1""")
def _(spark, sf):
    """The scoring job over finished days; its stored entries, newest per key and address."""
    from skywarden.operators.scoring import latest_entries

    sinks = _score_stream(spark, sf, work_dir(spark, "g4"), "1 minute")
    flow = ("flow_id string, flow_score double, flow_limit double, is_up_limited boolean, strategy_code string, "
            "hit_rules array<string>, hit_time timestamp")
    scored = spark.read.schema(
        f"remote_addr string, request string, last_seen timestamp, flows_score array<struct<{flow}>>, batch int"
    ).parquet(sinks.scored)
    return latest_entries(scored).select(
        "remote_addr", "flow_id", F.round("flow_score", 9).alias("flow_score"),
        F.array_join("hit_rules", ",").alias("hit_rules"), F.unix_millis("hit_time").alias("hit_ms"))


_LIVE_SQL = f"""
SELECT concat('CSANTI_ANTI_BLACK', remote_addr, ':', flow_id) AS key, 120 AS life_s, live
FROM (SELECT remote_addr, flow_id FROM ({_by_second('flow_rows')}) WHERE flow_score > flow_limit AND w < DATE '2024-01-30'
QUALIFY row_number() OVER (PARTITION BY remote_addr ORDER BY last_ms DESC, request DESC, flow_order) = 1),
(VALUES ('when written'), ('two minutes later')) t(live) WHERE live = 'when written'"""


@query("g4_live_blacklist", _LIVE_SQL)
def _(spark, sf):
    """The live blacklist at the time it was written, and none of it when its life is over."""
    sinks = _score_stream(spark, sf, work_dir(spark, "g4l"), "1 minute")
    stored = keyed.stored(spark, sinks.live)
    # One row: the write time of the last batch. Where nothing was listed, any time shows the empty list.
    at = stored.agg(F.coalesce(F.max("written_at"), F.current_timestamp()).alias("at"),
                    F.coalesce(F.max("expire_at"), F.current_timestamp()).alias("end")).first()

    def seen(now, what: str) -> DataFrame:
        return keyed.live(spark, sinks.live, f"{now:%Y-%m-%d %H:%M:%S.%f}").select(
            "key", (F.unix_seconds("expire_at") - F.unix_seconds("written_at")).cast("int").alias("life_s"),
            F.lit(what).alias("live"))

    return seen(at["at"], "when written").unionByName(seen(at["end"], "two minutes later"))


@query("g4_state_view", _LIVE_SQL)
def _(spark, sf):
    """The same out of the state of a stream over the live table."""
    out = work_dir(spark, "g4s")
    sinks = _score_stream(spark, sf, out, "1 minute")
    at = keyed.stored(spark, sinks.live).agg(
        F.coalesce(F.max("written_at"), F.current_timestamp()).alias("at"),
        F.coalesce(F.max("expire_at"), F.current_timestamp()).alias("end")).first()
    _finish(live.run_live_view(live.entry_stream(spark, sinks.live), lambda changes, _: changes.write.format("noop").mode(
        "overwrite").save(), f"{out}/view", interval=None))

    def seen(now, what: str) -> DataFrame:
        return live.live_entries(spark, f"{out}/view", f"{now:%Y-%m-%d %H:%M:%S.%f}").select(
            "key", (F.unix_seconds("expire_at") - F.unix_seconds("written_at")).cast("int").alias("life_s"),
            F.lit(what).alias("live"))

    return seen(at["at"], "when written").unionByName(seen(at["end"], "two minutes later"))


@query("g4_batch_scoped_blacklist", f"""
SELECT DISTINCT concat('CSANTI_ANTI_BLACK', remote_addr, ':') AS key_start FROM ({_by_second('m')})
WHERE remote_addr IN (SELECT remote_addr FROM ({_by_second('m')}) GROUP BY 1 HAVING count(*) > 18)""")
def _(spark, sf):
    """Without a watermark the metrics cover the batch as it arrived; here that is the whole input."""
    sinks = _score_stream(spark, sf, work_dir(spark, "g4b"), None)
    stored = keyed.stored(spark, sinks.live).select("key").distinct()
    return stored.select(F.concat(F.substring_index("key", ":f", 1), F.lit(":")).alias("key_start")).distinct()


@query("g6_stop_and_go", "SELECT event_id FROM events")
def _(spark, sf):
    """A running stream is stopped after the batch at work and started again; no row is lost or doubled."""
    out = work_dir(spark, "g6")
    _requests(spark, sf).select("event_id").repartition(6, "event_id").write.parquet(f"{out}/in")

    def each(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/rows"))

    def stream() -> DataFrame:
        return jobs.read_file_stream(spark, f"{out}/in", "event_id long", max_files=2)

    first = jobs.start(stream(), each, f"{out}/cp", interval="0 seconds")
    while first.isActive and first.lastProgress is None:
        first.awaitTermination(1)
    jobs.stop_gracefully(first)
    _finish(jobs.start(stream(), each, f"{out}/cp", interval=None))
    return spark.read.schema("event_id long, batch int").parquet(f"{out}/rows").select("event_id")


@query("g7_outputs_per_batch", """
SELECT 'processedQuery' AS output, count(*) AS n FROM typed WHERE behavior_type = 'Query'
UNION ALL SELECT 'processedBook', count(*) FROM typed WHERE behavior_type = 'Book'
UNION ALL SELECT 'lines', count(*) FROM raw""", "typed", "raw")
def _(spark, sf):
    """The ETL job: routed lines of both topics and the snapshots of every batch."""
    from skywarden.operators.monitor import MONITOR_PREFIXES, decode_throughput

    out = work_dir(spark, "g7")
    sinks = jobs.EtlSinks(f"{out}/routed", f"{out}/monitor")
    stream = read_raw(spark, "parquet", path=_raw_folder(spark, sf), streaming=True, schema=_RAW_SCHEMA)
    _finish(jobs.run_etl(stream, Site, sinks, f"{out}/cp", interval=None))
    routed = (spark.read.schema("value string, topic string, batch int").parquet(sinks.routed)
              .groupBy(F.col("topic").alias("output")).agg(F.count(F.lit(1)).alias("n")))
    stored = keyed.stored(spark, sinks.monitor).where(~F.col("key").endswith("_LAST"))
    counted = decode_throughput(keyed.with_prefix(stored, MONITOR_PREFIXES["process"]))
    lines = counted.agg(F.sum(F.col("source_count").cast("long")).alias("n")).select(F.lit("lines").alias("output"), "n")
    return routed.unionByName(lines)


_SPLIT = "2024-01-15"


@query("g7_scoring_outputs", f"""
SELECT DISTINCT 'live' AS output, concat('CSANTI_ANTI_BLACK', remote_addr, ':', flow_id) AS key, 1::BIGINT AS n FROM (
 SELECT *, w + INTERVAL 1 DAY > (SELECT max(ts) - INTERVAL 1 MINUTE FROM ({_by_second('m')}) WHERE ts < DATE '{_SPLIT}') AS late
 FROM ({_by_second('flow_rows')}) WHERE flow_score > flow_limit AND w < DATE '2024-01-30'
 QUALIFY row_number() OVER (PARTITION BY remote_addr, late ORDER BY last_ms DESC, request DESC, flow_order) = 1)
UNION ALL SELECT 'archive', NULL, count(*) FROM events""")
def _(spark, sf):
    """The scoring job loses its live table half way; the entries of the first half come back from the backup, and the
    archive has every line."""
    out = work_dir(spark, "g7s")
    lines = to_line(_requests(spark, sf).withColumn("high_freq_ip", F.lit(False))).select("value", "event_time")
    sinks = jobs.ScoringSinks(f"{out}/live", f"{out}/backup", archive=f"{out}/archive")
    config = jobs.ScoringConfig(rules.FLOWS, rules.CRITICAL, rules.WINDOW, "1 minute", rules.GAP_MS, ttl_s=3600)
    split = F.lit(_SPLIT).cast("timestamp")
    for part, half in enumerate((F.col("event_time") < split, F.col("event_time") >= split)):
        lines.where(half).select("value").write.mode("append").parquet(f"{out}/in")
        stream = read_raw(spark, "parquet", path=f"{out}/in", streaming=True, schema="value string")
        if part:
            folders.move(spark, sinks.live, f"{out}/lost")
        for job in jobs.run_scoring_job(stream, lambda: config, sinks, f"{out}/cp", interval=None):
            _finish(job)
    at = keyed.stored(spark, sinks.live).agg(F.coalesce(F.max("written_at"), F.current_timestamp()).alias("at")).first()["at"]
    listed = keyed.live(spark, sinks.live, f"{at:%Y-%m-%d %H:%M:%S.%f}").select(
        F.lit("live").alias("output"), "key", F.lit(1).cast("long").alias("n"))
    archived = spark.read.schema("value string, dt string, hh string, batch int").parquet(sinks.archive)
    return listed.unionByName(archived.agg(F.count("value").alias("n")).select(
        F.lit("archive").alias("output"), F.lit(None).cast("string").alias("key"), "n"))


@query("s10_reloaded_flows", """
SELECT 'f1' AS flow_id, remote_addr, count(*) AS ip_count FROM requests WHERE event_id % 2 = 0 GROUP BY 2
HAVING count(*) > 22
UNION ALL SELECT 'f9', remote_addr, count(*) FROM requests WHERE event_id % 2 = 1 GROUP BY 2 HAVING count(*) > 25""",
       "requests")
def _(spark, sf):
    """Flows are edited while the scoring job runs; the next batch scores by the new ones."""
    out = work_dir(spark, "s10f")
    versions = VersionedTables(spark, f"{out}/tables")

    def publish(flow_id: str, limit: float) -> None:
        versions.publish("process", spark.sql(f"SELECT '{flow_id}' AS id, 'busy' AS process_name, 0 AS status"))
        versions.publish("strategy", spark.sql(f"SELECT '{flow_id}' AS id, 30.0D AS crawler_blacklist_thresholds"))
        versions.publish("rules", spark.sql(
            f"SELECT 1 AS id, '{flow_id}' AS process_id, 'requests' AS rule_name, 0 AS rule_type, 0 AS status, "
            f"0 AS crawler_type, {limit}D AS arg0, 0.0D AS arg1, 6 AS score"))
        versions.publish("rule_names", spark.sql("SELECT 'requests' AS rule_name, 'ip' AS rule_real_name"))
        versions.publish("critical_pages", spark.createDataFrame(
            [(p,) for p in rules.CRITICAL], "criticalPageMatchExpression string"))

    lines = to_line(_requests(spark, sf).withColumn("high_freq_ip", F.lit(False)))
    for half in (0, 1):
        lines.where(F.col("event_id") % 2 == half).select("value").write.parquet(f"{out}/staged/half{half}")
    sinks = jobs.ScoringSinks(f"{out}/live", f"{out}/backup", f"{out}/scored")
    publish("f1", 22)
    config = scoring_config(BatchTables(versions, SCORING_TABLES, f"{out}/pins"), watermark=None)
    stream = read_raw(spark, "parquet", path=f"{out}/in/*", streaming=True, schema="value string")
    job = jobs.run_scoring(stream, config, sinks, f"{out}/cp", interval="0 seconds")
    try:
        for half in (0, 1):
            if half:
                publish("f9", 25)
            folders.move(spark, f"{out}/staged/half{half}", f"{out}/in/half{half}")
            job.processAllAvailable()
    finally:
        job.stop()
    flow = "flow_id string, is_up_limited boolean"
    rows = spark.read.schema(f"remote_addr string, ip_count long, flows_score array<struct<{flow}>>").parquet(sinks.scored)
    return rows.select("remote_addr", "ip_count", F.explode("flows_score").alias("f")).where("f.is_up_limited").select(
        "f.flow_id", "remote_addr", "ip_count").distinct()
