"""Streams give what the batch operators give, also after a restart."""

from __future__ import annotations

from pyspark.sql import functions as F

from skywarden.operators.line import to_line
from skywarden.operators.monitor import MONITOR_PREFIXES, decode_link, decode_throughput
from skywarden.operators.scoring import blacklist
from skywarden.plans import rules
from skywarden.plans.etl import Site, processed_lines
from skywarden.plans.scoring import scored_vectors
from skywarden.schema import Flow, ScoreRule
from skywarden.session import work_dir
from skywarden.sources import keyed
from skywarden.sources.readers import read_raw
from skywarden.streaming import jobs
from skywarden.streaming.lookups import ChangeFlags, Lookups
from tests.test_metrics import sample
from tests.test_records import SAMPLE

FLOWS = [Flow("f1", "a", 20.0, (ScoreRule("ip", 0, 30, 0, 6), ScoreRule("userAgent", 0, 3, 0, 5)))]


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def line_folder(spark, parts=2):
    """Processed lines of random requests, and the requests cut to whole seconds as the lines are."""
    _, df = sample(spark, 500)
    df = df.withColumn("event_time", F.date_trunc("second", "event_time")).withColumn(
        "time_iso8601", F.concat(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00"))).withColumn(
        "high_freq_ip", F.lit(False))
    folder = work_dir(spark, "lines")
    # Files in time order: what a file brings is never late.
    lines = to_line(df).select("value", "event_time")
    middle = df.agg(F.expr("percentile_approx(event_time, 0.5)").alias("m")).first().m
    for part in (lines.where(F.col("event_time") < middle), lines.where(F.col("event_time") >= middle)):
        part.select("value").coalesce(1).write.mode("append").parquet(folder)
    return folder, df


def config(watermark):
    return lambda: jobs.ScoringConfig(FLOWS, rules.CRITICAL, "5 minutes", watermark)


def test_windows_in_stream_equal_batch(spark):
    folder, df = line_folder(spark)
    out = work_dir(spark, "score")
    sinks = jobs.ScoringSinks(f"{out}/live", f"{out}/backup", f"{out}/scored")
    stream = read_raw(spark, "parquet", {"maxFilesPerTrigger": "1"}, folder, True, "value string")
    finish(jobs.run_scoring(stream, config("10 minutes"), sinks, f"{out}/cp", interval=None))
    want = scored_vectors(df, FLOWS, rules.CRITICAL)
    end = df.agg(F.max("event_time").alias("m")).first().m
    done = want.where(F.col("window_start") + F.expr("INTERVAL 5 MINUTES") <= F.lit(end) - F.expr("INTERVAL 10 MINUTES"))
    cols = ["window_start", "remote_addr", "request", "requests", "ip_count", "min_gap_ms", "short_gaps", "trip_count"]
    got = spark.read.parquet(sinks.scored).select(*cols)
    assert sorted(got.collect()) == sorted(done.select(*cols).collect()) and got.count() > 10
    # The newest stored entry of an address is the one the batch form finds over the same windows.
    # Entries live from the time their batch was written, and no longer than that.
    times = keyed.stored(spark, sinks.live).agg(F.max("written_at").alias("at"), F.max("expire_at").alias("end")).first()
    assert (times.end - times.at).total_seconds() == 120
    live = {r.key: r.value for r in keyed.live(spark, sinks.live, str(times["at"])).collect()}
    assert live == {r.key: r.value for r in blacklist(done).collect()} and live
    assert keyed.live(spark, sinks.live, str(times.end)).count() == 0
    backup = spark.read.parquet(sinks.backup)
    assert {r.key for r in backup.collect()} == set(live)


def test_batch_scope(spark):
    folder, df = line_folder(spark)
    out = work_dir(spark, "scope")
    sinks = jobs.ScoringSinks(f"{out}/live", f"{out}/backup", f"{out}/scored")
    stream = read_raw(spark, "parquet", path=folder, streaming=True, schema="value string")
    finish(jobs.run_scoring(stream, config(None), sinks, f"{out}/cp", interval=None))
    want = scored_vectors(df, FLOWS, rules.CRITICAL, window=None).select("remote_addr", "request", "ip_count", "min_gap_ms")
    got = spark.read.parquet(sinks.scored).select("remote_addr", "request", "ip_count", "min_gap_ms")
    assert sorted(got.collect()) == sorted(want.collect())


def test_etl_stream_equals_batch_and_repeats_cleanly(spark):
    folder, out = work_dir(spark, "raw"), work_dir(spark, "etl")
    lines = spark.createDataFrame([(SAMPLE,), (SAMPLE.replace("query.ao", "x.css"),), ("junk",)], "value string")
    lines.write.parquet(folder)
    sinks = jobs.EtlSinks(f"{out}/routed", f"{out}/monitor")
    stream = read_raw(spark, "parquet", path=folder, streaming=True, schema="value string")
    finish(jobs.run_etl(stream, Site, sinks, f"{out}/cp", interval=None))
    want = processed_lines(lines, Site()).select("value").collect()
    assert spark.read.parquet(sinks.routed).select("value").collect() == want and len(want) == 1
    # The batch is worked off a second time, as after a loss: the routed lines stay as they were.
    key = keyed.with_prefix(keyed.stored(spark, sinks.monitor), MONITOR_PREFIXES["link"]).first().key
    jobs.etl_batch(spark.read.parquet(folder), 0, Site(), sinks, "etl",
                   begin_ms=int(key.removeprefix(MONITOR_PREFIXES["link"])))
    assert keyed.with_prefix(keyed.stored(spark, sinks.monitor), MONITOR_PREFIXES["link"]).count() == 1
    assert spark.read.parquet(sinks.routed).select("value").collect() == want
    stored = keyed.stored(spark, sinks.monitor)
    speed = decode_throughput(keyed.with_prefix(stored, MONITOR_PREFIXES["process"]).where(~F.col("key").endswith("_LAST")))
    row = speed.first()
    assert row.source_count == "3" and row.servers_count_map == {"": 1, "192.168.80.83": 2}
    link = decode_link(keyed.with_prefix(stored, MONITOR_PREFIXES["link"])).first()
    assert link.active_num_map == {"": 1, "192.168.80.83": 3}
    assert stored.where(F.col("key") == MONITOR_PREFIXES["process"] + "_LAST").count() == 1


def test_refresh_flags(spark):
    flags = ChangeFlags(spark, work_dir(spark, "flags"))
    loads = []
    lookups = Lookups({"a": lambda: loads.append("a") or len(loads), "b": lambda: loads.append("b") or len(loads)}, flags,
                      {"a": "AFlag"})
    assert lookups.refresh() == ["a", "b"] and lookups.refresh() == []
    assert flags.get("AFlag") == "false" and flags.get("nothing") is None
    flags.put("AFlag", "true")
    assert lookups.refresh() == ["a"] and lookups["a"] == 3 and lookups.refresh() == []
    flags.put("bChangeFlag", " ")
    assert lookups.refresh() == ["b"]


def test_batch_log_holds_more_batches_than_the_session(spark):
    """The session keeps two progress reports here; the log has all batches."""
    folder, out = work_dir(spark, "log"), work_dir(spark, "logout")
    spark.range(30).repartition(12).write.parquet(folder)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    log = jobs.BatchLog(spark, f"{out}-log", every=5)
    spark.streams.addListener(log)
    try:
        query = jobs.start(jobs.read_file_stream(spark, folder, "id long", max_files=1),
                           lambda b, i: b.write.mode("append").parquet(out), f"{out}-cp", interval=None)
        finish(query)
        log.close()
        assert len(query.recentProgress) <= 2
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    rows = jobs.read_batch_log(spark, f"{out}-log").collect()
    assert sum(r.source_count for r in rows) == 30 and len(rows) >= 12 and log.files > 1
    assert all(r.end_ms >= r.start_ms for r in rows)


def test_scoring_job_writes_its_throughput(spark):
    folder, df = line_folder(spark)
    out = work_dir(spark, "speed")
    sinks = jobs.ScoringSinks(f"{out}/live", f"{out}/backup", monitor=f"{out}/monitor")
    stream = read_raw(spark, "parquet", path=folder, streaming=True, schema="value string")
    finish(jobs.run_scoring(stream, config(None), sinks, f"{out}/cp", interval=None))
    stored = keyed.stored(spark, sinks.monitor)
    counted = decode_throughput(keyed.with_prefix(stored, MONITOR_PREFIXES["query"]).where(~F.col("key").endswith("_LAST")))
    assert sum(int(r.source_count) for r in counted.collect()) == df.count()
    assert stored.where(F.col("key").endswith("_LAST")).count() == 1


def test_forward_uses_one_writer(spark):
    folder, out = work_dir(spark, "fw"), work_dir(spark, "fwout")
    spark.createDataFrame([("t1", "a"), ("t2", "b")], "topic string, value string").write.parquet(folder)
    stream = jobs.read_file_stream(spark, folder, "topic string, value string")
    finish(jobs.run_forward(stream, "parquet", {"path": out}, f"{out}-cp", interval=None))
    assert sorted(spark.read.parquet(out).collect()) == [("t1", "a"), ("t2", "b")]
