"""What the scoring job keeps across batches: windows, the live list, its restore, and the versions of its rules."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skywarden.operators.metrics import METRICS, metric_vectors
from skywarden.operators.slices import slice_states
from skywarden.operators.tag import critical
from skywarden.plans import rules
from skywarden.plans.scoring import scored_vectors
from skywarden.session import work_dir
from skywarden.sources import keyed
from skywarden.sources.readers import read_raw
from skywarden.sources.folders import move
from skywarden.sources.writers import write_hourly_batch
from skywarden.streaming import jobs, live
from skywarden.streaming.lookups import SCORING_TABLES, BatchTables, VersionedTables, scoring_config
from skywarden.streaming.windows import WindowTables, metric_batches
from skywarden.schema import Flow, ScoreRule
from tests.test_metrics import sample
from tests.test_streams import FLOWS, finish, line_folder

FIELDS = ["window_start", "remote_addr", "request", "requests", *METRICS.values()]
DAY_MS = 86_400_000


def hours_done(df, length, slice_="5 minutes", delay_s=60):
    """Condition: windows that a later or equal finished slice has closed."""
    end = df.agg(F.max("event_time").alias("m")).first().m
    finished = df.select(F.window("event_time", slice_)["end"].alias("e")).where(
        F.col("e") <= F.lit(end) - F.make_dt_interval(secs=F.lit(delay_s))).agg(F.max("e")).first()[0]
    return F.col("window_start") + F.expr(f"INTERVAL {length}") <= F.lit(finished)


def test_windows_of_three_lengths_over_restarts_and_repeats(spark):
    _, df = sample(spark, 800, 9, 2 * DAY_MS + 5_000_000)
    out, pages = work_dir(spark, "windows"), critical(rules.CRITICAL)
    schema = df.schema
    tables = WindowTables(spark, f"{out}/partials", "5 minutes", ("1 hour", "1 day"))
    write = metric_batches(tables, lambda: pages, f"{out}/rows")

    def each(batch, batch_id):
        # Every batch is worked off twice, as after a loss.
        write(batch, batch_id)
        write(batch, batch_id)

    cuts = df.agg(F.expr("percentile(unix_millis(event_time), array(0.3, 0.6))")).first()[0]
    ms = F.unix_millis("event_time")
    for low, high in ((0, cuts[0]), (cuts[0], cuts[1]), (cuts[1], 1 << 60)):
        df.where((ms > low) & (ms <= high)).write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(schema).parquet(f"{out}/in")
        finish(jobs.start(slice_states(stream.withWatermark("event_time", "1 minute"), "5 minutes"), each, f"{out}/cp",
                          interval=None))
    rows = spark.read.parquet(f"{out}/rows")
    for length in ("5 minutes", "1 hour", "1 day"):
        want = metric_vectors(df, pages, length).where(hours_done(df, length))
        got = rows.where(F.col("window_length") == length)
        assert sorted(got.select(*FIELDS).collect()) == sorted(want.select(*FIELDS).collect()) and got.count()


def test_lengths_have_to_divide(spark):
    with pytest.raises(ValueError):
        WindowTables(spark, "x", "5 minutes", ("12 minutes",))


def test_flows_of_longer_windows_are_scored(spark):
    folder, df = line_folder(spark)
    out = work_dir(spark, "longer")
    # The sample spans 25 minutes: windows of 10 stand for the longer ones.
    longer = {"10 minutes": [Flow("long", "l", 20.0, (ScoreRule("ip", 0, 60, 0, 6),))]}
    config = jobs.ScoringConfig(FLOWS, rules.CRITICAL, "5 minutes", "10 seconds", longer=longer)
    sinks = jobs.ScoringSinks(f"{out}/live", f"{out}/backup", f"{out}/scored", partials=f"{out}/partials")
    stream = read_raw(spark, "parquet", path=folder, streaming=True, schema="value string")
    finish(jobs.run_scoring(stream, lambda: config, sinks, f"{out}/cp", interval=None))
    got = spark.read.parquet(sinks.scored)
    columns = ["window_start", "remote_addr", "request", "ip_count", "flows_score"]
    for length, flows in (("5 minutes", FLOWS), ("10 minutes", longer["10 minutes"])):
        want = scored_vectors(df, flows, rules.CRITICAL, length).where(hours_done(df, length, delay_s=10))
        mine = got.where(F.col("window_length") == length)
        assert sorted(map(str, mine.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
        assert mine.count()
    assert any(r.key.endswith(":long") for r in keyed.stored(spark, sinks.live).collect())
    with pytest.raises(ValueError):
        jobs.run_scoring(stream, lambda: config, jobs.ScoringSinks(f"{out}/l", f"{out}/b"), f"{out}/cp2")


def entry_rows(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, expire_at string, written_at string").withColumns(
        {c: F.col(c).cast("timestamp") for c in ("expire_at", "written_at")})


def test_restore_once_after_a_loss(spark):
    out = work_dir(spark, "restore")
    sinks = jobs.ScoringSinks(f"{out}/live", f"{out}/backup")
    backed = entry_rows(spark, [
        ("a", "old", "2024-01-01 12:30:00", "2024-01-01 11:58:00"), ("a", "new", "2024-01-01 12:40:00", "2024-01-01 12:01:00"),
        ("over", "x", "2024-01-01 12:05:00", "2024-01-01 12:01:00"), ("there", "x", "2024-01-01 12:50:00", "2024-01-01 12:01:00"),
        ("far", "x", "2024-01-01 23:00:00", "2024-01-01 10:59:00")]).withColumn(
        "key_exp_time", F.unix_millis("expire_at").cast("string"))
    write_hourly_batch(backed.select("key_exp_time", "key", "value", "written_at"), sinks.backup, "written_at", 0)
    keyed.put(entry_rows(spark, [("there", "live", "2024-01-01 12:20:00", "2024-01-01 12:09:00")]), sinks.live, 6)
    at = datetime(2024, 1, 1, 12, 10)

    def listed():
        return {(r.key, r.value) for r in keyed.live(spark, sinks.live, "2024-01-01 12:10:00").collect()}

    assert not jobs.restore_if_lost(spark, sinks, 7, at, restore=False) and listed() == {("there", "live")}
    # The first try stops between the entries and the mark; the second finds no mark and does the same again.
    assert jobs.restore_if_lost(spark, sinks, 7, at)
    want = {("there", "live"), ("a", "new")}
    assert listed() == want
    move(spark, f"{sinks.live}/_restored", f"{out}/_mark")
    assert jobs.restore_if_lost(spark, sinks, 7, at) and listed() == want
    # With the mark in place nothing comes back, not even what was taken off the list meanwhile.
    assert not jobs.restore_if_lost(spark, sinks, 8, at)
    assert keyed.stored(spark, sinks.live).where("batch < 0").count() == 1
    # A lost table has lost its mark as well.
    assert move(spark, sinks.live, f"{out}/gone") and listed() == set()
    assert jobs.restore_if_lost(spark, sinks, 9, at) and listed() == {("there", "x"), ("a", "new")}


def test_no_backup_is_nothing_to_restore(spark):
    out = work_dir(spark, "nothing")
    sinks = jobs.ScoringSinks(f"{out}/live", f"{out}/backup")
    assert jobs.restore_if_lost(spark, sinks, 0, datetime(2024, 1, 1))
    assert keyed.live(spark, sinks.live, "2024-01-01 00:00:00").count() == 0


def test_live_state_follows_entries_and_drops_them(spark):
    out = work_dir(spark, "state")
    root, view, seen = f"{out}/live", f"{out}/view", []

    def go():
        finish(live.run_live_view(live.entry_stream(spark, root), lambda batch, _: seen.extend(
            (r.key, r.value, r.event) for r in batch.collect()), view, interval=None))
        out = set(seen)
        seen.clear()
        return out

    def listed(now):
        return {(r.key, r.value) for r in live.live_entries(spark, view, now).collect()}

    assert listed("2024-01-01 00:00:00") == set()
    keyed.put(entry_rows(spark, [("a", "1", "2024-01-01 00:02:00", "2024-01-01 00:00:00"),
                                 ("b", "1", "2024-01-01 00:02:00", "2024-01-01 00:00:00"),
                                 ("mark", "m", keyed.NEVER, "2024-01-01 00:00:00")]), root, 0)
    assert go() == {("a", "1", "listed"), ("b", "1", "listed")}
    keyed.put(entry_rows(spark, [("a", "2", "2024-01-01 00:03:00", "2024-01-01 00:01:00")]), root, 1)
    assert go() == {("a", "2", "listed")}
    assert listed("2024-01-01 00:01:59") == {("a", "2"), ("b", "1")}
    assert listed("2024-01-01 00:02:00") == {("a", "2")} and listed("2024-01-01 00:03:00") == set()
    # A batch that is written again changes nothing; time goes on with the next entry.
    keyed.put(entry_rows(spark, [("a", "2", "2024-01-01 00:03:00", "2024-01-01 00:01:00")]), root, 1)
    assert go() == set()
    keyed.put(entry_rows(spark, [("c", "1", "2024-01-01 01:03:00", "2024-01-01 01:01:00")]), root, 2)
    assert go() == {("c", "1", "listed"), ("a", "2", "over"), ("b", "1", "over")}
    assert listed("2024-01-01 00:00:00") == {("c", "1")}


def test_live_state_in_a_session_with_the_default_state_provider(spark):
    out, key = work_dir(spark, "default-state"), "spark.sql.streaming.stateStore.providerClass"
    root, view, before = f"{out}/live", f"{out}/view", spark.conf.get(key)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, default)
    try:
        for batch, written in enumerate(("00:00", "00:01")):
            keyed.put(entry_rows(spark, [(f"k{batch}", "v", "2024-01-01 00:03:00", f"2024-01-01 {written}:00")]), root, batch)
            finish(live.run_live_view(live.entry_stream(spark, root), lambda rows, _: rows.collect(), view, interval=None))
            assert spark.conf.get(key) == default
        assert {r.key for r in live.live_entries(spark, view, "2024-01-01 00:02:00").collect()} == {"k0", "k1"}
    finally:
        spark.conf.set(key, before)


def test_a_repeated_batch_uses_the_rules_it_had(spark):
    out = work_dir(spark, "versions")
    tables = VersionedTables(spark, f"{out}/tables", keep=3)
    with pytest.raises(ValueError):
        tables.newest("process")

    def publish(limit, status=0):
        tables.publish("process", spark.sql(f"SELECT 'f' AS id, 'n' AS process_name, {status} AS status"))
        tables.publish("strategy", spark.sql("SELECT 'f' AS id, 30.0D AS crawler_blacklist_thresholds"))
        tables.publish("rules", spark.sql(
            f"SELECT 1 AS id, 'f' AS process_id, 'r' AS rule_name, 0 AS rule_type, 0 AS status, 0 AS crawler_type, "
            f"{limit}.0D AS arg0, 0.0D AS arg1, 6 AS score"))
        tables.publish("rule_names", spark.sql("SELECT 'r' AS rule_name, 'ip' AS rule_real_name"))
        tables.publish("critical_pages", spark.sql("SELECT '^.*a.*$' AS criticalPageMatchExpression"))

    def limits(config, batch_id):
        return [r.limit for f in config(batch_id).flows for r in f.rules]

    publish(1)
    pins = BatchTables(tables, SCORING_TABLES, f"{out}/pins", slots=4)
    config = scoring_config(pins)
    assert limits(config, 0) == [1.0] and config(0).critical_pages == ["^.*a.*$"]
    publish(2)
    assert limits(config, 0) == [1.0] and limits(config, 1) == [2.0]
    # A new driver that repeats the batch finds its versions, also after further edits.
    publish(3)
    again = scoring_config(BatchTables(tables, SCORING_TABLES, f"{out}/pins", slots=4))
    assert limits(again, 1) == [2.0] and limits(again, 2) == [3.0]
    publish(4, status=1)
    assert limits(again, 3) == [] and tables._versions("rules") == [2, 3, 4]
    # Pins take turns in a fixed number of folders.
    publish(5)
    assert limits(again, 4) == [5.0] and limits(again, 4) == [5.0]
    assert spark.read.json(f"{out}/pins").count() == 4
