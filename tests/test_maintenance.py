"""Tables that are kept in order while they are written: archive, keyed store, daily totals, sorted pages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skywarden.operators import monitor as mon
from skywarden.session import work_dir
from skywarden.sources import folders, keyed
from skywarden.sources.archive import HourArchive
from skywarden.sources.daily import DailyTotals
from skywarden.sources.moves import SnapshotDrain
from skywarden.sources.paging import PagedTable
from skywarden.sources.writers import write_hourly_batch
from skywarden.streaming import jobs

DAY, HOUR = "2024-01-01", "05"


def put_batch(spark, root, number, values):
    rows = spark.createDataFrame([(v,) for v in values], "value string").withColumn(
        "at", F.lit(f"{DAY} {HOUR}:10:00").cast("timestamp"))
    write_hourly_batch(rows, root, "at", number)


def test_archive_is_whole_at_every_step(spark):
    root = work_dir(spark, "archive")
    archive = HourArchive(spark, root, "value string")
    assert archive.read(DAY, HOUR).count() == 0 and archive.compact(DAY, HOUR, 9) == 0

    def seen():
        return sorted(r.value for r in archive.read(DAY, HOUR).collect())

    for number in range(4):
        put_batch(spark, root, number, [f"{number}-{i}" for i in range(3)])
    want = sorted(f"{n}-{i}" for n in range(4) for i in range(3))
    # Batch 3 is still at work: it may be repeated, so it is left out.
    assert archive.compact(DAY, HOUR, 2) == 3 and seen() == want
    put_batch(spark, root, 3, ["again"])
    want = sorted([w for w in want if not w.startswith("3-")] + ["again"])
    assert seen() == want and archive.manifest(DAY, HOUR) == (1, [0, 1, 2])
    assert archive.clean(DAY, HOUR) == 3 and seen() == want and archive.batches(DAY, HOUR) == [3]
    # A compaction that stops before its manifest changes nothing; its rows are cleared away later.
    spark.createDataFrame([("lost",)], "value string").write.parquet(f"{archive._merged(DAY, HOUR)}/rows-2")
    assert seen() == want
    for number in (4, 5):
        put_batch(spark, root, number, [f"{number}-{i}" for i in range(2)])
    want = sorted([*want, "4-0", "4-1", "5-0", "5-1"])
    assert archive.compact(DAY, HOUR, 5) == 3 and seen() == want and archive.manifest(DAY, HOUR)[0] == 3
    archive.clean(DAY, HOUR)
    assert seen() == want and archive.batches(DAY, HOUR) == []
    files = [f for f in folders.names(spark, f"{archive._merged(DAY, HOUR)}/rows-3") if f.endswith(".parquet")]
    assert len(files) == 1 and folders.names(spark, archive._merged(DAY, HOUR)) == ["manifest-3", "rows-3"]
    # Merged tables are no part of what the plain reader sees.
    assert spark.read.schema("value string, dt string, hh string, batch int").parquet(root).count() == 0


def test_archive_job_compacts_as_it_goes(spark):
    out = work_dir(spark, "compacting")
    for part in range(5):
        spark.range(part * 4, part * 4 + 4).withColumn("at", F.lit(f"{DAY} {HOUR}:00:00").cast("timestamp")).coalesce(1).write.mode(
            "append").parquet(f"{out}/in")
    stream = jobs.read_file_stream(spark, f"{out}/in", "id long, at timestamp", max_files=1)
    jobs.run_archive(stream, f"{out}/rows", "at", f"{out}/cp", None, compact_every=2).awaitTermination()
    archive = HourArchive(spark, f"{out}/rows", "id long, at timestamp")
    # Batches 2 and 4 merged what was finished before them.
    assert archive.manifest(DAY, HOUR) == (2, [0, 1, 2, 3])
    assert sorted(r.id for r in archive.read(DAY, HOUR).collect()) == list(range(20))
    archive.clean(DAY, HOUR)
    assert archive.batches(DAY, HOUR) == [4] and archive.read(DAY, HOUR).count() == 20


def test_last_finished_batch(spark):
    out = work_dir(spark, "commits")
    assert folders.committed_batch(spark, f"{out}/cp") == -1
    spark.range(3).write.parquet(f"{out}/in")
    query = spark.readStream.schema("id long").parquet(f"{out}/in").writeStream.format("noop").option(
        "checkpointLocation", f"{out}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert folders.committed_batch(spark, f"{out}/cp") == 0


def snapshots(spark, hours):
    log = mon.throughput(spark.createDataFrame(
        [(1_704_067_200_000 + h * 3_600_000, 1_704_067_201_000 + h * 3_600_000, 10 + h, {"s1": 4, "s2": 6 + h}) for h in hours],
        "start_ms long, end_ms long, source_count long, servers_count_map map<string,int>").withColumns(
        {"application_id": F.lit("a"), "application_unique_name": F.lit("n")}))
    prefix = mon.MONITOR_PREFIXES["process"]
    return keyed.with_last(keyed.entries(log, prefix, F.timestamp_millis("start_ms"), mon.throughput_snapshot(log), 120), prefix)


@pytest.mark.parametrize("stop_at", [None, "recorded", "parents", "children", "taken off", "done"])
def test_drain_may_stop_anywhere(spark, stop_at):
    out = work_dir(spark, "drain")
    keyed.put(snapshots(spark, range(5)), f"{out}/store", 0)
    drain = SnapshotDrain(spark, f"{out}/store", f"{out}/reports", mon.MONITOR_PREFIXES["process"])

    def stop(step):
        if step == stop_at:
            raise InterruptedError

    if stop_at:
        with pytest.raises(InterruptedError):
            drain.run("2024-01-01 03:00:00", stop)
        # What arrives meanwhile waits for the next move.
        keyed.put(snapshots(spark, [5]), f"{out}/store", 1)
    drain.run("2024-01-01 03:00:00")
    start = [1_704_067_200_000 + h * 3_600_000 for h in range(3)]
    prefix = mon.MONITOR_PREFIXES["process"]
    assert sorted(r.id for r in drain.table("parents").collect()) == [f"{prefix}{s}" for s in start]
    assert sorted((r.parent_id, r.ip_address, r.ip_value) for r in drain.table("children").collect()) == sorted(
        (f"{prefix}{s}", ip, n) for h, s in enumerate(start) for ip, n in (("s1", 4.0), ("s2", 6.0 + h)))
    left = 6 if stop_at else 5
    drain.run("2024-01-02 00:00:00")
    assert drain.table("parents").count() == left == drain.table("parents").select("id").distinct().count()
    assert drain.table("parents").agg(F.sum("source_count")).first()[0] == sum(10 + h for h in range(left))


def test_totals_by_day_equal_the_whole_history(spark):
    counts = {"2024-01-01": [("a", 5), ("b", 2)], "2024-01-02": [("a", 7)], "2024-01-04": [("a", 1), ("b", 3), ("c", 9)],
              "2024-01-05": [("c", 2)]}
    totals = DailyTotals(spark, work_dir(spark, "totals"))

    def rows(day):
        return {r.server_name: (r.before_yesterday_num, r.yesterday_num, r.last_three_days_num) for r in totals.of(day).collect()}

    def frame(day):
        return spark.createDataFrame(counts[day], "server_addr string, n long")

    for day in counts:
        got = totals.roll(day, frame(day))
    history = spark.createDataFrame([(s, d, n) for d, v in counts.items() for s, n in v], "server_addr string, day string, n long")
    newest = {r.server_addr: (r.before_yesterday_num, r.yesterday_num, r.last_three_days_num)
              for r in mon.server_totals_by_day(history).orderBy("day").collect()}
    assert rows("2024-01-05") == newest and got.count() == 3
    # A corrected day rolls the days after it anew; a repeated one changes nothing.
    counts["2024-01-02"] = [("a", 70)]
    totals.roll("2024-01-02", frame("2024-01-02"))
    assert rows("2024-01-05")["a"] == (70, 1, 76)
    again = rows("2024-01-04")
    totals.roll("2024-01-04", frame("2024-01-04"))
    assert rows("2024-01-04") == again
    assert all("day=2024-01-04" in f for f in totals.of("2024-01-04").inputFiles())


def test_pages_open_their_ranges_only(spark):
    rows = [(i, (i * 7919) % 1000) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(5)
    table = PagedTable(spark, work_dir(spark, "paged"), [F.col("v").desc(), "id"])
    table.store(df, 16)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for number, size in ((1, 20), (13, 20), (250, 20), (251, 20), (3, 999), (6, 999)):
        assert [tuple(r) for r in table.page(number, size).collect()] == order[(number - 1) * size:number * size]
    page = table.page(200, 20)
    scan = page._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "_range" in scan and scan.count(",") <= 3
    empty = PagedTable(spark, work_dir(spark, "none"), ["id"])
    empty.store(df.limit(0), 4)
    assert empty.page(1).collect() == []
