"""The ETL job and the scoring job as streams.

Both run the batch operators inside ``foreachBatch`` and write each batch under its number, so a batch that is
repeated after a loss replaces what it wrote and nothing is counted twice.
"""

from __future__ import annotations

import inspect
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from skywarden.operators import monitor as mon
from skywarden.operators.blacklist import latest_row, restore_blacklist
from skywarden.operators.line import from_line
from skywarden.operators.metrics import GAP_LIMIT_MS
from skywarden.operators.scoring import BLACKLIST_TTL_S, blacklist, score
from skywarden.operators.slices import slice_states
from skywarden.operators.tag import critical
from skywarden.plans.etl import Site, processed_lines
from skywarden.plans.scoring import scored_vectors
from skywarden.schema import BACKUP_SCHEMA, Flow
from skywarden.sources import folders, keyed
from skywarden.sources.archive import HourArchive
from skywarden.sources.writers import hour_columns, read_recent_hours, route, write_hourly_batch
from skywarden.streaming.windows import WindowTables

# Fixed value: length of a micro-batch.
BATCH_INTERVAL = "2 seconds"

BATCH_LOG_SCHEMA = ("query_id string, run_id string, name string, batch long, start_ms long, end_ms long, "
                    "source_count long, late_rows long")


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
          interval: str | None = BATCH_INTERVAL, mode: str = "append") -> StreamingQuery:
    """Run ``each`` on every micro-batch. Without an interval the available input is worked off and the query ends.

    Offsets live in the checkpoint: a restarted query goes on where the last one stopped.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def stop_gracefully(query: StreamingQuery, poll_s: float = 0.2) -> None:
    """Let the batch at work finish, then stop."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(poll_s)
    query.stop()


class BatchLog(StreamingQueryListener):
    """Writes what every micro-batch of the watched queries reports to a table, whatever the session keeps of it.

    Rows go out in files of ``every`` batches, and when a query ends; a batch that ran again has the later row.
    Register with ``spark.streams.addListener`` and call ``close`` before the table is read.
    """

    def __init__(self, spark: SparkSession, root: str, every: int = 100):
        self.spark, self.root, self.every = spark, root, every
        self.rows: list[tuple] = []
        self.files = 0
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        begin = _millis(p.timestamp)
        late = sum(int(op.numRowsDroppedByWatermark) for op in p.stateOperators)
        with self.lock:
            self.rows.append((str(p.id), str(p.runId), p.name, int(p.batchId), begin,
                              begin + int(p.durationMs.get("triggerExecution", 0)), int(p.numInputRows), late))
            if len(self.rows) >= self.every:
                self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self._flush()

    def close(self) -> None:
        """Wait for reports on their way, stop listening and write the rest."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.spark.streams.removeListener(self)
        with self.lock:
            self._flush()

    def _flush(self) -> None:
        if self.rows:
            # The rows of one file are as few as ``every``.
            self.spark.createDataFrame(self.rows, BATCH_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.root)
            self.rows, self.files = [], self.files + 1


def read_batch_log(spark: SparkSession, root: str) -> DataFrame:
    """Start, end, size and late rows of every batch; of a batch that ran again, the latest run."""
    rows = spark.read.schema(BATCH_LOG_SCHEMA).parquet(root)
    return latest_row(rows, ["query_id", "batch"], ["start_ms", "end_ms", "run_id"])


def _millis(iso: str) -> int:
    return int(datetime.fromisoformat(iso.replace("Z", "+00:00")).timestamp() * 1000)


def late_rows(log: DataFrame) -> DataFrame:
    """Rows that came after their window was closed and were dropped."""
    return log.agg(F.coalesce(F.sum("late_rows"), F.lit(0)).cast("long").alias("late_rows"))


def batch_time(batch: DataFrame) -> tuple[DataFrame, datetime | None]:
    """The batch without its ``batch_time``, and that time: it comes from the offset log, so a batch that is repeated
    after a loss has the time it had before. None for an empty batch."""
    return batch.drop("batch_time"), batch.agg(F.max("batch_time")).first()[0]


@dataclass
class EtlSinks:
    """Folders of the ETL job: routed lines and monitor snapshots."""

    routed: str
    monitor: str


def etl_batch(batch: DataFrame, batch_id: int, site: Site, sinks: EtlSinks, name: str,
              order: Sequence[str] = ("time_hint", "value"), begin_ms: int | None = None) -> None:
    """One batch of the ETL job: routed lines, link snapshot and throughput snapshot.

    Snapshots are keyed by ``begin_ms``, the time of the batch, so that a repeated batch replaces its own.
    """
    started = int(time.time() * 1000)
    begin = started if begin_ms is None else begin_ms
    lines = batch.withColumn("time_hint", F.get(F.split("value", "#CS#"), F.lit(8)))
    # Three outputs read the batch; it may spill to disk and is rebuilt from the source if a worker is lost.
    lines.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = route(processed_lines(lines, site)).select("topic", "value", F.lit(batch_id).alias("batch"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("topic", "batch").parquet(sinks.routed))

        at = F.timestamp_millis(F.lit(begin))
        one = lines.withColumn("_g", F.lit(1))
        link = mon.link_snapshot(one, list(order), ["_g"])
        entries = keyed.entries(link, mon.MONITOR_PREFIXES["link"], at, F.col("value"), mon.MONITOR_TTL_S)

        servers = mon.server_counts(one, ["_g"])
        total = servers.groupBy("_g").agg(
            F.sum("n").alias("source_count"),
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("server_addr", F.col("n").cast("int")))))
            .alias("servers_count_map"))
        log = mon.throughput(total.withColumns({
            "start_ms": F.lit(begin), "end_ms": F.lit(begin + int(time.time() * 1000) - started),
            "application_id": F.lit(batch.sparkSession.sparkContext.applicationId),
            "application_unique_name": F.lit(name)}))
        process = keyed.entries(log, mon.MONITOR_PREFIXES["process"], at, mon.throughput_snapshot(log),
                                mon.MONITOR_TTL_S)
        keyed.put(entries.unionByName(keyed.with_last(process, mon.MONITOR_PREFIXES["process"])),
                  sinks.monitor, batch_id)
    finally:
        lines.unpersist()


def run_etl(raw: DataFrame, site: Callable[[], Site], sinks: EtlSinks, checkpoint: str,
            interval: str | None = BATCH_INTERVAL, name: str = "etl") -> StreamingQuery:
    """Raw line stream to routed lines and snapshots. ``site`` is asked anew for every batch."""
    def each(batch: DataFrame, batch_id: int) -> None:
        rows, at = batch_time(batch)
        etl_batch(rows, batch_id, site(), sinks, name, begin_ms=at and int(at.timestamp() * 1000))
    return start(raw.withColumn("batch_time", F.current_timestamp()), each, checkpoint, interval)


@dataclass
class ScoringConfig:
    """Rules of the scoring job. ``longer`` has the flows of windows longer than ``window``, by length, shortest first;
    each a multiple of the one before. ``restore`` says whether a lost blacklist is put back from its backup, and
    ``expire_every`` after how many batches folders of entries that are over are dropped (0: never)."""

    flows: Sequence[Flow]
    critical_pages: Sequence[str]
    window: str = "5 minutes"
    watermark: str | None = "1 minute"
    threshold_ms: int = GAP_LIMIT_MS
    ttl_s: int = BLACKLIST_TTL_S
    flow_pick: str = "triggered"
    longer: Mapping[str, Sequence[Flow]] = field(default_factory=dict)
    restore: bool = True
    expire_every: int = 100

    def flows_of(self, length: str | None) -> Sequence[Flow]:
        return self.longer.get(length, ()) if length and length != self.window else self.flows


@dataclass
class ScoringSinks:
    """Folders of the scoring job: live blacklist, its hourly backup, scored vectors, throughput snapshots, partial
    results of the windows (needed for longer ones), and the archive of the lines."""

    live: str
    backup: str
    scored: str | None = None
    monitor: str | None = None
    partials: str | None = None
    archive: str | None = None


def write_scored(scored: DataFrame, batch_id: int, config: ScoringConfig, sinks: ScoringSinks,
                 written_at: datetime | None = None) -> None:
    """Scores and blacklist entries of one batch.

    Entries live from ``written_at``, the time of the batch; without it, from the request that was seen last.
    """
    scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if sinks.scored:
            (scored.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(sinks.scored))
        found = blacklist(scored, config.ttl_s, config.flow_pick,
                          written_at=None if written_at is None else F.lit(written_at))
        keyed.put(found, sinks.live, batch_id)
        write_hourly_batch(found.select("key_exp_time", "key", "value", "written_at"), sinks.backup, "written_at",
                           batch_id)
    finally:
        scored.unpersist()


def scored_windows(states: DataFrame, batch_id: int, config: ScoringConfig, sinks: ScoringSinks) -> DataFrame:
    """Scored vectors, with ``window_length``, of the finished slices of a batch and of the longer windows they complete."""
    tables = WindowTables(states.sparkSession, sinks.partials or "", config.window, list(config.longer), config.threshold_ms)
    found = tables.add(states, critical(config.critical_pages), batch_id)
    out = [score(vectors, config.flows_of(length)).withColumn("window_length", F.lit(length)) for length, vectors in found]
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def restore_if_lost(spark: SparkSession, sinks: ScoringSinks, batch_id: int, at: datetime, restore: bool = True) -> bool:
    """Put the backed-up entries that still live into a live table that lacks the mark of an earlier restore.

    The mark lies inside the live table, so it goes when the table goes. It is set after the entries are written, and
    these have a folder of their own that a repeated batch replaces; what is live already stays. Says whether it was done.
    """
    mark = f"{sinks.live}/_restored"
    if not restore or folders.whole(spark, mark):
        return False
    now = F.lit(at)
    live = keyed.live(spark, sinks.live, f"{at:%Y-%m-%d %H:%M:%S.%f}").select("key")
    rows = read_recent_hours(spark, sinks.backup, at.isoformat(), f"{BACKUP_SCHEMA}, written_at timestamp, batch long")
    back = restore_blacklist(rows, live, F.unix_millis(now)).select(
        "key", "value", F.timestamp_millis(F.col("key_exp_time").cast("long")).alias("expire_at"), now.alias("written_at"))
    # Batches count up from zero: the numbers below are free.
    keyed.put(back, sinks.live, -1 - batch_id)
    spark.range(1).select(F.lit(batch_id).alias("batch")).coalesce(1).write.mode("overwrite").json(mark)
    return True


def of_batch(config: Callable[..., ScoringConfig]) -> Callable[[int], ScoringConfig]:
    """The configuration as a function of the batch number, whether or not it asks for one."""
    return config if inspect.signature(config).parameters else lambda batch_id: config()


def run_scoring(lines: DataFrame, config: Callable[..., ScoringConfig], sinks: ScoringSinks, checkpoint: str,
                interval: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """Processed line stream to blacklist.

    With a watermark the metrics cover event-time windows, scored once when a window is complete; the state is one row
    per open slice, address and URL. Without one they cover a micro-batch each, in order of arrival. ``config`` is asked
    anew for every batch, with the batch's number if it takes one; window lengths and watermark hold from the start.
    """
    settings = of_batch(config)
    first = settings(0)
    requests = from_line(lines)
    windowed = first.watermark is not None
    if first.longer and not (windowed and sinks.partials):
        raise ValueError("longer windows need a watermark and a folder for partial results")
    rows = slice_states(requests.withWatermark("event_time", first.watermark), first.window) if windowed else requests

    def each(batch: DataFrame, batch_id: int) -> None:
        begin = time.time()
        # Time, count and scores read the batch; it may spill to disk and is rebuilt from the source if a worker is lost.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found, at = batch_time(batch)
            if at is None:
                return
            now = settings(batch_id)
            restore_if_lost(batch.sparkSession, sinks, batch_id, at, now.restore)
            if windowed:
                scored = scored_windows(found, batch_id, now, sinks)
            else:
                scored = scored_vectors(found, now.flows, now.critical_pages, None, now.threshold_ms)
            write_scored(scored, batch_id, now, sinks, at)
            if sinks.monitor:
                query_snapshot(found, batch_id, at, int((time.time() - begin) * 1000), sinks.monitor,
                               "n" if windowed else None)
            if now.expire_every and batch_id % now.expire_every == 0:
                keyed.drop_expired(batch.sparkSession, sinks.live, at.isoformat())
        finally:
            batch.unpersist()
    return start(rows.withColumn("batch_time", F.current_timestamp()), each, checkpoint, interval)


def run_scoring_job(lines: DataFrame, config: Callable[..., ScoringConfig], sinks: ScoringSinks, checkpoint: str,
                    interval: str | None = BATCH_INTERVAL, compact_every: int = 100) -> list[StreamingQuery]:
    """The whole scoring job: blacklist, and the lines as they came in the archive's hourly folders.

    The archive has a checkpoint of its own, so neither output waits for the other or is written twice.
    """
    scoring = run_scoring(lines, config, sinks, f"{checkpoint}/scoring", interval)
    if not sinks.archive:
        return [scoring]
    arrived = lines.select("value", F.current_timestamp().alias("arrived_at"))
    return [scoring, run_archive(arrived, sinks.archive, "arrived_at", f"{checkpoint}/archive", interval, compact_every)]


def query_snapshot(rows: DataFrame, batch_id: int, at: datetime, cost_ms: int, root: str,
                   weight: str | None = None) -> None:
    """Throughput snapshot of a batch of the scoring job, under the key prefix of queries."""
    begin = int(at.timestamp() * 1000)
    count = F.sum(weight) if weight else F.count(F.lit(1))
    log = mon.throughput(rows.agg(count.cast("long").alias("source_count")).withColumns({
        "start_ms": F.lit(begin), "end_ms": F.lit(begin + cost_ms),
        "application_id": F.lit(rows.sparkSession.sparkContext.applicationId),
        "application_unique_name": F.lit("scoring"), "servers_count_map": F.lit(None).cast("map<string,int>")}))
    prefix = mon.MONITOR_PREFIXES["query"]
    entries = keyed.entries(log, prefix, F.lit(at), mon.throughput_snapshot(log), mon.MONITOR_TTL_S)
    keyed.put(keyed.with_last(entries, prefix), root, batch_id)


def run_archive(lines: DataFrame, root: str, time_col: str, checkpoint: str,
                interval: str | None = BATCH_INTERVAL, compact_every: int = 0) -> StreamingQuery:
    """Append raw lines to hourly folders. Every ``compact_every`` batches (0: never) the finished batches of the hours
    at hand are merged; ``HourArchive`` reads the hours either way."""
    archive = HourArchive(lines.sparkSession, root, lines.schema)

    def each(batch: DataFrame, batch_id: int) -> None:
        write_hourly_batch(batch, root, time_col, batch_id)
        if compact_every and batch_id % compact_every == 0:
            # As many as the hours that one batch reaches into.
            for row in batch.select(*[c.alias(n) for n, c in hour_columns(F.col(time_col)).items()]).distinct().collect():
                # This batch may still be repeated; the ones before it are done.
                archive.compact(row.dt, row.hh, batch_id - 1)
    return start(lines, each, checkpoint, interval)


def run_forward(stream: DataFrame, fmt: str, options: dict[str, str], checkpoint: str,
                interval: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """Routed lines to a message system: one writer, the ``topic`` column says where each line goes."""
    writer = (stream.select("topic", "value").writeStream.format(fmt).options(**options)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def read_file_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """Parquet folder as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
