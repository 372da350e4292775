"""Server traffic, throughput snapshots and host status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywarden.functions.times import second_text
from skywarden.operators.parse import ACTIVE_SLOT, RAW_SLOTS
from skywarden.schema import SEPARATOR

# Key prefixes of monitor snapshots and their lifetime.
MONITOR_PREFIXES = {
    "process": "CSANTI_MONITOR_DP", "link": "CSANTI_MONITOR_LP",
    "query": "CSANTI_MONITOR_QUERY", "book": "CSANTI_MONITOR_BOOK",
}
LAST_SUFFIX = "_LAST"
MONITOR_TTL_S = 120

# JSON layouts of the snapshots.
THROUGHPUT_SCHEMA = ("costTime string, applicationId string, applicationUniqueName string, countPerMillis string, "
                     "endTime string, sourceCount string, serversCountMap map<string,int>")
LINK_SCHEMA = "serversCountMap map<string,int>, activeNumMap map<string,int>"


def _slots(column: str) -> Column:
    return F.split(F.col(column), SEPARATOR)


def server_counts(lines: DataFrame, by: Sequence[str] = (), column: str = "value") -> DataFrame:
    """Raw lines per server; lines too short to name one count under the empty key."""
    server = F.coalesce(F.get(_slots(column), F.lit(RAW_SLOTS["server_addr"])), F.lit(""))
    return (lines.withColumn("server_addr", server).groupBy(*by, "server_addr")
            .agg(F.count(F.lit(1)).alias("n")))


def active_connections(lines: DataFrame, order: Sequence[str], by: Sequence[str] = (),
                       column: str = "value") -> DataFrame:
    """Last reported active connections per server; lines without the figure report 1 under the empty key."""
    parts = _slots(column)
    active = F.coalesce(F.get(parts, F.lit(ACTIVE_SLOT)), F.lit(""))
    told = active != ""
    server = F.when(told, F.get(parts, F.lit(RAW_SLOTS["server_addr"]))).otherwise(F.lit(""))
    number = F.when(told, active.try_cast("int")).otherwise(F.lit(1))
    return (lines.withColumns({"server_addr": server, "_active": number})
            .groupBy(*by, "server_addr")
            # A figure that is no number is passed over.
            .agg(F.max_by("_active", F.when(F.col("_active").isNotNull(), F.struct(*order))).alias("active_num")))


def link_counts(lines: DataFrame, order: Sequence[str], by: Sequence[str] = (), column: str = "value") -> DataFrame:
    """Both figures per server."""
    return server_counts(lines, by, column).join(
        active_connections(lines, order, by, column), [*by, "server_addr"], "full_outer")


def link_snapshot(lines: DataFrame, order: Sequence[str], by: Sequence[str], column: str = "value") -> DataFrame:
    """One JSON per group with the two maps server to figure; each holds one entry per server of the site."""
    per = link_counts(lines, order, by, column)

    def as_map(value: str) -> Column:
        entries = F.collect_list(F.when(F.col(value).isNotNull(), F.struct("server_addr", F.col(value).cast("int"))))
        return F.map_from_entries(F.array_sort(entries))

    out = per.groupBy(*by).agg(as_map("n").alias("serversCountMap"), as_map("active_num").alias("activeNumMap"))
    return (out.where((F.size("serversCountMap") > 0) & (F.size("activeNumMap") > 0))
            .withColumn("value", F.to_json(F.struct("serversCountMap", "activeNumMap"))))


def rate_per_ms(count: Column, cost_ms: Column, whole: bool = False) -> Column:
    """Rows per millisecond, zero for a zero duration; ``whole`` truncates like integer division."""
    rate = F.coalesce(F.try_divide(count.cast("double"), cost_ms.cast("double")), F.lit(0.0))
    return F.floor(rate).cast("double") if whole else rate


def throughput(batches: DataFrame, whole: bool = False) -> DataFrame:
    """Batch log (start_ms, end_ms, source_count) with duration, rate and end time."""
    cost = F.col("end_ms") - F.col("start_ms")
    return batches.withColumns({
        "cost_time": cost,
        "count_per_millis": rate_per_ms(F.col("source_count"), cost, whole),
        "end_time": second_text(F.timestamp_millis("end_ms"))})


def throughput_snapshot(df: DataFrame) -> Column:
    """Snapshot JSON out of the columns of ``throughput`` plus application names and the per-server map."""
    return F.to_json(F.struct(
        F.col("cost_time").cast("string").alias("costTime"),
        F.col("application_id").alias("applicationId"),
        F.col("application_unique_name").alias("applicationUniqueName"),
        F.col("count_per_millis").cast("string").alias("countPerMillis"),
        F.col("end_time").alias("endTime"),
        F.col("source_count").cast("string").alias("sourceCount"),
        F.col("servers_count_map").alias("serversCountMap")))


def decode_throughput(kv: DataFrame) -> DataFrame:
    """Snapshots out of stored JSON; text that is no snapshot is dropped."""
    return (kv.withColumn("_s", F.from_json("value", THROUGHPUT_SCHEMA))
            .where(F.col("_s.endTime").isNotNull())
            .select("key", F.col("_s.costTime").alias("cost_time"), F.col("_s.applicationId").alias("application_id"),
                    F.col("_s.applicationUniqueName").alias("application_unique_name"),
                    F.col("_s.countPerMillis").alias("count_per_millis"), F.col("_s.endTime").alias("end_time"),
                    F.col("_s.sourceCount").alias("source_count"),
                    F.col("_s.serversCountMap").alias("servers_count_map")))


def decode_link(kv: DataFrame) -> DataFrame:
    return (kv.withColumn("_s", F.from_json("value", LINK_SCHEMA)).where(F.col("_s").isNotNull())
            .select("key", F.col("_s.serversCountMap").alias("servers_count_map"),
                    F.col("_s.activeNumMap").alias("active_num_map")))


def link_totals(snapshots: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of the per-server maps over all snapshots."""
    return (snapshots.select(*by, F.explode("servers_count_map").alias("server_addr", "_n"))
            .groupBy(*by, "server_addr").agg(F.sum("_n").cast("long").alias("n")))


def in_time_range(snapshots: DataFrame, start: str | None, end: str | None, today: str | None = None,
                  column: str = "end_time") -> DataFrame:
    """Snapshots strictly inside the bounds, compared as text; blank bounds mean all of yesterday."""
    def blank(x: str | None) -> bool:
        return x is None or x.strip() == "" or x.lower() == "null"
    day = F.to_date(F.lit(today)) if today else F.current_date()
    low = second_text(F.date_sub(day, 1).cast("timestamp")) if blank(start) else F.lit(start)
    high = second_text(day.cast("timestamp")) if blank(end) else F.lit(end)
    return snapshots.where((F.col(column) > low) & (F.col(column) < high))


def last_minutes(snapshots: DataFrame, minutes: int, now: str, column: str = "end_time",
                 active: bool = True) -> DataFrame:
    """Snapshots of the last minutes before ``now``; ``active=False`` keeps all, as the old console did."""
    if not active:
        return snapshots
    low = second_text(F.to_timestamp(F.lit(now)) - F.make_dt_interval(mins=F.lit(minutes)))
    return snapshots.where((F.col(column) > low) & (F.col(column) < F.lit(now)))


def forward_series(snapshots: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Times and counts in time order with their sum; meant for a bounded range of snapshots per group."""
    points = F.array_sort(F.collect_list(F.struct("end_time", "source_count")))
    return (snapshots.groupBy(*by).agg(points.alias("_p"), F.sum(F.col("source_count").try_cast("double")).alias("sum"))
            .select(*by, F.transform("_p", lambda p: p["end_time"]).alias("time"),
                    F.transform("_p", lambda p: p["source_count"]).alias("value"), "sum"))


def newest_snapshot(snapshots: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The snapshot with the latest end time; ties go to the greatest key."""
    rest = [c for c in snapshots.columns if c not in by]
    picked = snapshots.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct("end_time", "key")).alias("_s"))
    return picked.where(F.col("_s").isNotNull()).select(*by, "_s.*")


def server_traffic(newest: DataFrame) -> DataFrame:
    """Per-server rows of a newest snapshot."""
    keep = [c for c in newest.columns if c != "servers_count_map"]
    return newest.select(*keep, F.explode("servers_count_map").alias("server_addr", "n"))


def drain(snapshots: DataFrame, now: str, older_minutes: int = 30) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split off snapshots older than the bound: parent rows, per-server child rows, and what stays.

    The stored key links child to parent, so repeating an interrupted move yields the same rows.
    """
    bound = second_text(F.to_timestamp(F.lit(now)) - F.make_dt_interval(mins=F.lit(older_minutes)))
    old = snapshots.where(F.col("end_time") < bound)
    end = F.to_timestamp("end_time")
    parent = old.select(
        F.col("key").alias("id"), "cost_time", "application_id", "count_per_millis", "application_unique_name",
        end.alias("end_time"), F.col("source_count").try_cast("double").alias("source_count"))
    child = (old.select(F.col("key").alias("parent_id"), F.col("end_time").alias("_end"),
                        F.explode("servers_count_map").alias("ip_address", "_v"))
             .select("parent_id", "ip_address", F.col("_v").cast("double").alias("ip_value"),
                     F.to_timestamp("_end").alias("end_time")))
    stays = snapshots.where(~(F.col("end_time") < bound))
    return parent, child, stays


def daily_flow(parent: DataFrame, day: str | None = None) -> DataFrame:
    """Sum of source counts per day, or of one day."""
    rows = parent.withColumn("day", F.to_date("end_time"))
    if day is not None:
        rows = rows.where(F.col("day") == F.to_date(F.lit(day)))
    return rows.groupBy("day").agg(F.sum("source_count").alias("flow_num"))


def roll_server_totals(history: DataFrame, today: DataFrame) -> DataFrame:
    """Shift the per-server totals by a day; servers without traffic today stay as they were."""
    h, t = history.alias("h"), today.alias("t")
    n, yesterday, before = F.col("t.n"), F.col("h.yesterday_num"), F.col("h.before_yesterday_num")
    seen, known = n.isNotNull(), yesterday.isNotNull()
    return h.join(t, F.col("h.server_name") == F.col("t.server_addr"), "full_outer").select(
        F.coalesce(F.col("h.server_name"), F.col("t.server_addr")).alias("server_name"),
        F.when(~seen, before).when(known, yesterday).otherwise(F.lit(0)).cast("long").alias("before_yesterday_num"),
        F.when(seen, n).otherwise(yesterday).cast("long").alias("yesterday_num"),
        F.when(~seen, F.col("h.last_three_days_num"))
        .otherwise(n + F.coalesce(yesterday, F.lit(0)) + F.coalesce(before, F.lit(0)))
        .cast("long").alias("last_three_days_num"))


def server_totals_by_day(daily: DataFrame) -> DataFrame:
    """The same totals for every day of a history (server_addr, day, n): days with traffic, in order."""
    w = Window.partitionBy("server_addr").orderBy("day")
    return daily.select(
        "server_addr", "day", F.col("n").alias("yesterday_num"),
        F.coalesce(F.lag("n").over(w), F.lit(0)).alias("before_yesterday_num"),
        F.sum("n").over(w.rowsBetween(-2, 0)).cast("long").alias("last_three_days_num"))


def server_view(totals: DataFrame, newest_link: DataFrame) -> DataFrame:
    """Server totals with the active connections of the newest link snapshot."""
    active = newest_link.select(F.explode("active_num_map").alias("server_name", "active_num"))
    return totals.join(active, "server_name", "inner")


def host_status(metrics: DataFrame) -> DataFrame:
    """Newest system row per host with the sizes of its file systems: CPU, memory and disk in percent.

    ``metrics`` has kind (system or filesystem), ts, host, cpu_system, cpu_user, mem_total, mem_used, mem_used_p,
    device, mount, fs_total and fs_used.
    """
    # Rows of one time are told apart by their values, so that every run picks the same.
    usage, size = ("cpu_system", "cpu_user", "mem_total", "mem_used", "mem_used_p"), ("fs_total", "fs_used")
    system = (metrics.where("kind = 'system'").groupBy("host").agg(
        F.max_by(F.struct(*usage), F.struct("ts", *usage)).alias("_s"), F.max("ts").alias("state_time")))
    disks = (metrics.where("kind = 'filesystem'").groupBy("host", "device", "mount")
             .agg(F.max_by(F.struct(*size), F.struct("ts", *size)).alias("_f"))
             .groupBy("host").agg(F.sum("_f.fs_total").alias("fs_total"), F.sum("_f.fs_used").alias("fs_used")))

    def unit(value: Column, size: int) -> Column:
        return F.floor(value / size).cast("string")

    return system.join(disks, "host", "left").select(
        "host", "state_time",
        F.round((F.col("_s.cpu_system") + F.col("_s.cpu_user")) * 100, 2).alias("cpu_rate"),
        (F.col("_s.mem_used_p") * 100).alias("memory_rate"),
        # Display units are 10^6 for memory and 10^7 for disks.
        F.concat(unit(F.col("_s.mem_used"), 1_000_000), F.lit("M/"), unit(F.col("_s.mem_total"), 1_000_000),
                 F.lit("M")).alias("memory_info"),
        F.concat(unit(F.col("fs_used"), 10_000_000), F.lit("G/"), unit(F.col("fs_total"), 10_000_000),
                 F.lit("G")).alias("disk_info"),
        F.round(F.try_divide(F.col("fs_used").cast("double"), F.col("fs_total").cast("double")) * 100, 2)
        .alias("disk_rate"))
