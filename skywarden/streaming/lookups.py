"""Lookup tables that a running job reloads: by change flags, or by versions that are stored with each batch."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.operators.metrics import GAP_LIMIT_MS
from skywarden.operators.scoring import BLACKLIST_TTL_S
from skywarden.sources import folders
from skywarden.sources.readers import flow_rules, load_flows, load_lookup
from skywarden.streaming.jobs import ScoringConfig

_FLAG_SCHEMA = "value string, at timestamp"


class ChangeFlags:
    """Change flags, a folder of one row each: a new value replaces the one before."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def put(self, name: str, value: str) -> None:
        (self.spark.range(1).select(F.lit(value).alias("value"), F.current_timestamp().alias("at"))
         .coalesce(1).write.mode("overwrite").json(f"{self.path}/{name}"))

    def get(self, name: str) -> str | None:
        """Value of a flag; none if it was never set or is being set just now."""
        try:
            row = self.spark.read.schema(_FLAG_SCHEMA).json(f"{self.path}/{name}").first()
        except AnalysisException as e:  # the folder appears with the first write
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return row and row.value


class Lookups:
    """Named lookups; ``refresh`` reloads those whose flag is raised or was never set, and lowers the flag.

    ``flag_names`` maps a lookup to the flag that an editor raises for it.
    """

    def __init__(self, loaders: dict[str, Callable[[], object]], flags: ChangeFlags,
                 flag_names: dict[str, str] | None = None) -> None:
        self.loaders, self.flags = loaders, flags
        self.flag_names = flag_names or {}
        self.values: dict[str, object] = {}

    def _flag(self, name: str) -> str:
        return self.flag_names.get(name, f"{name}ChangeFlag")

    def refresh(self) -> list[str]:
        """Reload what has changed and say what was reloaded."""
        done = []
        for name, load in self.loaders.items():
            flag = self.flags.get(self._flag(name))
            raised = flag is None or flag.strip() == "" or flag.lower() == "true"
            if raised or name not in self.values:
                # The flag goes down first, so that an edit during the load raises it again.
                if raised:
                    self.flags.put(self._flag(name), "false")
                self.values[name] = load()
                done.append(name)
        return done

    def __getitem__(self, name: str) -> object:
        return self.values[name]


class VersionedTables:
    """Small configuration tables kept by version: an edit publishes a whole new one and leaves the others as they are."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 20) -> None:
        self.spark, self.root, self.keep = spark, root, keep

    def _versions(self, name: str) -> list[int]:
        at = f"{self.root}/{name}"
        return sorted(int(n.removeprefix("version=")) for n in folders.names(self.spark, at)
                      if folders.whole(self.spark, f"{at}/{n}"))

    def publish(self, name: str, rows: DataFrame) -> int:
        """Store a new version and say its number. Versions beyond the ``keep`` newest go."""
        versions = self._versions(name)
        number = versions[-1] + 1 if versions else 1
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{name}/version={number}")
        for old in versions[:max(0, len(versions) + 1 - self.keep)]:
            folders.remove(self.spark, f"{self.root}/{name}/version={old}")
        return number

    def newest(self, name: str) -> int:
        """Number of the newest whole version."""
        versions = self._versions(name)
        if not versions:
            raise ValueError(f"no version of {name} was published")
        return versions[-1]

    def read(self, name: str, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/version={version}")


class BatchTables:
    """Which version of each table a batch uses: the newest when it first runs, the same one when it is repeated.

    The numbers are stored before the batch does any work, in one of ``slots`` folders that take turns, so they do not
    grow with the age of the job.
    """

    def __init__(self, tables: VersionedTables, names: Sequence[str], pins: str, slots: int = 100) -> None:
        self.tables, self.names, self.pins, self.slots = tables, list(names), pins, slots

    def versions(self, batch_id: int) -> dict[str, int]:
        spark, path = self.tables.spark, f"{self.pins}/slot={batch_id % self.slots}"
        try:
            row = spark.read.schema("batch long, versions string").json(path).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        if row is not None and row.batch == batch_id:
            return json.loads(row.versions)
        found = {name: self.tables.newest(name) for name in self.names}
        (spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), F.lit(json.dumps(found)).alias("versions"))
         .coalesce(1).write.mode("overwrite").json(path))
        return found

    def at(self, batch_id: int) -> dict[str, DataFrame]:
        return {name: self.tables.read(name, v) for name, v in self.versions(batch_id).items()}


# Tables a scoring configuration is read from.
SCORING_TABLES = ("process", "strategy", "rules", "rule_names", "critical_pages")


def scoring_config(tables: BatchTables, window: str = "5 minutes", watermark: str | None = "1 minute",
                   threshold_ms: int = GAP_LIMIT_MS, ttl_s: int = BLACKLIST_TTL_S, crawler_type: int = 0,
                   ) -> Callable[[int], ScoringConfig]:
    """Flows and critical pages of a batch out of their tables, read again only when a version has changed."""
    last: dict[str, object] = {}

    def config(batch_id: int) -> ScoringConfig:
        versions = tables.versions(batch_id)
        if last.get("versions") != versions:
            t = {name: tables.tables.read(name, v) for name, v in versions.items()}
            rows = flow_rules(t["process"], t["strategy"], t["rules"], t["rule_names"], crawler_type=crawler_type)
            pages = [r[0] for r in load_lookup(t["critical_pages"], "criticalPageMatchExpression", "page").collect()]
            last.update(versions=versions, flows=load_flows(rows), pages=sorted(pages))
        return ScoringConfig(last["flows"], last["pages"], window, watermark, threshold_ms, ttl_s)
    return config
