"""Registered queries, each with the SQL that yields the same rows on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from skywarden.plans import adapter

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}

# Named building blocks of the checking SQL, in an order in which each may use the ones before it.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "requests": ((), adapter.REQUESTS_SQL),
    "raw": ((), adapter.RAW_SQL),
    "spiders": ((), adapter.SPIDERS_SQL),
}


def cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTES[name] = (needs, sql)


def with_ctes(sql: str, *names: str) -> str:
    """Put the named blocks and what they need in front of a SELECT."""
    wanted: list[str] = []

    def add(name: str) -> None:
        if name in wanted:
            return
        for need in CTES[name][0]:
            add(need)
        wanted.append(name)

    for name in names:
        add(name)
    head = ", ".join(f"{n} AS ({CTES[n][1]})" for n in wanted)
    return f"WITH {head} {sql}" if head else sql


def query(name: str, sql: str | None = None, *needs: str) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, run, None if sql is None else with_ctes(sql, *needs))
        return run
    return register
