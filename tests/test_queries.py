"""Every registered query against its checking SQL on the smallest tables."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

from skywarden.plans.catalog import QUERIES  # noqa: E402
from tests.check_queries import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")

# The ids that must be covered, by section.
IDS = ([f"s{i}" for i in range(1, 18)] + [f"p{i}" for i in range(1, 34)] + [f"f{i}" for i in range(1, 14)]
       + [f"j{i}" for i in range(1, 11)] + [f"a{i}" for i in range(1, 30)] + [f"w{i}" for i in range(1, 5)]
       + [f"t{i}" for i in range(1, 7)] + [f"u{i}" for i in range(1, 4)] + [f"r{i}" for i in range(1, 15)]
       + [f"x{i}" for i in range(1, 16)] + [f"g{i}" for i in range(1, 8)] + [f"d{i}" for i in range(1, 4)]
       + [f"n{i}" for i in range(1, 5)])


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_operator_has_a_query():
    have = {re.match(r"[a-z]+\d+", name).group() for name in QUERIES}
    assert sorted(set(IDS) - have) == []


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    query = QUERIES[name]
    assert query.sql is not None
    ok, note = compare(spark, con, query, SF)
    # Range and page queries may be empty on the smallest tables.
    assert ok or note.endswith("EMPTY") and "types" not in note, note


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert rows and all(r.flow_score > 40 for r in rows)
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
