"""Run registered queries next to their checking SQL and print every difference.

``python tests/check_queries.py [sf_dir] [name-prefix ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in r) for r in rows), key=repr)


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
          "date": "DATE", "float": "FLOAT"}


def compare(spark, con, query, sf_dir) -> tuple[bool, str]:
    df = query.run(spark, sf_dir)
    cols = sorted(df.columns)
    got = _sorted(df.select(*cols).collect())
    if query.sql is None:
        return True, f"{len(got)} rows, no SQL"
    rel = con.sql(query.sql)
    if sorted(rel.columns) != cols:
        return False, f"columns {cols} against {sorted(rel.columns)}"
    want = _sorted(rel.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall())
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    odd = [f"{c}:{t}/{kinds[c]}" for c, t in df.dtypes if _KINDS.get(t) != kinds[c]]
    note = f"{len(got)} rows" + (f", types {odd}" if odd else "") + ("" if got else ", EMPTY")
    if got == want:
        return not odd and bool(got), note
    bad = next(((a, b) for a, b in zip(got, want) if a != b), None)
    return False, f"{len(got)} against {len(want)} rows; first difference\n   {bad and bad[0]}\n   {bad and bad[1]}"


def main() -> int:
    from skywarden.plans.catalog import QUERIES
    from skywarden.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark = build_session(master="local[8]", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failed = 0
    for name, q in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, q, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
