"""Registered queries on the smallest tables, next to their SQL where there is any, and the pipeline stage by stage."""

from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

duckdb = pytest.importorskip("duckdb")

import corpus_pipeline  # noqa: E402
from skywarden.llm.catalog import QUERIES  # noqa: E402
from skywarden.llm.store import stored, table  # noqa: E402
from tests.check_queries import compare, connect  # noqa: E402
from tests.llm.test_neardup import brute as near_brute  # noqa: E402
from tests.llm.test_substring import brute as repeats_brute  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_against_sql(spark, name):
    run, sql = QUERIES[name]
    ok, note = compare(spark, connect(SF), SimpleNamespace(run=run, sql=sql), SF)
    assert ok, note


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if not sql])
def test_has_a_row_for_every_document(spark, name):
    got = {r.doc_id for r in QUERIES[name][0](spark, SF).select("doc_id").collect()}
    assert got == {r.doc_id for r in table(spark, SF, "documents").collect()}


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    import hashlib

    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), name)
        seen[name] = (before, docs)
        assert name == "packing" or docs.columns == columns
    before, after = seen["language"]
    assert before.count() - after.count() <= 2
    before, after = seen["near_duplicates"]
    want = {r[0] for r in near_brute([(r.doc_id, r.text) for r in before.collect()]) if r[3]}
    assert {r.doc_id for r in after.collect()} == want
    before, after = seen["passages"]
    left = {r.doc_id: hashlib.sha256(" ".join((r.text or "").split(" ")).encode()).hexdigest() for r in after.collect()}
    whole = {r.doc_id: r.text for r in before.collect()}
    for doc, n, gone, digest in repeats_brute([(r.doc_id, r.text) for r in before.collect()], 35):
        if not gone:
            assert {r.doc_id: r.text for r in after.where(f"doc_id = {doc}").collect()} == {doc: whole[doc]}
        elif gone < n:
            assert left[doc] == digest
        else:
            assert doc not in left
    before, after = seen["personal_data"]
    assert {(r.doc_id, len(r.text)) for r in before.collect()} == {(r.doc_id, len(r.text)) for r in after.collect()}
    assert sorted(r.doc_id for r in seen["packing"][1].where("piece = 0").collect()) == sorted(
        r.doc_id for r in after.collect())


def test_the_rest_works_without_these_folders(tmp_path):
    """The driver's entry module imports, and has the other queries, where this package is not there."""
    import shutil
    import subprocess
    import sys

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "skywarden", tmp_path / "skywarden", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); assert 'a1_block_count' in n and not any(k.startswith('op') for k in n)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


CLASHES = ["node", "label", "key", "kept", "score", "id", "row", "unit", "_kept", "_node", "_text", "_verdict", "lang_pred",
           "piece", "component_id", "n_replaced"]


def test_pipeline_takes_odd_rows(spark, edge_docs):
    """Shared and missing doc_ids, repeated rows, null texts, and columns that the operators use themselves."""
    from pyspark.sql import functions as F

    docs = edge_docs.drop(*[c for c in edge_docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")])
    docs = docs.unionByName(table(spark, SF, "documents").limit(60).withColumn("doc_id", F.col("doc_id") + 100))
    docs = docs.withColumns({c: F.lit("x") for c in CLASHES})
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, SF), name)
        if name == "packing":
            break
        assert after.columns == docs.columns and all(r == "x" for r in after.select("_node").distinct().toPandas()["_node"])
        if name == "near_duplicates":
            # A document that stays keeps each of its texts once; rows without a doc_id stay.
            rows = before.where("doc_id IS NOT NULL").join(after.select("doc_id").distinct(), "doc_id", "left_semi")
            assert sorted(map(str, after.where("doc_id IS NOT NULL").select("doc_id", "text").collect())) == sorted(
                map(str, rows.select("doc_id", "text").distinct().collect()))
            assert after.where("doc_id IS NULL").count() == before.where("doc_id IS NULL").count()
        before = after
    assert after.where("piece = 0").count() == before.count() > 40


def test_pipeline_takes_an_empty_table(spark, no_docs):
    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == 0
