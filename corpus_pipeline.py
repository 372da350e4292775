"""Corpus pipeline: from raw documents to packed training sequences, one operator a stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.llm.catalog import PSEUDONYM_KEY
from skywarden.llm.language import in_known_language
from skywarden.llm.neardup import near_duplicates
from skywarden.llm.packing import pack
from skywarden.llm.pseudonyms import pseudonymous
from skywarden.llm.store import stored, table
from skywarden.llm.substring import without_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; texts without a letter and undecided ones go."""
    return in_known_language(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: the one with the smallest doc_id. Of its rows, one of each text."""
    # Rows without a doc_id are in no group and stay.
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    text = next(f"_text{'_' * n}" for n in range(len(docs.columns) + 1) if f"_text{'_' * n}" not in docs.columns)
    named = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").withColumn(
        text, F.xxhash64(F.coalesce("text", F.lit("")))).dropDuplicates(["doc_id", text])
    return named.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand elsewhere; documents of which nothing is left go."""
    return without_repeats(docs)


def without_names(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data under pseudonyms."""
    return pseudonymous(docs, PSEUDONYM_KEY).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("passages", without_passages),
    ("personal_data", without_names),
    ("packing", packed),
]

# Language identification and tokens are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
