from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from skywarden.llm import store, substring
from skywarden.llm.substring import removed_words, without_repeats
from skywarden.llm.words import word_slices
from tests.llm.rows import WORD, words


def brute(rows, window):
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("window", [4, 7, 35])
def test_edge_rows(edge_docs, window):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(removed_words(edge_docs, window)) == brute(rows, window)


@pytest.mark.parametrize("window", [5, 12, 35])
def test_planted_passages(spark, window):
    rng = random.Random(window)
    passages = [words(rng, window + extra) for extra in (-1, 0, 1, 30)]
    rows = []
    for i in range(60):
        parts = [words(rng, rng.randint(0, 80)) for _ in range(3)]
        parts.insert(1, rng.choice(passages))
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts)))
    # A passage twice in one text, and a loop that overlaps itself.
    rows += [(90, passages[1] + " apart " + passages[1]), (91, "a b c " * 40)]
    assert got(removed_words(spark.createDataFrame(rows, "doc_id long, text string"), window)) == brute(rows, window)


def test_anchors_of_a_text_with_more_words_than_place_bits_number(monkeypatch):
    (_, _, text), = word_slices(pa.array([words(random.Random(4), 500)]))
    starts, anchor = substring._anchors(text, 8)
    monkeypatch.setattr(substring, "_PLACE_BITS", 4)
    again, few = substring._anchors(text, 8)
    assert (again == starts).all() and (few >= starts).all() and (few <= starts + 6).all() and np.array_equal(few, anchor)


def test_without_repeats_keeps_columns_and_the_rest(spark):
    rng = random.Random(1)
    common = words(rng, 60)
    rows = [(1, "start " + common + " end", "en", 9), (2, common, "en", 9), (3, "alone  here", "de", 11), (4, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    result = {r.doc_id: (r.text, r.n_chars) for r in without_repeats(docs).collect()}
    assert result == {1: ("start end", 9), 3: ("alone  here", 11), 4: (None, None)}
    assert without_repeats(docs).columns == docs.columns


def test_empty_table(no_docs):
    assert removed_words(no_docs).count() == 0 and without_repeats(no_docs).columns == no_docs.columns


def test_only_texts_that_may_lose_words_are_moved(spark):
    rng = random.Random(6)
    common = words(rng, 50)
    rows = [(i, words(rng, 120) + (" " + common if i < 3 else "")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, known = substring.changed_texts(docs)
    met = store.possible(docs.withColumn("_part", F.xxhash64("text")), "_part", known, "met").where("met").collect()
    assert {0, 1, 2} <= {r.doc_id for r in met} and len(met) < 20


def test_filter_of_hashes_loses_none_even_when_full(spark, monkeypatch):
    monkeypatch.setattr(store, "FILTER_BITS", 2)
    rng = random.Random(8)
    common = words(rng, 20)
    rows = [(i, words(rng, 30) + " " + common * (i % 3)) for i in range(40)] + [(40, None), (41, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(removed_words(docs, 12)) == brute(rows, 12)
    assert docs.count() >= without_repeats(docs, 12).count() >= 15
    hashes = [0, 1, -1, 32767, 32768, 2 ** 63 - 1, -2 ** 63]
    for bits in (2, 15, 26):
        monkeypatch.setattr(store, "FILTER_BITS", bits)
        ids = spark.createDataFrame([(h,) for h in hashes], "hash long")
        known = store.hash_filter(ids.where("hash NOT IN (-1, 32767)"))
        near = {h % 2 ** bits for h in hashes if h not in (-1, 32767)}
        assert {r.hash: r.met for r in store.possible(ids, "hash", known, "met").collect()} == {
            h: h % 2 ** bits in near for h in hashes}
