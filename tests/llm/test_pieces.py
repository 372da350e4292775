from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from skywarden.llm import pieces
from skywarden.llm.pieces import best_path, decode, encode, load, merged, merged_in_turns, unit_counts, unit_ids


def test_edge_rows_against_the_library(edge_docs, no_docs):
    model = load()
    texts = [(r.doc_id, r.text) for r in edge_docs.collect()]
    want = sorted((str(d), model.encode(t or "")) for d, t in texts)
    rows = decode(encode(edge_docs)).collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    assert sorted((str(r.doc_id), r.text) for r in rows) == sorted((str(d), t or "") for d, t in texts)
    assert encode(no_docs).count() == 0


def test_decoding_in_the_same_tasks(edge_docs, no_docs):
    rows = decode(encode(edge_docs)).collect()
    assert sorted((str(r.doc_id), r.ids, r.text) for r in encode(edge_docs, back=True).collect()) == sorted(
        (str(r.doc_id), r.ids, r.text) for r in rows)
    assert encode(no_docs, back=True).count() == 0


def test_distinct_units_are_few(spark):
    """What follows a word is no part of its unit unless some piece goes across."""
    words, ends = ["inspector", "lantern", "gather"], [",", ".", "$", ")", "!?", "\n", "###"]
    docs = spark.createDataFrame([(" ".join(w + e for w in words for e in ends),)], "text string")
    assert unit_counts(docs).count() < 15
    rows = unit_ids(unit_counts(docs)).collect()
    assert {r.n for r in rows if "inspector" in r.unit} == {len(ends)}


def test_one_pass_over_the_merges_equals_merging_in_turns(spark):
    """With scores in random order many merges make room for edges that were passed already."""
    rng = random.Random(4)
    names = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(2, 4))) for _ in range(60)})
    scores = {c: 0.0 for c in "abc"} | {p: -float(i) for i, p in enumerate(rng.sample(names, len(names)), 1)}
    table = spark.createDataFrame(pieces._ranked(scores), "piece string, rank long, risky boolean")
    units = spark.createDataFrame([("".join(rng.choice("abc") for _ in range(rng.randint(2, 60))),) for _ in range(300)], "unit string")
    rows = pieces._edges(units.distinct(), [], table, 4, pieces.merge_edge())
    size = F.char_length("unit")

    def plain(unit):
        parts = list(unit)
        while True:
            best = max(((scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    for unit, once, turns in rows.select("unit", merged(F.col("edges"), size), merged_in_turns(F.col("edges"), size)).collect():
        cuts = [i for i in range(len(unit) + 1) if once >> i & 1]
        assert once == turns and [unit[a:b] for a, b in zip(cuts, cuts[1:])] == plain(unit)


@pytest.mark.parametrize("frequent", [0, 3, 10 ** 6])
def test_long_units_and_odd_blanks(spark, monkeypatch, frequent):
    """However few units are sent to the tasks, the others come from the join."""
    monkeypatch.setattr(pieces, "FREQUENT", frequent)
    texts = ["  two  blanks ", "http://www.example.com/a/very/long/path?with=many&parts=that_go_on_and_on_and_on",
             "aaaaaaaaaabbbbbbbbbbb" * 8, "\x00\x01 é😀", "▁mark ▁", "the" * 40, "x\ny\tz", "1234567890" * 7]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = load()
    assert {r.doc_id: r.ids for r in encode(docs).collect()} == {i: model.encode(t) for i, t in enumerate(texts)}


def test_best_path_is_the_best_of_all(spark):
    table = {"a": -3.0, "b": -3.5, "ab": -4.0, "ba": -5.0, "aba": -6.5, "bab": -9.9}
    units = ["a", "ab", "ababab", "bbaab", "abacab", "ccc"]

    def every(unit):
        if not unit:
            return [(0.0, [])]
        heads = [(unit[:n], table.get(unit[:n], -20.0 if n == 1 else None)) for n in range(1, len(unit) + 1)]
        return [(s + rest, [h, *way]) for h, s in heads if s is not None for rest, way in every(unit[len(h):])]

    def edges(unit):
        return [(-table[unit[i:j]], i, j) for i in range(len(unit)) for j in range(i + 1, len(unit) + 1) if unit[i:j] in table]

    rows = spark.createDataFrame([(u, edges(u)) for u in units], "unit string, edges array<struct<cost:double,start:int,end:int>>")
    found = rows.select("unit", best_path(F.col("edges"), F.char_length("unit"), -20.0).alias("mask")).collect()
    for unit, mask in found:
        cuts = [i for i in range(len(unit) + 1) if mask >> i & 1]
        way = [unit[a:b] for a, b in zip(cuts, cuts[1:])]
        assert math.isclose(sum(table.get(w, -20.0) for w in way), max(s for s, _ in every(unit)))


def test_left_over_units_travel_in_few_bytes_and_come_back():
    rng = random.Random(3)
    units = ["".join(rng.choice("abéß語\n▁😀") for _ in range(rng.randint(2, 60))) for _ in range(300)]
    places = np.sort(np.array([rng.randrange(1 << 20) for _ in units]))
    ends = np.array([0, 0, 1, 40, 40, 300, 300])
    packed = pieces.pack_units(places, pa.array(["x", *units])[1:], ends)
    assert [x is None for x in packed] == [True, False, False, True, False, True]
    for a, b, raw in zip(ends, ends[1:], packed):
        if raw is not None:
            at, lengths, data = pieces.unpack_units(raw)
            stops = np.cumsum(lengths)
            assert at.tolist() == places[a:b].tolist()
            assert [data[e - n:e].decode() for n, e in zip(lengths, stops)] == units[a:b]
    assert sum(len(x) for x in packed if x) < sum(len(u.encode()) for u in units) + 8 * len(units)
    assert pieces.pack_units(np.array([], np.int64), pa.array([], pa.string()), np.array([0, 0])) == [None]


def test_texts_travel_in_groups_that_ask_once_for_a_unit(spark):
    """However often a unit is left over in neighbouring texts, their group sends one row to the join."""
    words = ["inspector", "lantern", "gather", "quartz"]
    docs = spark.createDataFrame([(i, " ".join(words[:i % 5] * 3)) for i in range(100)], "doc_id long, text string").coalesce(1)
    none = pa.table({"unit": pa.array([], pa.string()), "ids": pa.array([], pa.list_(pa.int32()))})
    sent = spark.sparkContext.broadcast((pieces._table_bytes(none), pieces.Packing(np.zeros(32_000))))
    half = pieces.half_encoded(docs, sent)
    rows = half.collect()
    assert [len(r.doc_ids) for r in rows] == [pieces.GROUP, 100 - pieces.GROUP]
    assert [d for r in rows for d in r.doc_ids] == list(range(100))
    assert [n for r in rows for n in r.lefts] == [3 * (i % 5) for i in range(100)]
    asked = pieces.left_over(half).collect()
    assert len(asked) == len(rows) * len(words)
    assert len({(r.row, r.unit) for r in asked}) == len(asked)


@pytest.mark.parametrize("frequent", [0, 2])
def test_units_at_the_ends_of_neighbouring_texts(spark, monkeypatch, frequent):
    """Texts of a group have their own units back, also where no id stands between the units of two texts."""
    monkeypatch.setattr(pieces, "FREQUENT", frequent)
    rng = random.Random(8)
    words = ["inspector", "lantern", "gather", "quartz", "", "é😀", "xq", "a" * 70]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 4))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    model = load()
    rows = encode(docs, back=True).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: model.encode(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in rows} == dict(enumerate(texts))
