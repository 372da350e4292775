from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from skywarden.llm import hardneg
from skywarden.llm.hardneg import hard_negatives, products

SCHEMA = "vec_id long, embedding array<float>, label int, r long, a int, vector string, anchor boolean, score double"


def rows(seed: int = 3, n: int = 400, dims: int = 8) -> list[tuple]:
    rng = np.random.default_rng(seed)
    made = [(i, [float(x) for x in np.float32(rng.normal(size=dims) * 0.4)], int(rng.integers(0, 4))) for i in range(n)]
    made += [(n + i, made[11][1], i % 2) for i in range(30)]
    made += [made[100], made[100], made[200], (201, made[200][1], 1), (100, made[7][1], made[100][2])]
    made += [(None, made[0][1], 1), (n + 50, None, 1), (n + 51, made[3][1], None), (n + 52, [0.5] * 7 + [None], 1),
             (n + 53, [float("nan")] * 8, 1), (n + 54, [float("inf")] * 8, 2), (n + 55, [], 1), (n + 56, [0.7, 0.2], 2),
             (n + 57, [-1e-9] * 8, 3), (n + 58, [1e30] + [0.1] * 7, 0), (500, [0.0] * 8, 9)]
    return [(*r, 1, 2, "v", False, 0.5) for r in made]


def brute(table: list[tuple]) -> list[tuple]:
    fit = [(i, [math.floor(256 * x) for x in v], label) for i, v, label, *_ in table
           if i is not None and v is not None and label is not None
           and all(x is not None and math.isfinite(x) and abs(256 * x) < 1 << 24 for x in v)]
    out = []
    for at, (anchor, vector, label) in enumerate(fit):
        if anchor % 100:
            continue
        met = sorted((-sum(x * y for x, y in zip(vector, v)), i, other) for k, (i, v, other) in enumerate(fit) if k != at)
        for score, positive, _ in [m for m in met if m[2] == label][:5]:
            near = [m for m in met if m[2] != label and 80 * -score <= 100 * -m[0] <= 100 * -score][:5]
            out += [(anchor, positive, k + 1, m[1], -score, -m[0]) for k, m in enumerate(near)]
    return sorted(out)


def found(spark, table: list[tuple]) -> list[tuple]:
    got = hard_negatives(spark.createDataFrame(table, SCHEMA).repartition(3), F.col("vec_id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_equals_brute_force_with_ties_repeats_and_odd_rows(spark):
    table = rows()
    want = brute(table)
    assert len(want) > 50
    assert found(spark, table) == want


def test_small_tiles_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "ANCHORS", 2)
    monkeypatch.setattr(hardneg, "LEAST_CANDIDATES", 16)
    table = rows(5)
    assert found(spark, table) == brute(table)


def test_vectors_of_any_size_of_number(spark):
    """Components that leave room for one candidate to a wide integer, or for none."""
    for scale in (3e2, 3e4):
        table = [(i, [float(np.float32(x * scale)) for x in v], label, *rest) for i, v, label, *rest in rows(7, 300)
                 if v is not None and None not in v]
        assert found(spark, table) == brute(table)


def test_no_rows_and_no_anchors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [0.5], 1, 1, 1, "", True, 0.0), (2, [0.5], 2, 1, 1, "", True, 0.0)]) == []
    assert found(spark, [(100, [0.5], 1, 1, 1, "", True, 0.0), (2, [0.5], 2, 1, 1, "", True, 0.0)]) == []


@pytest.mark.parametrize("size", [1, 200, 40_000, 1 << 22])
def test_products_are_exact(size):
    rng = np.random.default_rng(size)
    a, c = rng.integers(-size, size + 1, (7, 33)), rng.integers(-size, size // 3 + 1, (23, 33))
    assert (products(a, c) == a @ c.T).all()
    assert products(a[:0], c).shape == (0, 23) and products(a, c[:0]).shape == (7, 0)
    assert (products(a[:, :0], c[:, :0]) == 0).all()
