from __future__ import annotations

import random

import numpy as np
import pytest
from skywarden.llm import neardup
from skywarden.llm.neardup import near_duplicates
from tests.llm.rows import WORD, lowered, words


def shingles(text):
    w = WORD.findall(lowered(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same_id = rows[i][0] == rows[j][0]
            linked = both and 100 * both >= 75 * len(sets[i] | sets[j])
            if None not in (rows[i][0], rows[j][0]) and (linked or same_id and sets[i] and sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        least = None if doc is None else min(ids)
        out.append((doc, len(sets[i]), least, doc is None or doc == least))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dense_rows(seed=3, n=90, length=150, edits=4):
    """Near-copies of one text at a similarity around the threshold, so that many components share every bucket."""
    rng = random.Random(seed)
    base = words(rng, length).split()
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(edits if i % 3 else 1):
            text[rng.randrange(length)] = words(rng, 1)
        rows.append((i, " ".join(text)))
    return rows + [(n + i, words(rng, 80)) for i in range(40)]


@pytest.mark.parametrize("small", [4, 32])
def test_dense_group_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = dense_rows()
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_edge_rows(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(near_duplicates(edge_docs)) == brute(rows)


def test_empty_table(no_docs):
    result = near_duplicates(no_docs)
    assert result.columns == ["doc_id", "n_shingles", "component_id", "kept"] and result.count() == 0


def test_index_meets_every_pair_within_the_distance():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 16, neardup.SLOTS)
    for _ in range(200):
        two = one.copy()
        two[rng.choice(neardup.SLOTS, neardup.MAX_DISTANCE, replace=False)] += 1
        errors = (one != two).reshape(-1, neardup.CHUNK).sum(axis=1)
        assert errors.min() <= 1


def test_threshold_is_exact(spark):
    # 20 shingles against 15 of them: 15 / 20 is in, 14 / 19 and 44 / 59 are out.
    w = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(w[:24])), (2, " ".join(w[:19])), (3, " ".join(w[100:123])), (4, " ".join(w[100:118]))]
    assert [r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
            .orderBy("doc_id").collect()] == [1, 1, 3, 4]


def test_intersections_of_blocks():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 9000, 400).astype(np.uint64)) for _ in range(30)]
    counts = neardup._common(sets[:18], sets[18:])
    assert (counts == [[len(np.intersect1d(a, b)) for b in sets[18:]] for a in sets[:18]]).all()
