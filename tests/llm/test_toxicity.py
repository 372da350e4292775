from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from skywarden.llm import toxicity
from skywarden.llm.toxicity import kernel, toxicity as judge
from tests.llm.rows import words

BAD = ["grobnik", "vlutch", "skarp", "dreffel"]


def plain_kernel(a, b):
    def features(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                    key = w[i] + w[j] + w[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return out

    f, g = features(a), features(b)
    norm = (sum(x * x for x in f.values()) * sum(x * x for x in g.values())) ** 0.5
    return sum(x * g.get(k, 0) for k, x in f.items()) / norm if norm else 0.0


def test_kernel_against_a_plain_version():
    one, two = ["banana", "abc", "grobnik", "aaaaaa", "no", "longerwordthanmost"], ["bandana", "abc", "grobxnik", "aaa"]
    assert np.allclose(kernel(one, two), [[plain_kernel(a, b) for b in two] for a in one], atol=1e-5)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(700):
        text = words(rng, rng.randint(5, 60)).split()
        bad = i % 4 == 0
        if bad:
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        docs.append((i, " ".join(text) + ".", 0))
        if i % 5:
            labels.append((i, 1, int(bad)))
    docs += [(900, None, 0), (901, "", 0), (902, "?!", 0), (None, "abc def", 0), (903, "you g r o b n i k you", 0),
             (904, "such a v.l.u.t.c.h", 0), (905, "gro-bnik", 0), (906, "a b c d e f", 0), (907, "drexffel", 0), (0, docs[0][1], 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string, score int").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_texts_and_altered_words(tables):
    docs, labels = tables
    rows = judge(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 700]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.95
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].predicted for i in (903, 904, 905)) and not any(by_id[i].predicted for i in (900, 901, 902, 906, None))
    assert by_id[907].score > by_id[906].score


def test_labels_of_one_kind_or_none(spark, tables, no_docs):
    docs, labels = tables
    assert {r.score for r in judge(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert {r.score for r in judge(docs, labels.limit(0)).collect()} == {0.0}
    assert judge(no_docs, labels).count() == 0


def test_words_are_scored_once_and_spelled_ones_only_where_letters_stand_in_a_row():
    """However small the memory is, figures are the same; a text without three letters in a row asks for no more words."""
    rng = random.Random(5)
    rows = [{"toxic": int(i % 4 == 0), "place": rng.random(), "weight": 1.0,
             "words": sorted({*words(rng, 20).split(), *([rng.choice(BAD)] if i % 4 == 0 else [])})} for i in range(300)]
    model = toxicity.fit(pd.DataFrame(rows))
    texts = pa.array(["a , b ; c I said " + words(rng, 30) for _ in range(40)] + ["x s k a r p y", "g r . o b", None, "", "a b"])
    asked, plain_words = [], model.words
    model.words = lambda found: asked.append(len(found)) or plain_words(found)
    scorer = toxicity.Scorer(model)
    figures = scorer.figures(texts)
    assert len(asked) == 2 and asked[1] == 1
    scorer._forget(3)
    by_one = np.concatenate([scorer.figures(texts.slice(i, 1)) for i in range(len(texts))])
    assert np.array_equal(figures, by_one)


def test_words_that_tell_only_together(spark):
    """One stem with ever other endings: one such word is in clean texts, too, several make a text toxic."""
    rng = random.Random(8)
    ends = ["".join(rng.choice("klmnoprstuv") for _ in range(3)) for _ in range(60)]
    docs, labels = [], []
    for i in range(1200):
        text = words(rng, rng.randint(30, 60)).split()
        n = rng.randint(4, 7) if i % 12 == 0 else int(i % 8 == 1)
        for end in rng.sample(ends, n):
            text.insert(rng.randrange(len(text)), "zwyrx" + end)
        if i % 12 == 6:
            text.insert(rng.randrange(len(text)), "grobnik")
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 6 == 0)))
    rows = judge(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                 spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    found = {kind: [r.predicted for r in rows if r.doc_id % 12 == kind] for kind in (0, 6)}
    clean = [r.predicted for r in rows if r.doc_id % 6]
    assert sum(found[0]) > 0.8 * len(found[0]) and sum(found[6]) > 0.8 * len(found[6]) and sum(clean) < 0.05 * len(clean)
