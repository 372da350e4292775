from __future__ import annotations

import random
import zlib

import pytest
from skywarden.llm import language
from skywarden.llm.language import identify, in_known_language

SCHEMA = "doc_id long, text string, lang string, score int"


def text_of(rng, alphabet, common, n):
    return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice(alphabet) for _ in range(rng.randint(3, 9)))
                    for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    kinds = {"xx": ("abcdeé", ["da", "bec", "ad"]), "yy": ("mnopqß", ["mon", "pq", "on"]), "zz": ("abmnxy", ["ya", "nab", "xm"])}
    rows = [(i, text_of(rng, *kinds[lang], rng.randint(4, 40)), lang if i % 10 else None, 1)
            for i in range(400) for lang in [sorted(kinds)[i % 3]]]
    rows += [(900, None, "xx", 1), (901, "", "xx", 1), (902, "123 -- !!!", "yy", 1), (None, "bec ad da", None, 1),
             (903, "wholly unseen: 漢字", None, 1), (5, rows[5][1], rows[5][2], 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_held_out_accuracy_and_odd_rows(docs):
    rows = identify(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 400]
    right = [r.lang_pred == ["xx", "yy", "zz"][r.doc_id % 3] for r in held]
    assert len(held) > 60 and sum(right) / len(right) > 0.95
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (900, 901, 902))
    assert by_id[None].lang_pred == "xx" and by_id[903].lang_pred in ("xx", "yy", "zz")


def test_predictions_use_the_text_alone(spark, docs):
    other = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'xx' ELSE lang END AS lang")
    want = {(r.doc_id, r.lang_pred) for r in identify(docs).collect()}
    assert {(r.doc_id, r.lang_pred) for r in identify(other).collect()} == want


def test_longest_known_grams_decide():
    model = language.Model(["a", "b"], [{"word": 0}, {"\x02wor": 0, "abcde": 1}, {}, {}, {"ab": 0}, {"a": 0, "q": 1}], [
        __import__("numpy").array(x, "float32") for x in ([[-1, -2]], [[-3, -4], [-5, -6]], [], [], [[-7, -8]], [[-9, -10], [-11, -12]])])
    got = model.vectors(["word", "abcdef", "ab", "qaq", "zzz"]).tolist()
    assert got[0] == [-1, -2, 1] and got[1] == [-5, -6, 1] and got[2] == [-7, -8, 1]
    assert got[3] == [pytest.approx((-11 - 9 - 11) / 3), pytest.approx((-12 - 10 - 12) / 3), 1] and got[4] == [0, 0, 0]


def test_nothing_to_learn_from(docs, no_docs):
    rows = identify(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()
    assert {r.lang_pred for r in rows} == {"und"} and identify(no_docs).count() == 0


def test_stage_keeps_rows_with_a_language(docs):
    kept = in_known_language(docs)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert {900, 901, 902} <= gone and len(gone) <= 5


def test_hundreds_of_languages_are_learned(spark, monkeypatch):
    """Each language has a word of its own; none is left out, however many there are."""
    monkeypatch.setattr(language, "SAMPLE_OF_ALL", 1500)
    rows = [(i, f"w{chr(97 + n // 26 % 26)}{chr(97 + n % 26)}{chr(97 + n // 676)}q and the rest", f"l{n:03}", 0)
            for i, n in enumerate(n for n in range(300) for _ in range(8))]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert 900 < language.training_rows(docs).count() < 2100
    got = {r.doc_id: r.lang_pred for r in identify(docs).collect()}
    assert sum(got[r[0]] == r[2] for r in rows) / len(rows) > 0.95


def test_rows_without_doc_id_are_drawn_by_their_text(spark):
    docs = spark.createDataFrame([(None, f"text number {i}", "xx", 0) for i in range(2000)], SCHEMA)
    assert 400 < language.training_rows(docs).count() < 800


def test_very_long_texts(spark, docs):
    long = " ".join(["bec ad da"] * 200_000)
    both = docs.unionByName(spark.createDataFrame([(5000, long, None, 1)], SCHEMA))
    assert identify(both).where("doc_id = 5000").first().lang_pred == "xx"
