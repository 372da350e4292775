from __future__ import annotations

from collections import Counter
from itertools import permutations

from skywarden.llm.interaction import audit, interactions
from tests.llm.rows import SCHEMA, WORD, edge_rows

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
LABELS = [(6, 1, 0), (7, 1, 0), (7, 0, 1), (9, 0, 1), (10, 1, 1), (13, None, 1), (17, 1, None), (None, 1, 1), (999, 1, 1)]


def brute(rows: list[tuple], labels: list[tuple]) -> set[tuple]:
    """Documents one by one, through every order."""
    texts = [(r[0], r[1] or "", r[2] or "") for r in rows]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = []
    for doc, text, _ in texts:
        words = WORD.findall(text)
        fails.append({f for f, bad in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": doc is not None and any(d is not None and d < doc and t == text for d, t, _ in texts)}.items() if bad})
    out, shapley = {}, Counter()
    for part in {p for *_, p in texts}:
        for order in map("".join, permutations("ABCDE")):
            alive = [k for k, t in enumerate(texts) if t[2] == part]
            here = set(alive)
            for step, f in enumerate(order, 1):
                removed = [k for k in alive if f in fails[k]]
                redundant = sum(f in fails[k] for k in here - set(alive))
                alive = [k for k in alive if f not in fails[k]]
                out[part, order, step] = (
                    len(alive), len(removed), redundant, sum(fails[k] == {f} for k in here),
                    sum(texts[k][0] in good for k in removed), sum(texts[k][0] in toxic for k in removed))
                shapley[part, f] += len(removed)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df) -> list[tuple]:
    return [tuple(r) for r in df.select("part", "filter_order", "step", *COUNTS, "shapley").collect()]


def test_equals_going_through_every_order(spark):
    rows = edge_rows()
    # Texts of more than 200 words that fail nothing, symbols alone, capitals alone, and copies of each in two languages.
    plain = " ".join(f"w{i}" for i in range(230))
    for k, text in enumerate([plain, plain + " #", plain.upper(), plain + " #", plain, plain]):
        rows.append((40 + k, text, ["en", "fr", None][k % 3], "s", 5, *rows[0][5:]))
    labels = LABELS + [(40, 1, 0), (41, 1, 1), (43, 0, 1), (45, 1, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    judged = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text", "1 AS n")
    got, want = found(audit(docs, judged)), brute(rows, labels)
    assert len(got) == 600 * len({r[2] or "" for r in rows}) == len(want)
    assert set(got) == want


def test_no_documents_and_no_labels(spark, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert found(audit(no_docs, none)) == []
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    assert set(found(audit(one, none))) == brute([(1, None, None)], [])


def test_cells_of_other_filters_and_cells_given_in_parts(spark):
    cells = spark.createDataFrame([("x", 0, 5, 1, 0), ("x", 3, 2, 0, 1), ("x", 3, 4, 1, 0), ("x", 1, 7, 0, 0)],
                                  "part string, mask int, n long, n_good long, n_toxic long")
    got = {(r.filter_order, r.step): tuple(r[3:]) for r in interactions(cells, "PQ").collect()}
    assert got == {("PQ", 1): (5, 13, 0, 7, 1, 1, 20), ("PQ", 2): (5, 0, 6, 0, 0, 0, 6),
                   ("QP", 1): (12, 6, 0, 0, 1, 1, 6), ("QP", 2): (5, 7, 6, 7, 0, 0, 20)}
