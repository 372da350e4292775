from __future__ import annotations

from collections import Counter

from skywarden.llm.quality import judged, without_common_lines
from tests.llm.rows import WORD, lowered


def brute(rows, least, percent):
    hosts = Counter(s or "" for _, s, _ in rows)

    def lines(text):
        return [x for x in (text or "").split("\n") if WORD.search(x)]

    def norm(line):
        return "".join("0" if c in "0123456789" else c for c in " ".join(WORD.findall(lowered(line))))

    having = Counter((s or "", n) for _, s, t in rows for n in {norm(x) for x in lines(t)})
    out = []
    for doc, source, text in rows:
        w = WORD.findall(text or "")
        threes = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        again = {i + k for i in range(len(w) - 2) if threes[tuple(w[i:i + 3])] > 1 for k in range(3)}
        mine = lines(text)
        host = source or ""
        gone = [x for x in mine if having[host, norm(x)] > least and 100 * having[host, norm(x)] > percent * hosts[host]]
        left = len(w) - sum(len(WORD.findall(x)) for x in gone)
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        out.append((doc, len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
                    len(mine) - len(set(mine)), len(again), failed, len(gone), left, not failed and 2 * left >= len(w)))
    return sorted(out, key=repr)


def brute_cut(rows, least, percent):
    """Doc, text without its common lines, words left and kept."""
    def norm(line):
        return "".join("0" if c in "0123456789" else c for c in " ".join(WORD.findall(lowered(line))))

    hosts = Counter(s or "" for _, s, _ in rows)
    having = Counter((s or "", n) for _, s, t in rows for n in {norm(x) for x in (t or "").split("\n")} if n)
    kept = Counter((r[0], r[1], r[8], r[9]) for r in brute(rows, least, percent))
    out = []
    for doc, source, text in rows:
        times = {x: having[source or "", norm(x)] for x in (text or "").split("\n")}
        stay = [x for x in (text or "").split("\n")
                if not (times[x] > least and 100 * times[x] > percent * hosts[source or ""])]
        left, n = len(WORD.findall("\n".join(stay))), len(WORD.findall(text or ""))
        good = (doc, n, left, True) in kept
        assert (doc, n, left, good) in kept
        out.append((doc, text if text is None else "\n".join(stay), left, good))
    return sorted(out, key=repr)


def cut_rows(docs, least, percent):
    return sorted(((r.doc_id, r.text, r.n_left_words, r.kept) for r in without_common_lines(docs, least, percent).collect()),
                  key=repr)


def test_common_lines_are_cut(spark, edge_docs, no_docs):
    body = " ".join(f"w{i}" for i in range(70))
    foot = "\nterms  of USE 2021\n\nlast é line"
    texts = [(i, "h" if i < 30 else "g", f"Menu {i}\n{body} {i * 'x'}y" + (foot if i % 2 else "\nmenu 7\n")) for i in range(60)]
    docs = spark.createDataFrame([(*r, len(r[2])) for r in texts], "doc_id long, source string, text string, n_chars int")
    for least, percent in ((5, 10), (20, 60), (20, 10)):
        assert cut_rows(docs, least, percent) == brute_cut(texts, least, percent)
    out = without_common_lines(docs, 5, 10)
    assert all(len(r.text) == r.n_chars and "Menu" not in r.text and "line" not in r.text for r in out.collect())
    assert out.columns == [*docs.columns, "n_left_words", "kept"]
    rows = [(r.doc_id, r.source, r.text) for r in edge_docs.collect()]
    assert cut_rows(edge_docs, 1, 2) == brute_cut(rows, 1, 2)
    assert without_common_lines(no_docs).count() == 0


def test_edge_rows(edge_docs):
    rows = [(r.doc_id, r.source, r.text) for r in edge_docs.collect()]
    assert sorted((tuple(r) for r in judged(edge_docs, 1, 2).collect()), key=repr) == brute(rows, 1, 2)


def test_common_lines(spark):
    body = " ".join(f"w{i}" for i in range(70))
    menu = "Home | About 2021\n" + " ".join(f"m{i}" for i in range(100)) + "\n"
    rows = [(i, "h" if i < 30 else "g", (menu.replace("2021", str(2000 + i)) if i % 2 else "") + f"{body} {i * 'x'}y\nx {i}")
            for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for least, percent in ((5, 10), (5, 60), (20, 10)):
        assert sorted((tuple(r) for r in judged(docs, least, percent).collect()), key=repr) == brute(rows, least, percent)


def test_empty_table(no_docs):
    assert judged(no_docs).count() == 0
