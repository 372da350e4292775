from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import xxhash
from skywarden.llm.fingerprint import SAMPLES, fingerprints
from tests.llm.rows import WORD, words

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(*values):
    """xxhash64 of the session: longs, ints and texts chained by the seed."""
    seed = 42
    for v in values:
        if isinstance(v, str):
            data = v.encode()
        else:
            kind, number = v
            data = (number & ((1 << (8 * kind)) - 1)).to_bytes(kind, "little")
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def fingerprint(text, samples=SAMPLES):
    bag = Counter(WORD.findall(text))
    if not bag:
        return None
    out = []
    for k in range(samples):
        best = None
        for word, n in bag.items():
            w = (8, spark_hash(word))
            bits = [spark_hash(w, (4, 3 * k + i)) for i in range(3)]

            def uniform(x):
                return (x + 0.5) / 2 ** 32

            r, c = (-math.log(uniform(b >> 32) * uniform(b & 0xFFFFFFFF)) for b in bits[:2])
            b = uniform(bits[2] & 0xFFFFFFFF)
            t = math.floor(math.log(n) / r + b)
            rank = math.floor((math.log(c) - r * (t - b) - r + 128) * 2 ** 23)
            name = spark_hash(w, (4, (-1 - k) & 0xFFFFFFFF), (8, t & MASK)) & 0xFFFFFFFF
            if best is None or (rank, name) < best:
                best = rank, name
        out.append(best[1])
    return out


def as_text(samples):
    return "0" * 8 * SAMPLES if samples is None else "".join(f"{x:08x}" for x in samples)


def near(a, b):
    if a is None or b is None:
        return 1.0 if a is b else 0.0
    return sum(x == y for x, y in zip(a, b)) / len(a)


def test_against_a_plain_version(spark):
    rng = random.Random(2)
    texts = {1: words(rng, 50), 5: "a a a b", 9: "", 12: "é ü 😀 " * 5, 30: words(rng, 9), 31: None, 40: "x"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    order = sorted(texts, reverse=True)
    for r in fingerprints(docs).collect():
        mine = texts[r.doc_id] or ""
        after = texts[order[(order.index(r.doc_id) + 1) % len(order)]] or ""
        third = len(mine) // 3
        edited = mine[:len(mine) - third] + after[:third]
        own, changed, following = fingerprint(mine), fingerprint(edited), fingerprint(after)
        assert (r.n_chars, r.edited_sha256) == (len(mine), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == as_text(own) and r.edited_fingerprint == as_text(changed)
        assert r.near_edited == near(own, changed) and r.near_next == near(own, following)


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        base = words(rng, 40).split()
        rows += [(2 * i, " ".join(base * 2)), (2 * i + 1, " ".join(base + base[:rng.randint(0, 40)] + words(rng, 10).split()))]
    texts = dict(rows)
    diff = []
    for r in fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if r.doc_id % 2:
            a, b = Counter(texts[r.doc_id].split()), Counter(texts[r.doc_id - 1].split())
            diff.append(r.near_next - sum((a & b).values()) / sum((a | b).values()))
    assert abs(sum(diff) / len(diff)) < 0.04


def test_edge_rows(edge_docs, no_docs):
    rows = edge_docs.collect()
    found = fingerprints(edge_docs).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in rows)
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and re.fullmatch("[0-9a-f]{256}", r.fingerprint)
    same = {r.fingerprint for r in found if r.doc_id in (6, 7)}
    assert len(same) == 1
    assert fingerprints(no_docs).count() == 0


def test_a_lone_document_follows_itself(spark):
    r = fingerprints(spark.createDataFrame([(3, "one two three")], "doc_id long, text string")).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"one two tone t"[:9] + b"one ").hexdigest()
