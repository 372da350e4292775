"""Rows that every operator has to take: nulls in any column, empty, blank, very long, repeated and tied texts, and
columns whose names the operators use themselves."""

from __future__ import annotations

import random
import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, node long, label string, key int, "
          "kept boolean, score double, id string")


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edge_rows() -> list[tuple]:
    rng = random.Random(5)
    base = words(rng, 120)
    texts = [None, "", "   \n\t ", "one", "two words", "A b C d E", base, base, base.upper(), base + " and more",
             words(rng, 20_000), "x" * 50_000, "a " * 3000, "tab\tand\x0bfeeds\x0c\r\n new  line ", "é ü 你好 😀 " * 30,
             "123 456 !!! ...", words(rng, 40) + " " + base, "the same line\n" * 60]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, len(t) if t else None) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, base, None, None, None), (None, None, None, None, None), (None, "", "en", "s", 0),
             (3, words(rng, 60), "fr", "s", 5)]
    return [(*r, 7, "x", 1, False, 0.5, "z") for r in rows]


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
