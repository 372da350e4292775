from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from skywarden.llm import packing
from skywarden.llm.packing import pack, sum_of_squares, vocabulary
from skywarden.llm.words import slices
from tests.llm.rows import words
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(rows, result, tokenizer, length=1024):
    """Every piece is where it should be cut, has its ids, and sequences are gapless and not too long."""
    want = defaultdict(int)
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % length + 1
        cuts = [0, *range(first, len(ids) + 1, length)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    have = defaultdict(int)
    placed = defaultdict(list)
    for r in result:
        have[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        placed[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for parts in placed.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(placed), sum(r.length for r in result)


def test_edge_rows(edge_docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    check(rows, pack(edge_docs).collect(), tokenizer)


def test_few_sequences_over_several_groups(spark, tokenizer):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randint(1, 400))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    one, total = check(rows, pack(docs).collect(), tokenizer)
    many, _ = check(rows, pack(docs, group=100).collect(), tokenizer)
    assert one <= 1.02 * -(-total // 1024) and many <= 1.1 * -(-total // 1024)


def test_sum_of_squares_follows_its_rule():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 21, 300)
    place, offset, fill = sum_of_squares(sizes, 20)
    state: list[int] = []
    for size, at, off in zip(sizes, place, offset):
        def squares(levels):
            counts = np.bincount([20 - x for x in levels if x < 20], minlength=21)
            return int((counts ** 2).sum())

        options = {i: squares([*state[:i], x + size, *state[i + 1:]]) for i, x in enumerate(state) if x + size <= 20}
        options = options or {len(state): 0}
        if at == len(state):
            state.append(0)
        assert off == state[at] and options[at] == min(options.values())
        state[at] += size
    assert state == fill.tolist()


def test_tokens_of_odd_white_space(tokenizer):
    texts = ["", " ", "  a", "a  b", "a \n b\n", "\n\na", " a", "a ", "it's  we'll\t\tok", "<|endoftext|> x", "1 234  5\r\n6",
             "\n", "a\nb", "a \nb", "a 's 't", "\x0b\x0ca", " \n", "no\xa0break here", "　wide   em", "\x1c sep \x85"]
    docs_ids = []
    vocab = vocabulary()
    for first, to, data, offsets in slices(pa.array(texts)):
        ids, begins = vocab.encode(data, offsets)
        docs_ids += [ids[begins[i]:begins[i + 1]].tolist() for i in range(to - first)]
    for text, ids in zip(texts, docs_ids):
        if not packing._OTHER_SPACE.search(text):
            assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_odd_white_space_as_rows(spark, tokenizer):
    rows = [(1, "no\xa0break here"), (2, "　wide   em"), (3, "\x1c sep \x85"), (4, " \xa0 x")]
    check(rows, pack(spark.createDataFrame(rows, "doc_id long, text string")).collect(), tokenizer)


def test_empty_table(no_docs):
    assert pack(no_docs).count() == 0
