"""Quality rules: figures of each text, and boilerplate lines by how many documents of a host have them.

A line is normalised to its words, lower-cased, with every digit as 0. A line that more than ``LEAST_DOCS`` documents
and more than ``SHARE`` of all documents of a host (``source``) have is boilerplate there. A document is rejected as
depleted when boilerplate lines hold more than half of its words, or when it fails the base rules.
``without_common_lines`` takes the boilerplate lines out of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.llm.store import stored
from skywarden.llm.words import Words, slices

# A line needs to be in more than so many documents of its host, and in more than this share of them (in percent).
LEAST_DOCS, PERCENT_OF_HOST = 20, 2
MIN_WORDS = 50
_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[list(b"#*$%&|<>")] = 1
_FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values from ``first[i]`` up to ``first[i + 1]``."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]


def _lines(words: Words, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """First and past the last byte, first and past the last word, and text of every line that has words."""
    # Lines begin with a text or behind a line feed.
    feeds = np.flatnonzero(data == 10)
    begin = np.union1d(offsets[:-1], feeds + 1)
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    end = end - (data[end - 1] == 10) if len(end) else end
    line_doc = np.searchsorted(offsets, begin, "right") - 1
    low, high = np.searchsorted(words.starts, begin), np.searchsorted(words.starts, end)
    has = high > low
    return [x[has] for x in (begin, end, low, high, line_doc)]


def _figures(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], pa.Array]:
    """The figures of each text of a slice, and its distinct normalised lines with their number and words."""
    words = Words(data, offsets, lower=False)
    plain = Words(data, offsets, lower=True, one_digit=True)
    texts, counts = len(offsets) - 1, words.counts()
    doc = np.repeat(np.arange(texts, dtype=np.uint64), counts)

    starts_char = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.ends, -1)
    chars = _per_text(starts_char & (np.cumsum(inside[:-1]) > 0), offsets)
    symbols = _per_text(_SYMBOLS[data], offsets)

    # Three-word windows that stay within their text; a repeat is one that the same text has twice.
    n = len(words.hashes)
    covered = np.zeros(n + 3, bool)
    if n > 2:
        three = words.windows(3)
        whole = np.flatnonzero(doc[2:] == doc[:-2])
        _, back, times = np.unique(three[whole] ^ (doc[whole] * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True,
                                   return_counts=True)
        again = whole[times[back] > 1]
        for shift in range(3):
            covered[again + shift] = True
    repeated = _per_text(covered[:n], words.first)

    begin, end, low, high, line_doc = _lines(words, data, offsets)
    line_first = np.searchsorted(line_doc, np.arange(texts + 1))
    _, first_of = np.unique(words.spans(begin, end) ^ (line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                            return_index=True)
    fresh = np.zeros(len(begin), bool)
    fresh[first_of] = True
    dup = _per_text(~fresh, line_first)

    hashes = plain.runs(low, high)
    order = np.lexsort((hashes, line_doc))
    hashes, line_doc, size = hashes[order], line_doc[order], (high - low)[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (line_doc[1:] != line_doc[:-1])
    at = np.flatnonzero(new)
    lines = np.diff(np.append(at, len(order)))
    held = np.add.reduceat(size, at) if len(at) else size
    bounds = pa.array(np.searchsorted(line_doc[at], np.arange(texts + 1)).astype(np.int32))
    table = pa.StructArray.from_arrays([pa.array(hashes[at].view(np.int64)), pa.array(lines.astype(np.int64)),
                                        pa.array(held.astype(np.int64))], ["hash", "lines", "words"])
    return [counts.astype(np.int64), chars, symbols, dup, repeated], pa.ListArray.from_arrays(bounds, table)


def figures(docs: DataFrame) -> DataFrame:
    """``doc_id, source`` with the base figures and ``lines`` (hash, lines, words) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text")):
                columns, lines = _figures(data, offsets)
                part = batch.slice(at, to - at)
                yield pa.record_batch([part.column("doc_id"), part.column("source"), *map(pa.array, columns), lines],
                                      names)

    names = ["doc_id", "source", *(f.split()[0] for f in _FIGURES.split(", ")), "lines"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    return rows.mapInArrow(run, f"doc_id long, source string, {_FIGURES}, "
                                "lines array<struct<hash:long,lines:long,words:long>>")


def _common(rows: DataFrame, least_docs: int, percent: int) -> DataFrame:
    """``id, hash, lines, words`` of the boilerplate lines of ``rows`` (id, host, lines)."""
    lines = rows.select("id", "host", F.explode("lines").alias("line")).select("id", "host", "line.*")
    hosts = rows.groupBy("host").agg(F.count("*").alias("documents"))
    common = lines.groupBy("host", "hash").agg(F.count("*").alias("having")).where(F.col("having") > least_docs).join(
        hosts, "host").where(100 * F.col("having") > percent * F.col("documents")).select("host", "hash")
    return lines.join(common, ["host", "hash"])


def _failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(docs: DataFrame, least_docs: int = LEAST_DOCS, percent: int = PERCENT_OF_HOST) -> DataFrame:
    """Base figures, ``base_failed``, ``n_common_lines``, ``n_left_words`` and ``kept`` for every row of ``docs``.

    Base rules fail a text with fewer than 50 words, or with more than half of its words in repeated three-word windows.
    Every row counts as a document; rows without a source form one host of their own. A null or empty text has no words
    and fails. An empty table gives an empty result.
    """
    rows = stored(figures(docs).withColumn("id", F.monotonically_increasing_id())
                  .withColumn("host", F.coalesce("source", F.lit(""))), "figures")
    gone = _common(rows, least_docs, percent).groupBy("id").agg(
        F.sum("lines").alias("n_common_lines"), F.sum("words").alias("gone_words"))
    failed = _failed()
    left = F.col("n_words") - F.coalesce("gone_words", F.lit(0))
    return rows.join(gone, "id", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        F.coalesce("n_common_lines", F.lit(0)).alias("n_common_lines"), left.alias("n_left_words"),
        (~failed & (2 * left >= F.col("n_words"))).alias("kept"))


def _cut(texts: DataFrame) -> DataFrame:
    """``id, text, n_left_words`` of ``texts`` (id, text, hashes) without the lines that have one of the hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text")):
                part = batch.slice(at, to - at)
                words = Words(data, offsets, lower=True, one_digit=True)
                begin, _, low, high, line_doc = _lines(words, data, offsets)
                hashes, feeds = words.runs(low, high).view(np.int64), np.flatnonzero(data == 10)
                number = np.searchsorted(feeds, begin) - np.searchsorted(feeds, offsets[line_doc])
                first, left = np.searchsorted(line_doc, np.arange(to - at + 1)), words.counts().astype(np.int64)
                cut = []
                for i, (text, common) in enumerate(zip(part.column("text"), part.column("hashes"), strict=True)):
                    mine = np.arange(first[i], first[i + 1])
                    out = mine[np.isin(hashes[mine], common.values.to_numpy())]
                    lines = text.as_py().split("\n")
                    keep = np.ones(len(lines), bool)
                    keep[number[out]] = False
                    left[i] -= (high[out] - low[out]).sum()
                    cut.append("\n".join(compress(lines, keep)))
                yield pa.record_batch([part.column("id"), pa.array(cut, pa.string()), pa.array(left)],
                                      ["id", "text", "n_left_words"])

    return texts.mapInArrow(run, "id long, text string, n_left_words long")


def without_common_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, percent: int = PERCENT_OF_HOST) -> DataFrame:
    """``docs`` with the boilerplate lines cut out of ``text``, ``n_left_words`` of what is left, and ``kept`` by it.

    All columns stay, those two replaced; ``n_chars`` (if there) follows a text that loses lines, and other texts stay as
    they are. Lines that stay keep their order, line feeds between them. Base rules look at the whole text, as in
    ``judged``, whose ``n_left_words`` and ``kept`` are the same. Rows that are not kept stay, for the caller to drop.
    """
    names = [c for c in docs.columns if c not in ("n_left_words", "kept")]
    texts = stored(docs.select(F.struct(*names).alias("row")).withColumn("id", F.monotonically_increasing_id()), "texts")
    rows = stored(figures(texts.select(F.col("id").alias("doc_id"), "row.source", "row.text"))
                  .withColumnRenamed("doc_id", "id").withColumn("host", F.coalesce("source", F.lit(""))), "figures")
    hashes = _common(rows, least_docs, percent).groupBy("id").agg(F.collect_list("hash").alias("hashes"))
    cut = _cut(texts.select("id", "row.text").join(hashes, "id")).select(
        "id", F.col("text").alias("cut"), F.col("n_left_words").alias("left"))
    both = texts.join(rows.select("id", "n_words", _failed().alias("failed")), "id").join(cut, "id", "left")
    left = F.coalesce("left", "n_words")
    columns = {c: F.col("row")[c] for c in names}
    columns["text"] = F.coalesce("cut", columns["text"])
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("cut").isNull(), columns["n_chars"]).otherwise(
            F.char_length("cut").cast(docs.schema["n_chars"].dataType))
    return both.select(*(c.alias(name) for name, c in columns.items()), left.alias("n_left_words"),
                       (~F.col("failed") & (2 * left >= F.col("n_words"))).alias("kept"))
