"""Repeated passages: every window of words that also starts somewhere else, found by level-wise doubling.

Windows are judged on short pieces first. Level one looks at quarter-length pieces, and only at one piece of each
window, the one with the smallest hash, so that equal windows look at equal pieces. Pieces that occur once are out.
What is left is extended to twice the length, to the right and to the left, and judged again; a window is still in if
the extension that lies within it is repeated. Last come the whole windows of what is still left. Levels of a
35-word window: 9, 18, 35 words.

Texts with the same bytes are one text with a number of copies (a 64-bit hash names it), so a large group of exact
copies costs one text. Only texts that may hold such a piece are moved, as told by a bitmap of 8 MB over their hashes; the
others stay where they are. Occurrence counts combine on the map side and are stored; positions meet them in a semi-join
that adaptive execution can split. Hashes have 64 bits: two different windows are taken for equal with a chance of about 5e-20 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywarden.llm.store import free_name, hash_filter, possible, stored
from skywarden.llm.words import Words, word_slices
from skywarden.llm.workers import tidy

WINDOW = 35
_SPACE = "[\\x20\\x09-\\x0D]+"
_PLACE_BITS = 24


def _node() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _levels(window: int) -> tuple[int, int]:
    """Lengths of the pieces of level one and two."""
    return -(-(-(-window // 2)) // 2), -(-window // 2)


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Every window start that stays within its text, and the word number of its smallest level-one piece."""
    piece, _ = _levels(window)
    counts = words.counts()
    room = np.maximum(counts - window + 1, 0)
    starts = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(room)[:-1]]), room) + np.arange(room.sum())
    if not len(starts):
        return starts, starts
    hashes = words.windows(piece)
    # A single long text may have more words than the usual bits can number.
    place = np.uint64((1 << max(_PLACE_BITS, len(hashes).bit_length())) - 1)
    least = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    width, have = window - piece + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return starts, (least[starts] & place).astype(np.int64)


def _pieces(docs: DataFrame, window: int) -> DataFrame:
    """``node, at, piece, right, left`` per anchor: its hash and those of its two extensions (null past the text's ends)."""
    piece, double = _levels(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, words in word_slices(batch.column("text")):
                starts, anchor = _anchors(words, window)
                if not len(starts):
                    continue
                new = np.ones(len(anchor), bool)
                new[1:] = anchor[1:] != anchor[:-1]
                spot = anchor[new]
                doc = np.searchsorted(words.first, spot, "right") - 1
                right = spot + double <= words.first[doc + 1]
                begin = spot - (double - piece)
                left = begin >= words.first[doc]
                ends = [pa.array(words.windows(double, np.where(ok, x, 0)).view(np.int64), mask=~ok)
                        for ok, x in ((right, spot), (left, begin))]
                node = batch.column("node").slice(at, to - at).to_numpy()
                yield pa.record_batch([pa.array(node[doc]), pa.array((spot - words.first[doc]).astype(np.int32)),
                                       pa.array(words.windows(piece, spot).view(np.int64)), *ends],
                                      ["node", "at", "piece", "right", "left"])

    return docs.select(_node().alias("node"), "text").mapInArrow(
        tidy(run), "node long, at int, piece long, right long, left long")


def _repeated(rows: DataFrame, key: list[str], weight: str | None = None) -> DataFrame:
    """Keys that occur more than once. They are stored: a join right behind the counting could not be split where a key
    is hot."""
    times = F.sum(weight) if weight else F.count("*")
    return stored(rows.groupBy(*key).agg(times.alias("_times")).where("_times > 1").select(*key), "repeated")


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """Hash and start of every window of ``texts`` (node, text, copies, spots, kinds) that both levels have left in."""
    piece, double = _levels(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, words in word_slices(batch.column("text")):
                starts, anchor = _anchors(words, window)
                flags = np.zeros(len(words.hashes) + 1, np.int8)
                part = batch.slice(at, to - at)
                spots, kinds = part.column("spots"), part.column("kinds")
                sizes = np.diff(spots.offsets.to_numpy())
                flags[np.repeat(words.first[:-1], sizes) + spots.flatten().to_numpy()] = kinds.flatten().to_numpy()
                kind, ahead = flags[anchor], anchor - starts
                keep = ((kind & 1) > 0) & (ahead <= window - double) | ((kind & 2) > 0) & (ahead >= double - piece)
                left = starts[keep]
                offsets = np.searchsorted(left, words.first).astype(np.int32)
                doc = np.searchsorted(words.first, left, "right") - 1
                yield pa.record_batch(
                    [part.column("node"), part.column("text"), part.column("copies"),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(words.windows(window, left).view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array((left - words.first[doc]).astype(np.int32)))],
                    ["node", "text", "copies", "windows", "starts"])

    return texts.mapInArrow(tidy(run), "node long, text string, copies long, windows array<long>, starts array<int>")


def changed_texts(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``node, n_removed, kept_text`` of the texts that lose words, and a filter (``store.possible``) that tells most other
    texts from them; ``node`` is ``xxhash64(coalesce(text, ''))``."""
    if window < 4:
        raise ValueError("a window needs at least 4 words")
    pieces = _pieces(docs, window)
    one = stored(pieces.join(_repeated(pieces, ["piece"]), "piece", "left_semi").select("node", "at", "right", "left"),
                 "repeated-pieces")
    sides = one.select("node", "at", F.explode(F.array(
        F.struct(F.lit(1).alias("kind"), F.col("right").alias("double")),
        F.struct(F.lit(2).alias("kind"), F.col("left").alias("double")))).alias("s")).select("node", "at", "s.*").where(
        "double IS NOT NULL")
    two = sides.join(_repeated(sides, ["kind", "double"]), ["kind", "double"], "left_semi").distinct()
    spots = stored(two.groupBy("node", "at").agg(F.sum("kind").cast("tinyint").alias("kind"))
                   .groupBy("node").agg(F.collect_list("at").alias("spots"), F.collect_list("kind").alias("kinds")), "spots")
    known = hash_filter(spots.select("node"))
    texts = possible(docs.select(_node().alias("node"), "text"), "node", known, "met").where("met").groupBy("node").agg(
        F.first("text").alias("text"), F.count("*").alias("copies"))
    left = stored(_windows(texts.join(spots, "node"), window), "windows")

    weighted = left.select(F.explode("windows").alias("hash"), F.least("copies", F.lit(2)).alias("copies"))
    places = left.where("copies = 1").select("node", F.explode(F.arrays_zip("windows", "starts")).alias("w")).select(
        F.col("w.windows").alias("hash"), "node", F.col("w.starts").alias("start"))
    hits = places.join(_repeated(weighted, ["hash"], "copies"), "hash", "left_semi")
    starts = hits.groupBy("node").agg(F.collect_list("start").alias("hits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, hit in zip(batch.column("text"), batch.column("hits"), strict=True):
                words = text.as_buffer().to_pybytes().split()
                edge = np.zeros(len(words) + 1, np.int64)
                first = hit.values.to_numpy()
                np.add.at(edge, first, 1)
                np.add.at(edge, first + window, -1)
                keep = np.cumsum(edge[:-1]) == 0
                removed.append(len(words) - int(keep.sum()))
                kept.append(b" ".join(compress(words, keep)).decode())
            yield pa.record_batch([batch.column("node"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                  ["node", "n_removed", "kept_text"])

    single = (left.where("copies = 1").select("node", "text").join(starts, "node")
              .mapInArrow(tidy(run), "node long, n_removed long, kept_text string"))
    # Every window of a text that has copies starts elsewhere, too.
    n = _n_words(_plain("text"))
    whole = left.where("copies > 1").select("node", n.alias("n_removed"), F.lit("").alias("kept_text"))
    return single.unionByName(whole), known


def _plain(text: str) -> F.Column:
    """The words of a text, joined by one space."""
    return F.btrim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _SPACE, " "), F.lit(" "))


def _n_words(plain: F.Column) -> F.Column:
    return F.when(plain == "", 0).otherwise(
        F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" "), F.lit(""))) + 1).cast("long")


def removed_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs`` (doc_id, text and any other columns).

    Words are runs of bytes other than space and the control characters 9 to 13, compared as they are. A word goes if a
    window of ``window`` words around it starts anywhere else as well, in this text or another; overlapping occurrences
    count. Null and empty texts, and texts shorter than a window, lose nothing. Repeated rows count as copies of each
    other, rows without doc_id like any other. An empty table gives an empty result.
    """
    changed = changed_texts(docs, window)[0].select("node", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
    mine = docs.select("doc_id", _node().alias("node"), _plain("text").alias("plain")).select(
        "doc_id", "node", _n_words(F.col("plain")).alias("n_words"), F.sha2("plain", 256).alias("all_sha256"))
    return mine.join(changed, "node", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without its repeated passages, all columns kept: texts that lose words become what is left of them,
    joined by single spaces, ``n_chars`` (if there) follows the text, and texts of which nothing is left go."""
    node, kept, met = (free_name(docs, name) for name in ("_node", "_kept", "_met"))
    changed, known = changed_texts(docs, window)
    marked = possible(docs.withColumn(node, _node()), node, known, met)
    joined = marked.where(met).join(changed.select(F.col("node").alias(node), F.col("kept_text").alias(kept)), node, "left")
    rows = joined.where(F.col(kept).isNull() | (F.col(kept) != "")).unionByName(
        marked.where(~F.col(met)).withColumn(kept, F.lit(None).cast("string")))
    changes = {"text": F.coalesce(kept, "text")}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(
            F.char_length(kept).cast(docs.schema["n_chars"].dataType))
    return rows.withColumns(changes).select(*docs.columns)
