"""Language identification: known words first, shorter and shorter character n-grams for the rest.

A word is a run of letters (with their combining marks), lower-cased. The model holds, per language, the smoothed log
frequency of every word that a language has at least ``MIN_COUNT`` times in the training sample, and of the n-grams of 1
to 5 characters of all its words (with marks at the word's ends; those of 3 and more if a language has them twice). A known word counts with its log frequencies; an unknown
one with the mean of its known 5-grams, else 4-grams, and so on down to single letters.

The model is fitted on a bounded sample of labelled rows: about ``SAMPLE`` of each language, drawn by a hash of the
doc_id, or fewer where more than ``SAMPLE_OF_ALL`` would come together. Every language is learned. Everything is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.llm.store import stored
from skywarden.llm.workers import tidy
from skywarden.operators.joins import is_small

# Labelled rows to learn from: of each language, and of all together where there are very many languages.
SAMPLE, SAMPLE_OF_ALL = 600, 60_000
MIN_COUNT = 3
LONGEST = 5
# Words that count as independent evidence when log frequencies become a confidence.
EVIDENCE = 25
UNKNOWN = "und"
# What a scoring task remembers of runs of characters it has met, and how many it takes up at a time.
_MEMORY, _CHUNK = 150_000, 30_000

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams_of(word: str, n: int) -> list[str]:
    marked = f"\x02{word}\x03" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    tables: list[dict[str, int]]  # words, then n-grams of LONGEST, LONGEST - 1, ... 1 characters
    logs: list[np.ndarray]

    def vectors(self, words: list[str]) -> np.ndarray:
        """Log frequencies of each word by language, and in the last column whether the model knows anything of it."""
        out = np.zeros((len(words), len(self.languages) + 1), np.float32)
        open_, sizes = list(range(len(words))), (0, *range(LONGEST, 0, -1))
        for size, table, logs in zip(sizes, self.tables, self.logs, strict=True):
            known, counts, done, rest = [], [], [], []
            for i in open_:
                grams = grams_of(words[i], size) if size else (words[i],)
                found = [at for g in grams if (at := table.get(g)) is not None]
                if found:
                    known += found
                    counts.append(len(found))
                    done.append(i)
                else:
                    rest.append(i)
            if done:
                first = np.concatenate([[0], np.cumsum(counts)[:-1]])
                out[done, :-1] = np.add.reduceat(logs[known], first) / np.array(counts, np.float32)[:, None]
                out[done, -1] = 1
            open_ = rest
        return out


class Scorer:
    """Sums of log frequencies over texts; remembers what a run of characters between white space adds to them."""

    def __init__(self, model: Model):
        self.model, self.width = model, len(model.languages)
        self._forget(_MEMORY)

    def _forget(self, room: int) -> None:
        self.memory: dict[str, int] = {}
        # Sums by language, known words, words.
        self.table = np.zeros((room, self.width + 2), np.float32)

    def _learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.memory]
        if len(self.memory) + len(new) > len(self.table):
            new = list(tokens)
            self._forget(max(_MEMORY, len(new)))
        if not new:
            return
        words = [_WORD.findall(t) for t in new]
        rows = self.model.vectors([w for ws in words for w in ws])
        counts = np.array([len(ws) for ws in words])
        base = len(self.memory)
        sums = np.zeros((len(new), self.width + 2), np.float32)
        np.add.at(sums[:, :-1], np.repeat(np.arange(len(new)), counts), rows)
        sums[:, -1] = counts
        self.table[base:base + len(new)] = sums
        self.memory.update(zip(new, range(base, base + len(new)), strict=True))

    def sums(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros((len(texts), self.width + 2))
        at = 0
        while at < len(texts):
            group, size = [], 0
            while at < len(texts) and size < _CHUNK:
                group.append((texts[at].as_py() or "").lower().split())
                size += len(group[-1])
                at += 1
            self._learn({t for tokens in group for t in tokens})
            get = self.memory.__getitem__
            for i, tokens in enumerate(group, at - len(group)):
                if tokens:
                    out[i] = self.table[list(map(get, tokens))].sum(axis=0, dtype=np.float64)
        return out


def is_held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def training_rows(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``lang, text`` of about ``sample`` labelled training rows of each language, SAMPLE_OF_ALL of all together."""
    rows = docs.where(F.col("lang").isNotNull() & ~is_held_out()).select("doc_id", "lang", "text")
    sizes = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    each = F.least(F.lit(float(sample)), F.lit(float(SAMPLE_OF_ALL)) / sizes.agg(F.count("*")).scalar())
    # Rows without a doc_id are drawn by their text.
    at = F.xxhash64("doc_id", F.lit(9), F.when(F.col("doc_id").isNull(), F.col("text")))
    place = F.pmod(at, F.lit(1 << 30)) / F.lit(float(1 << 30))
    sizes = sizes.withColumn("each", each)
    # One language may hold most rows: the list of languages goes to them, if its count allows.
    return rows.join(F.broadcast(sizes) if is_small(sizes) else sizes, "lang").where(place * F.col("n") < F.col("each")).select("lang", "text")


def fit(rows: DataFrame) -> Model:
    """Model of ``rows`` (lang, text). Counting is distributed; the counts of the bounded sample come to the driver."""
    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen.update((lang, w) for w in words_of(text))
            yield pa.record_batch([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                                   pa.array(seen.values(), pa.int64())], ["lang", "gram", "n"])

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "gram", "n")), strict=True):
                for size in range(1, LONGEST + 1):
                    for gram in grams_of(word, size):
                        seen[lang, size, gram] += n
            yield pa.record_batch([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int32()),
                                   pa.array([k[2] for k in seen], pa.string()), pa.array(seen.values(), pa.int64())],
                                  ["lang", "size", "gram", "n"])

    words = rows.mapInArrow(count_words, "lang string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    grams = words.mapInArrow(count_grams, "lang string, size int, gram string, n long").groupBy(
        "lang", "size", "gram").agg(F.sum("n").alias("n"))
    # In an order of its own, so that equal input gives an equal model.
    counts = (words.withColumn("size", F.lit(0)).where(F.col("n") >= MIN_COUNT)
              .unionByName(grams.where((F.col("n") >= 2) | (F.col("size") < 3)))
              .toPandas().sort_values(["size", "gram", "lang"]))
    languages = sorted(counts["lang"].unique())
    tables, logs = [], []
    for size in (0, *range(LONGEST, 0, -1)):
        mine = counts[counts["size"] == size]
        grams_here, row = np.unique(mine["gram"].to_numpy(str), return_inverse=True)
        n = np.zeros((len(grams_here), len(languages)))
        n[row, np.searchsorted(languages, mine["lang"].to_numpy(str))] = mine["n"].to_numpy()
        smooth = 0.5
        logs.append(np.log((n + smooth) / (n.sum(axis=0) + smooth * max(1, len(n)))).astype(np.float32))
        tables.append({gram: i for i, gram in enumerate(grams_here.tolist())})
    return Model(languages, tables, logs)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Columns of ``docs`` and ``lang_pred``, ``score``. Takes the text alone.

    ``score`` is the share of the best language after the mean log frequencies per word are weighted as up to EVIDENCE
    words; equal languages resolve to the first in order. Null texts, texts without a letter, and all texts when there
    is nothing to learn from get ``und`` and 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # Only the text goes to Python, and only the verdict comes back.
    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def verdict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from tidy(run)(columns)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        languages = np.array([*scorer.model.languages, UNKNOWN])
        for texts in columns:
            sums = scorer.sums(texts)
            known, width = sums[:, -2:-1], scorer.width
            mean = sums[:, :width] / np.maximum(known, 1) * np.minimum(known, EVIDENCE)
            lettered = (sums[:, -1] > 0) & (width > 0)
            best, scores = np.full(len(mean), width), np.zeros(len(mean))
            if width:
                share = np.exp(mean - mean.max(axis=1, keepdims=True))
                best[lettered] = share.argmax(axis=1)[lettered]
                scores[lettered] = (share.max(axis=1) / share.sum(axis=1))[lettered]
            yield pa.StructArray.from_arrays([pa.array(languages[best], pa.string()), pa.array(scores, pa.float64())],
                                             ["lang_pred", "score"])

    own = {c: f"_own_{c}" for c in docs.columns if c.startswith("_verdict")}
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*[F.col(c).alias(own.get(c, c)) for c in kept], verdict("text").alias("_verdict"))
    return rows.select(*[F.col(own.get(c, c)).alias(c) for c in kept], "_verdict.lang_pred", "_verdict.score")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (doc_id, text, lang and any other columns).

    Learns from rows with a language whose ``crc32(doc_id) % 4`` is not 2, and predicts from the text alone. A null
    doc_id counts as an empty string there. Repeated rows give repeated results; an empty table an empty one.
    """
    model = fit(training_rows(docs))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", is_held_out().alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame, least: float = 0.35) -> DataFrame:
    """``docs`` without the rows whose text is in no language (``und``) or in none with a score of at least ``least``."""
    own = {c: f"_own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = predict(docs.withColumnsRenamed(own), fit(training_rows(docs)))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(
        *(F.col(own.get(c, c)).alias(c) for c in docs.columns))
