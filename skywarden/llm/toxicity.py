"""Toxicity by a subsequence string kernel and a linear support vector machine on Nyström landmarks.

The kernel of two words sums over all triples of letters that both contain in order, each occurrence weighted by
``DECAY`` to the letters it skips (up to ``SPAN`` letters wide), and is normalised to 1 for equal words; so a word with
letters inserted, left out or put apart stays close to the original. Landmarks are words of the training sample that
set toxic documents apart, and words that do not; ``K(w, L) K(L, L)^-1/2`` are a word's features.

Labels belong to whole texts, so training is by multiple instances. Witnesses are words that toxic texts have far more
often than clean ones. Some make a text toxic by themselves: words like them are as rare in clean texts. Others come with
stems that clean texts have as well, and tell only together. One machine learns the words that stand alone, in turns,
another all witnesses. Being linear in the landmarks, each folds into a table of triples, by which every word of every
text is scored. A logistic curve over texts weighs the worst word of the first kind, the number and share of distinct
words of the second, and the second and third worst of them. Runs of single letters form one word, and characters other
than letters are dropped within a word.

Fitted on a bounded sample: about ``SAMPLE`` toxic and ``CLEAN_SAMPLE`` clean labelled texts at most, drawn by a hash of
the doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE, CLEAN_SAMPLE = 1000, 2500
LANDMARKS = 256
DECAY, SPAN = 0.75, 6
# Words are scored in pieces of at most so many letters that overlap by half.
LONGEST = 24
ROUNDS = 4
# Toxic texts, copies apart, that a word needs to be taken for a witness.
MIN_SUPPORT = 2.0
# Logarithm of how much more often it has to be in toxic texts than in clean ones.
MIN_ODDS = 3.0
# Words with at least this kernel are alike.
ALIKE = 0.5
# Words of clean texts that the machine sees at most, about.
NEGATIVES = 8_000
_MEMORY, _CHUNK = 500_000, 100_000

_OTHER = regex.compile(r"[^\p{L}]+")
_SYMBOLS = 32
_TRIPLES = [(i, j) for i in range(1, SPAN - 1) for j in range(i + 1, SPAN)]
# By the number of the pattern, from 1; 0 is no triple.
_WEIGHTS = np.array([0.0, *(DECAY ** (j - 2) for _, j in _TRIPLES)], np.float32)


def _symbol_table() -> np.ndarray:
    """Letters as numbers from 1; a-z are exact, letters with marks count as their base, others share the last five."""
    import unicodedata

    table = np.zeros(0x3000, np.int64)
    for code in range(len(table)):
        base = unicodedata.normalize("NFKD", chr(code).lower())[:1]
        table[code] = ord(base) - 96 if "a" <= base <= "z" else 27 + code % 5
    return table


_SYMBOL = _symbol_table()


def plain(token: str) -> str:
    """The letters of a run of characters between white space, lower-cased."""
    return _OTHER.sub("", token)


def _codes(words: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(words), width), np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) for w in words])
    row = np.repeat(np.arange(len(words)), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, column] = np.where(flat < len(_SYMBOL), _SYMBOL[np.minimum(flat, len(_SYMBOL) - 1)], 27 + flat % 5)
    return out


def _triples(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Triple numbers and weights of each word (0 where there is none), weights scaled to a norm of 1."""
    width = max([3, *map(len, words)])
    codes = np.pad(_codes(words, width), ((0, 0), (0, SPAN))).astype(np.int32)
    keys = np.empty((len(words), len(_TRIPLES) * width), np.int32)
    for n, (i, j) in enumerate(_TRIPLES):
        c = codes[:, j:j + width]
        keys[:, n * width:(n + 1) * width] = np.where(
            c > 0, ((codes[:, :width] * _SYMBOLS + codes[:, i:i + width]) * _SYMBOLS + c << 4) | n + 1, 0)
    keys.sort(axis=1)
    ids, weights = keys >> 4, _WEIGHTS[keys & 15]
    # Equal triples of a word add up before they are squared.
    new = np.ones(ids.shape, bool)
    new[:, 1:] = ids[:, 1:] != ids[:, :-1]
    first = np.flatnonzero(new)
    sums = np.add.reduceat(weights.ravel(), first) if len(first) else np.zeros(0)
    total = np.bincount(first // ids.shape[1], sums ** 2, minlength=len(words)) if len(first) else np.zeros(len(words))
    return ids, weights / np.sqrt(np.maximum(total, 1e-12))[:, None].astype(np.float32)


def _by_length(words: list[str]) -> Iterator[list[int]]:
    """Places of the words in groups of similar length and bounded number."""
    sizes = np.array([len(w) for w in words])
    for low, high in ((0, 6), (6, 9), (9, 12), (12, 17), (17, LONGEST)):
        places = np.flatnonzero((sizes > low) & (sizes <= high))
        for at in range(0, len(places), 4096):
            yield places[at:at + 4096].tolist()


def kernel(one: list[str], two: list[str]) -> np.ndarray:
    """Normalised kernel of every word of ``one`` with every word of ``two`` (at most LONGEST letters each)."""
    ids, weights = _triples(two)
    basis = np.zeros((_SYMBOLS ** 3, len(two)), np.float32)
    np.add.at(basis, (ids.ravel(), np.repeat(np.arange(len(two)), ids.shape[1])), weights.ravel())
    basis[0] = 0
    out = np.zeros((len(one), len(two)), np.float32)
    for places in _by_length(one):
        for at in range(0, len(places), 64):
            part = places[at:at + 64]
            ids, weights = _triples([one[i] for i in part])
            out[part] = np.einsum("nf,nfm->nm", weights.astype(np.float32), basis[ids], optimize=False)
    return out


@dataclass
class Model:
    table: np.ndarray  # weight of each triple, for words that stand alone and for all witnesses
    bias: np.ndarray
    weights: np.ndarray  # of the figures of a text, the constant last

    def words(self, words: list[str]) -> np.ndarray:
        """Both decision values of words (of letters only); a word without a triple gets the biases."""
        out = np.tile(self.bias, (len(words), 1))
        long = [i for i, w in enumerate(words) if len(w) > LONGEST]
        for i in long:
            w = words[i]
            step = LONGEST // 2
            out[i] = self.words([w[a:a + LONGEST] for a in range(0, len(w) - step, step)]).max(axis=0)
        for places in _by_length(words):
            if places:
                ids, weights = _triples([words[i] for i in places])
                out[places] = np.einsum("nfm,nf->nm", self.table[ids], weights) + self.bias
        return out

    def text(self, values: np.ndarray) -> np.ndarray:
        """Figures of a text from the decision values of its distinct words."""
        if not len(values):
            values = self.bias[None]
        worst = np.clip(values[:, 0].max(), -2, 2)
        # How far beyond the margin of the second machine each word is, at most 1.
        beyond = np.clip(values[:, 1], 0, 1)
        top = np.sort(np.append(beyond, [0, 0, 0]))
        return np.array([max(min(max(worst, 0), 1), top[-3]), worst, top[-2], np.log1p(beyond.sum()),
                         10 * beyond.mean(), 1.0])

    def score(self, figures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(figures @ self.weights, -30, 30)))


def is_held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def _words_of(text: str | None) -> list[str]:
    tokens = (text or "").lower().split()
    words = [plain(t) for t in tokens]
    joined, run = [], []
    for w in [*words, ""]:
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) > 2:
            joined.append("".join(run))
        run = []
    return [w for w in words if len(w) > 1] + joined


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, clean: int = CLEAN_SAMPLE) -> DataFrame:
    """``toxic, place, weight, words`` (distinct) of about ``sample`` toxic and ``clean`` other labelled training texts.

    A text labelled both ways counts as toxic. ``weight`` is how many texts a sampled one stands for.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(~is_held_out())
    sizes = marked.groupBy("toxic").agg(F.count("*").alias("n"))
    place = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # At most two rows of sizes per label value; the sample is bounded by its parameter.
    most = F.when(F.col("toxic") == 1, sample).otherwise(clean)
    chosen = marked.join(F.broadcast(sizes.where("toxic IN (0, 1)")), "toxic").where(place * F.col("n") < most).select(
        "doc_id", "toxic", place.alias("place"), F.greatest(F.lit(1.0), F.col("n") / most).alias("weight"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted({w[:LONGEST] for w in _words_of(t)}) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("toxic").cast(pa.int32()), batch.column("place"), batch.column("weight"),
                                   pa.array(words, pa.list_(pa.string()))], ["toxic", "place", "weight", "words"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "toxic", "place", "weight", "text")
    return rows.mapInArrow(run, "toxic int, place double, weight double, words array<string>")


def _machine(features: np.ndarray, sign: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the active rows."""
    x = np.hstack([features, np.ones((len(features), 1), features.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        active = sign * (x @ w) < 1
        xa, wa = x[active], weight[active] * cost
        new = np.linalg.solve(ridge + (xa * wa[:, None]).T @ xa, (xa * wa[:, None]).T @ sign[active])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], float(w[-1])


def _calibrated(figures: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve through the texts' figures (the last is constant)."""
    w = np.zeros(figures.shape[1])
    ridge = np.full(len(w), 1e-1)
    ridge[-1] = 1e-3
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(figures @ w, -30, 30)))
        slope = figures.T @ (weight * (p - toxic)) + ridge * w
        curve = (figures * (weight * p * (1 - p))[:, None]).T @ figures + np.diag(ridge)
        w -= np.clip(np.linalg.solve(curve, slope), -2, 2)
    return w


def _copies(word: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """About how many texts are near-copies of each text, itself included: those that share smallest hashes of rare words.

    The median over the hashes counts, as texts that share one rare word have the smallest in common only now and then.
    """
    frequency = np.bincount(word)
    rare = frequency[word] <= max(2, texts // 50)
    size = np.ones((8, texts))
    for turn in range(8):
        hashes = ((word + 1) * 2654435761 + (turn + 1) * 40503 * (word + 7)) % (1 << 32)
        least = np.full(texts, 1 << 32)
        np.minimum.at(least, doc[rare], hashes[rare])
        _, group, sizes = np.unique(least, return_inverse=True, return_counts=True)
        size[turn] = np.where(least < 1 << 32, sizes[group], 1)
    return np.median(size, axis=0)


def _witnesses(word: np.ndarray, doc: np.ndarray, toxic: np.ndarray, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that several toxic texts and hardly any clean ones have, most frequent first, and their support.

    Near-copies of a text count as one, or all their words would look telling.
    """
    weight = np.where(toxic, 1 / _copies(word, doc, len(toxic)), 0.0)
    support = np.bincount(word, weight[doc], minlength=len(odds))
    support[odds < MIN_ODDS] = 0
    found = np.flatnonzero(support >= MIN_SUPPORT)
    found = found[np.argsort(-support[found], kind="stable")]
    return found, support[found]


def _odds(bad: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    return np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((~toxic).sum() + 1))


def _alone(vocabulary: np.ndarray, positive: np.ndarray, word: np.ndarray, doc: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which witnesses stand alone: texts with any word like them are toxic as often as those with the witness itself."""
    words = vocabulary[positive].tolist()
    out = np.zeros(len(words), bool)
    for at in range(0, len(words), 256):
        part = words[at:at + 256]
        like = np.concatenate([kernel(vocabulary[a:a + 8192].tolist(), part) >= ALIKE
                               for a in range(0, len(vocabulary), 8192)])
        for i in range(len(part)):
            texts = np.zeros(len(toxic), bool)
            texts[doc[like[word, i]]] = True
            out[at + i] = _odds((texts & toxic).sum(), (texts & ~toxic).sum(), toxic) >= MIN_ODDS
    return out


def fit(rows: pd.DataFrame, landmarks: int = LANDMARKS) -> Model | None:
    """Model of the sampled texts (toxic, place, weight, words); None unless both kinds are there."""
    rows = rows.sort_values("place").reset_index(drop=True)
    toxic = rows["toxic"].to_numpy() == 1
    if not toxic.any() or toxic.all():
        return None
    sizes = rows["words"].map(len).to_numpy()
    doc = np.repeat(np.arange(len(rows)), sizes)
    word, vocabulary = pd.factorize(np.array([w for ws in rows["words"] for w in ws], dtype=object), sort=True)
    bad, good = (np.bincount(word[side[doc]], minlength=len(vocabulary)) for side in (toxic, ~toxic))
    odds = _odds(bad, good, toxic)
    ordinary = np.flatnonzero((good > 0) & (odds < 1.5))
    witnesses, support = _witnesses(word, doc, toxic, odds)
    if not len(witnesses) or not len(ordinary):
        return None
    common = ordinary[np.argsort(-good[ordinary], kind="stable")[:landmarks // 4]]
    spread = ordinary[:: max(1, len(ordinary) // (landmarks // 2))]
    telling = witnesses[:landmarks // 2]
    marks = vocabulary[np.unique(np.concatenate([telling, common, spread]))].tolist()

    inner = kernel(marks, marks).astype(np.float64)
    values, vectors = np.linalg.eigh(inner)
    keep = values > 1e-4 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    ids, weights = _triples(marks)

    def folded(v: np.ndarray) -> np.ndarray:
        table = np.zeros(_SYMBOLS ** 3)
        np.add.at(table, (ids.ravel(),), (weights * (root @ v)[:, None]).ravel())
        table[0] = 0
        return table

    some = ordinary[:: max(1, len(ordinary) // NEGATIVES)]
    # A clean word weighs by how many clean texts have it: those with a telling stem are in few.
    plain_words = np.union1d(common, some)
    used = np.concatenate([witnesses, plain_words])
    sign = np.repeat([1.0, -1.0], [len(witnesses), len(plain_words)])
    having = np.sqrt(good[plain_words])
    weight = np.concatenate([support / support.sum(), 2 * having / having.sum()])
    v, joint_bias = _machine(kernel(vocabulary[used].tolist(), marks) @ root, sign, weight * len(sign) / 20)
    joint = folded(v)

    # Without a word that stands alone, the first machine says no to every word.
    table, bias = np.zeros(_SYMBOLS ** 3), -1.0
    positive = witnesses[_alone(vocabulary, witnesses, word, doc, toxic)]
    used = np.unique(np.concatenate([positive, common, some]))
    # Witnesses with a letter put in between are to be found as well.
    altered = sorted({w[:i] + c + w[i:] for w in vocabulary[positive].tolist() if len(w) > 3
                      for i in range(1, len(w)) for c in (w[i], "x")} - set(vocabulary[ordinary].tolist()))
    altered_features = kernel([w[:LONGEST] for w in altered], marks) @ root
    for _ in range(ROUNDS if len(positive) else 0):
        sign = np.concatenate([np.where(np.isin(used, positive), 1.0, -1.0), np.ones(len(altered))])
        weight = np.concatenate([
            np.where(sign[:len(used)] > 0, 1 / len(positive), 2 / max(1, len(used) - len(positive))),
            np.full(len(altered), 1 / max(1, len(altered)))])
        features = np.concatenate([kernel(vocabulary[used].tolist(), marks) @ root, altered_features])
        v, bias = _machine(features, sign, weight * len(sign) / 20)
        table = folded(v)
        # Ordinary words that come too close to the margin are negatives of the next turn.
        rest = np.setdiff1d(ordinary, used)
        value = Model(table[:, None], np.array([bias]), np.zeros(0)).words(vocabulary[rest].tolist())[:, 0]
        close = rest[value > -0.3]
        if not len(close):
            break
        used = np.union1d(used, close[np.argsort(-value[value > -0.3], kind="stable")[:NEGATIVES // 4]])
    model = Model(np.stack([table, joint], axis=1), np.array([bias, joint_bias]), np.zeros(0))
    value = model.words(vocabulary.tolist())[word]
    figures = np.array([model.text(x) for x in np.split(value, np.cumsum(sizes)[:-1])])
    model.weights = _calibrated(figures, toxic.astype(float), rows["weight"].to_numpy())
    return model


class Scorer:
    """Figures of texts from the decision values of their words; remembers runs of characters between white space."""

    def __init__(self, model: Model):
        self.model = model
        self._forget(_MEMORY)

    def _forget(self, room: int) -> None:
        self.memory: dict[str, int] = {}  # place of a run's word; runs of the same word share it
        self.places: dict[str, int] = {}
        self.values = np.zeros((room, 2))
        self.short = np.zeros(room, bool)
        self.single = np.zeros(room, bool)
        self.letter: list[str] = []  # the word if it is a single letter, else nothing

    def _learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.memory]
        if len(self.memory) + len(new) > len(self.values):
            new = list(tokens)
            self._forget(max(_MEMORY, len(new)))
        if new:
            plains = [plain(t) for t in new]
            words = list({w for w in plains if w not in self.places})
            base = len(self.places)
            if words:
                self.values[base:base + len(words)] = self.model.words(words)
                self.short[base:base + len(words)] = [len(w) < 2 for w in words]
                self.single[base:base + len(words)] = [len(w) == 1 for w in words]
                self.letter += [w if len(w) == 1 else "" for w in words]
                self.places.update(zip(words, range(base, base + len(words)), strict=True))
            self.memory.update(zip(new, map(self.places.__getitem__, plains), strict=True))

    def figures(self, texts: pa.Array) -> np.ndarray:
        nothing = self.model.text(np.zeros((0, 2)))
        out = np.tile(nothing, (len(texts), 1))
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
                    places = np.fromiter(map(get, tokens), np.int64, len(tokens))
                    distinct = np.unique(places)
                    values = self.values[distinct[~self.short[distinct]]]
                    single = self.single[places]
                    # Only three letters in a row spell a word.
                    if (single[:-2] & single[1:-1] & single[2:]).any():
                        values = np.concatenate([values, self._spelled(places)])
                    out[i] = self.model.text(values)
        return out

    def _spelled(self, places: np.ndarray) -> np.ndarray:
        """Values of the words that are spelled out in single letters."""
        line = "".join([self.letter[p] or " " for p in places])
        return self.model.words(sorted({r for r in line.split() if len(r) > 2}))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, score`` of every row; 0 for all without a model. Takes the text alone."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = scorer.model.score(scorer.figures(batch.column("text")))
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (doc_id, text and any other columns).

    Learns from ``labels`` (doc_id, toxic) whose ``crc32(doc_id) % 5`` is not 0. Null, empty and wordless texts get the
    score of a text without a toxic word; without labels of both kinds every score is 0. Repeated rows give repeated
    results; an empty table gives an empty one.
    """
    model = fit(training_rows(docs, labels).toPandas())
    return score(docs, model).select("doc_id", is_held_out().alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
