"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A text is a bag of words; a word's weight is how often it occurs. For each of ``SAMPLES`` samples every word gets two
gamma-distributed numbers r and c and a uniform one b, all drawn from a hash of the word and the sample's number; its
weight w is quantised to ``t = floor(ln(w) / r + b)``, and the word with the smallest ``c / exp(r * (t - b) + r)``
wins. The winner and its t make up the sample. Two texts agree in a sample with the probability of the generalised
Jaccard similarity of their bags: sum of the smaller weights over sum of the larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skywarden.llm.store import stored

SAMPLES = 32
_SPACE = "[\\x20\\x09-\\x0D]+"
_UNIT = float(2 ** -32)
_LOW = 0xFFFFFFFF
# Logarithms are compared as whole numbers of 2**-23, shifted to be positive.
_SHIFT, _SCALE = 128.0, float(2 ** 23)


def _uniform(bits: Column) -> Column:
    return (bits + F.lit(0.5)) * F.lit(_UNIT)


def _gamma(bits: Column) -> Column:
    """Gamma(2, 1) from 64 random bits: minus the logarithm of a product of two uniform numbers."""
    return -F.ln(_uniform(F.shiftrightunsigned(bits, 32)) * _uniform(bits.bitwiseAND(F.lit(_LOW))))


def _sample(word: Column, log_weight: Column, number: int) -> Column:
    """Rank of a word in a sample in the high bits, the name of (word, t) in the low 32."""
    r, c = (_gamma(F.xxhash64(word, F.lit(3 * number + i))) for i in (0, 1))
    b = _uniform(F.xxhash64(word, F.lit(3 * number + 2)).bitwiseAND(F.lit(_LOW)))
    t = F.floor(log_weight / r + b)
    rank = F.floor((F.ln(c) - r * (t - b) - r + F.lit(_SHIFT)) * F.lit(_SCALE))
    return F.shiftleft(rank, 32).bitwiseOR(F.xxhash64(word, F.lit(-1 - number), t).bitwiseAND(F.lit(_LOW)))


def signatures(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys, samples`` (array of names) of every key of ``texts`` (keys, text, rows) that has a word.

    ``rows`` tells how many equal rows the key has; counts are divided by it. Input that is partitioned by some of the
    keys is not shuffled.
    """
    words = texts.select(*keys, "rows", F.explode(F.split(F.btrim("text", F.lit(" \t\n\x0b\f\r")), _SPACE)).alias("word"))
    bags = words.where("word != ''").select(*keys, "rows", F.xxhash64("word").alias("word")).groupBy(
        *keys, "rows", "word").agg(F.count("*").alias("n"))
    weighted = bags.select(*keys, "word", F.ln(F.col("n") / F.col("rows")).alias("log_weight"))
    ranks = weighted.groupBy(*keys).agg(
        *(F.min(_sample(F.col("word"), F.col("log_weight"), k)).alias(f"s{k}") for k in range(samples)))
    names = [F.col(f"s{k}").bitwiseAND(F.lit(_LOW)) for k in range(samples)]
    return ranks.select(*keys, F.array(*names).alias("samples"))


def likeness(one: Column, two: Column) -> Column:
    """Share of equal samples; texts without a word are like each other (1) and unlike all others (0)."""
    same = F.aggregate(F.zip_with(one, two, lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(one.isNull() & two.isNull(), 1.0).when(one.isNull() | two.isNull(), 0.0).otherwise(
        same / F.size(one))


def as_text(samples: Column, size: int = SAMPLES) -> Column:
    words = F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(x), 8, "0")), "")
    return F.lower(F.coalesce(words, F.lit("0" * 8 * size)))


def _following(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, a, b, ...) with ``next``, the key (a, b) of the row after it by descending doc_id, in a circle.

    Rows are range-partitioned and stored with their part, so each part is ordered by itself; only the first row of
    every part is looked at across parts.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("b")]
    placed = stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ordered")
    key = F.struct("a", "b")
    within = placed.withColumn("next", F.lead(key).over(Window.partitionBy("part").orderBy(*order)))
    first = (placed.withColumn("_n", F.row_number().over(Window.partitionBy("part").orderBy(*order))).where("_n = 1")
             .select("part", key.alias("first")))
    # One row a part.
    circle = first.select("part", F.coalesce(
        F.lead("first").over(Window.orderBy("part")),
        F.first("first").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))).alias("after"))
    return within.join(circle, "part").select(
        *rows.columns, F.coalesce("next", "after").alias("next"))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text and any other columns) and of its edited text.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The edited text has its
    last third replaced by as much of the next document's beginning; next is by descending doc_id, rows without doc_id
    last, rows of equal doc_id by a hash of the text, equal rows as one; the first follows the last. Null texts are
    empty ones; texts without a word have a fingerprint of zeros. An empty table gives an empty result.
    """
    a, b = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.xxhash64(F.col("doc_id").isNull(), "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", a.alias("a"), b.alias("b"), "text")
    ids = rows.select("doc_id", "a", "b", F.char_length("text").cast("long").alias("n_chars")).groupBy(
        "doc_id", "a", "b", "n_chars").agg(F.count("*").alias("rows"))
    ids = stored(_following(ids), "following")

    texts = rows.select("a", "b", "text")
    third = F.floor(F.col("n_chars") / 3).cast("int")
    asked = ids.select(F.col("next.a").alias("a"), F.col("next.b").alias("b"), F.col("a").alias("to_a"),
                       F.col("b").alias("to_b"), third.alias("third"))
    n_next = ids.select(F.col("a").alias("next_a"), F.col("b").alias("next_b"), F.col("rows").alias("next_rows"))
    heads = texts.join(asked, ["a", "b"]).select(
        F.col("to_a").alias("a"), F.col("to_b").alias("b"), F.substring("text", F.lit(1), F.col("third")).alias("head"))
    info = ids.join(n_next, (F.col("next.a") == n_next.next_a) & (F.col("next.b") == n_next.next_b)).select(
        "a", "b", "n_chars", third.alias("third"), (F.col("rows") * F.col("next_rows")).alias("rows"))
    pairs = texts.join(info, ["a", "b"]).join(heads, ["a", "b"]).select(
        "a", "b", "rows", "text", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.col("third")).cast("int")),
                                           "head").alias("edited"))
    kinds = pairs.select("a", "b", "rows", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("t")).select("a", "b", "rows", "t.*")
    marks = signatures(kinds, ["a", "b", "kind"], samples)
    sums = pairs.groupBy("a", "b").agg(F.first(F.sha2("edited", 256)).alias("edited_sha256"))
    marks = marks.groupBy("a", "b").agg(F.max(F.when(F.col("kind") == 0, F.col("samples"))).alias("own"),
                                        F.max(F.when(F.col("kind") == 1, F.col("samples"))).alias("edited"))
    found = stored(sums.join(marks, ["a", "b"], "left"), "samples")
    after = found.select(F.col("a").alias("next_a"), F.col("b").alias("next_b"), F.col("own").alias("after"))
    return (ids.join(found, ["a", "b"]).join(after, (F.col("next.a") == after.next_a) & (F.col("next.b") == after.next_b))
            .select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own"), samples).alias("fingerprint"),
                    as_text(F.col("edited"), samples).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("edited")).alias("near_edited"),
                    likeness(F.col("own"), F.col("after")).alias("near_next"),
                    F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_copy")).drop("_copy"))
