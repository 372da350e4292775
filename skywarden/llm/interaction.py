"""Filter interaction audit: what each filter takes away in every order in which filters can be applied.

A text's failures are a mask with a bit for each filter. Documents collapse to mask cells, counted by part, before any
order is looked at: there are at most two to the number of filters masks in a part. Each cell folds over the array of
all orders, a constant of the plan, into one struct for each order and step, weighted with the cell's documents, and the
cells of a part are merged by elementwise sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "number"]


def text_failures(text: Column, names: Sequence[str] = "ABCD") -> Column:
    """Bits of the rules on one text, A lowest: short, repetitive, shouting, symbols."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    rules = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 3 * F.length(text),
             text.rlike("[#$%&*|]")]
    return sum((F.when(rule, F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(rules)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, n_good, n_toxic``: documents by language and failures; bit 4 marks copies of a smaller doc_id."""
    text = F.coalesce("text", F.lit(""))
    marks = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.sha2(text, 256).alias("same"),
                        text_failures(text).alias("mask"))
    judged = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("judged_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    # Everything on the way has a bounded number of rows for a text, however often it is repeated: rows of one doc_id,
    # then of one language and judgement, then one.
    by_id = marks.join(judged, F.col("doc_id") == F.col("judged_id"), "left").groupBy(
        "doc_id", "same", "mask", "part", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(F.count("*").alias("n"))
    # Rows without a doc_id are neither copies of smaller ones nor smaller themselves.
    known = F.col("doc_id").isNotNull()
    kinds = by_id.groupBy("same", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("n_unknown"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"))
    texts = kinds.groupBy("same", "mask").agg(
        F.collect_list(F.struct("part", "good", "toxic", "n", "n_unknown", "first")).alias("kinds"),
        F.min("first.doc_id").alias("least"))
    one = texts.select("mask", "least", F.explode("kinds").alias("k"))
    originals = F.col("k.n_unknown") + F.when(F.col("k.first.doc_id") == F.col("least"), F.col("k.first.n")).otherwise(0)
    either = one.select(F.col("k.part").alias("part"), F.col("k.good").alias("good"), F.col("k.toxic").alias("toxic"),
                        F.explode(F.array(F.struct(F.col("mask"), originals.alias("n")), F.struct(
                            (F.col("mask") + 16).alias("mask"), (F.col("k.n") - originals).alias("n")))).alias("c"))
    n = F.col("c.n")
    return either.where(n > 0).groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("n_toxic"))


def orders(names: str) -> list[str]:
    """All orders of the filters; names are single letters."""
    return ["".join(p) for p in permutations(names)]


def interactions(mask_cells: DataFrame, names: str = "ABCDE") -> DataFrame:
    """``part, filter_order, step`` and counts, for every part, order and step.

    ``mask_cells`` has ``part, mask, n, n_good, n_toxic``, a bit of ``mask`` for each of ``names``; several rows of one
    part and mask add up. The counts are ``kept`` after the step, ``removed`` by it, ``redundant`` (failing, but removed
    before), ``unique_fails`` (failing this filter alone), ``good_lost``, ``toxic_lost``, and ``shapley``: removed by the
    step's filter over all orders. No cells, no rows.
    """
    every = orders(names)
    # A constant of the plan: 120 orders of 5 filters.
    filters = {x: F.struct(F.lit(k).alias("number"), F.lit(1 << k).alias("bit")) for k, x in enumerate(names)}
    order_array = F.array(*[F.array(*[filters[x] for x in order]) for order in every])
    cell = mask_cells.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "n_good", "n_toxic")])
    zero = F.lit(0).cast("long")
    step_type = "struct<" + ",".join(f"{c}:bigint" for c in _COUNTS) + ">"

    def fold(order: Column) -> Column:
        """The steps of one order for the cell at hand: alive until the first filter that it fails."""
        start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<{step_type}>").alias("steps"))

        def step(state: Column, at: Column) -> Column:
            alive, bit = state["alive"], at["bit"]
            fails = F.col("mask").bitwiseAND(bit) != 0
            here = alive & fails
            made = F.struct(
                F.when(alive & ~fails, F.col("n")).otherwise(zero).alias("kept"),
                F.when(here, F.col("n")).otherwise(zero).alias("removed"),
                F.when(~alive & fails, F.col("n")).otherwise(zero).alias("redundant"),
                F.when(F.col("mask") == bit, F.col("n")).otherwise(zero).alias("unique_fails"),
                F.when(here, F.col("n_good")).otherwise(zero).alias("good_lost"),
                F.when(here, F.col("n_toxic")).otherwise(zero).alias("toxic_lost"),
                at["number"].cast("long").alias("number"))
            return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(made)).alias("steps"))

        return F.aggregate(order, start, step, lambda state: state["steps"])

    folded = cell.select("part", F.flatten(F.transform(order_array, fold)).alias("steps"))

    def added(a: Column, b: Column) -> Column:
        """Sums element by element; ``number``, that of the step's filter, is the same in both."""
        return F.zip_with(a, b, lambda x, y: F.struct(
            *[(x[c] + y[c]).alias(c) for c in _COUNTS[:-1]], x["number"].alias("number")))

    # A part has as many rows here as there are masks, 32 at most for five filters.
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("all")).select(
        "part", F.aggregate(F.slice("all", 2, 1 << len(names)), F.element_at("all", 1), added).alias("steps"))
    totals = F.transform(F.array(*map(F.lit, range(len(names)))), lambda k: F.aggregate(
        "steps", zero, lambda acc, x: acc + F.when(x["number"] == k, x["removed"]).otherwise(zero)))
    whole = merged.select("part", "steps", totals.alias("totals")).select(
        "part", "totals", F.posexplode("steps").alias("at", "s"))
    order = F.element_at(F.array(*map(F.lit, every)), (F.col("at") / len(names)).cast("int") + 1)
    step = F.col("at") % len(names) + 1
    return whole.select("part", order.alias("filter_order"), step.cast("int").alias("step"),
                        *[F.col(f"s.{c}").alias(c) for c in _COUNTS[:-1]], F.element_at("totals", F.col("s.number").cast("int") + 1).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Interactions of five filters on whole texts, by language (null: the empty string).

    A document fails A with under 200 words, B with fewer than half of its words distinct, C with over 3 % capitals A-Z,
    D with any of ``#$%&*|``, E when a smaller doc_id has the same text, removed or not. A null text is empty. Rows that
    share a doc_id count one by one and are no copies of each other; rows without doc_id are no copies either, have no
    label and are nobody's smaller one. Of several labels of a doc_id, one is enough to be good or toxic; labels of
    absent documents and null labels count for nothing. Texts of any length are looked at whole. An empty table gives no
    rows. Extra columns are not read.
    """
    return interactions(cells(docs, labels))
