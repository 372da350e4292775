"""Hard negatives of anchors by exact integer products, several candidates to one wide integer.

Components become integers, ``floor(scale * x)``. Anchors and candidates meet in tiles of a block of anchors and a block
of candidates, both of bounded size. In a tile the components are biased to be non-negative, and those of several
candidates go side by side into the fields of one wide integer; it is multiplied once for each anchor component, and the
sums of products are read back from the fields without carries between them. The wide integers are doubles, which hold
every integer below 2**53 exactly: a field is as wide as the largest sum that the tile can make, and as many fields are
taken as fit. Where not even one fits, 64-bit integers are multiplied one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywarden.llm.store import stored

# Bits of a wide integer; a double holds every integer of as many.
WIDE_BITS = 53
# Largest blocks of a tile, in rows and in components, and scores that are looked at together.
ANCHORS, CANDIDATES, BLOCK_COMPONENTS, SCORES = 2048, 32768, 1 << 22, 1 << 21
LEAST_CANDIDATES = 1024
# Larger components might lead to scores beyond 64 bits.
LARGEST = 1 << 24

_POSITIVES = "r long, anchor_id long, other_id long, score long"
_NEGATIVES = "r long, anchor_id long, positive int, positive_id long, positive_score long, other_id long, score long"


def _matrix(lists: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows; missing components at the end of shorter ones are zero."""
    flat = lists.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    sizes = pc.list_value_length(flat).to_numpy(zero_copy_only=False)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dims).all():
        return values.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = values
    return out


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: a row for each anchor, a column for each candidate."""
    n, dims = candidates.shape
    if not dims or not n or not len(anchors):
        return np.zeros((len(anchors), n), np.int64)
    up_a, up_c = -int(anchors.min()), -int(candidates.min())
    a, c = anchors + up_a, candidates + up_c
    width = max(1, (dims * int(a.max()) * int(c.max())).bit_length())
    fields = WIDE_BITS // width
    if not fields:
        return np.einsum("ad,cd->ac", anchors, candidates)
    wide_n = -(-n // fields)
    padded = np.zeros((wide_n * fields, dims), np.int64)
    padded[:n] = c
    # Candidate f * wide_n + i stands in field f of wide integer i.
    wide = (padded.reshape(fields, wide_n, dims) << (np.arange(fields) * width)[:, None, None]).sum(axis=0)
    sums = (a.astype(np.float64) @ wide.astype(np.float64).T).astype(np.int64)
    mask = (1 << width) - 1
    found = np.concatenate([(sums >> (f * width)) & mask for f in range(fields)], axis=1)[:, :n]
    # sum((a + p) * (c + q)) = sum(a * c) + q * sum(a) + p * sum(c) + dims * p * q
    return (found - up_c * anchors.sum(axis=1)[:, None] - up_a * candidates.sum(axis=1)[None, :] - dims * up_a * up_c)


def _first(group: np.ndarray, score: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Positions of the first ``n`` of every group: highest score first, then lowest place."""
    order = np.lexsort((place, -score, group))
    g = group[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
    return order[rank < n]


def _chunks(n_anchors: int, n_candidates: int) -> Iterator[tuple[slice, slice]]:
    step = max(1, min(n_candidates, 8192))
    rows = max(1, SCORES // step)
    for a in range(0, n_anchors, rows):
        for c in range(0, n_candidates, step):
            yield slice(a, min(a + rows, n_anchors)), slice(c, min(c + step, n_candidates))


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("vec_id", "ascending"), ("r", "ascending")])


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().astype(np.int64)


def _tile_dims(left: pa.Table, right: pa.Table) -> int:
    return max(pc.max(pc.list_value_length(t["vector"])).as_py() or 0 for t in (left, right))


def _positives_of_tile(n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The first ``n`` candidates of every anchor in a tile of one label."""
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] * 3]
        if len(anchors) and len(candidates):
            candidates = _ordered(candidates)
            dims = _tile_dims(anchors, candidates)
            a, c = _matrix(anchors["vector"], dims), _matrix(candidates["vector"], dims)
            own, other = _numbers(anchors, "r"), _numbers(candidates, "r")
            for rows, cols in _chunks(len(a), len(c)):
                score = products(a[rows], c[cols])
                fit = own[rows][:, None] != other[cols][None, :]
                if score.shape[1] > n + 1:
                    # One place more than asked for: the anchor itself may be among the highest.
                    fit &= score >= np.partition(score, -(n + 1), axis=1)[:, -(n + 1)][:, None]
                i, j = np.nonzero(fit)
                s = score[i, j]
                keep = _first(i, s, j, n)
                out.append([i[keep] + rows.start, j[keep] + cols.start, s[keep]])
        i, j, s = (np.concatenate(x) for x in zip(*out))
        keep = _first(i, s, j, n)
        i, j, s = i[keep], j[keep], s[keep]
        ids = _numbers(candidates, "vec_id")
        return pa.table({"r": _numbers(anchors, "r")[i], "anchor_id": _numbers(anchors, "vec_id")[i], "other_id": ids[j],
                         "score": s})
    return run


def _bounds(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest integer x with low * score <= 100 * x <= high * score; nothing overflows on the way."""
    q, rest = np.divmod(scores, 100)
    return low * q - (-low * rest) // 100, high * q + (high * rest) // 100


def _negatives_of_tile(n: int, low: int, high: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The first ``n`` candidates of another label for every anchor and positive in a tile."""
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] * 4]
        lists = anchors["positives"].combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        flat = lists.flatten()
        p_id, p_score = (flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("id", "score"))
        if len(anchors) and len(candidates):
            candidates = _ordered(candidates)
            dims = _tile_dims(anchors, candidates)
            a, c = _matrix(anchors["vector"], dims), _matrix(candidates["vector"], dims)
            label = pa.concat_arrays([x for t in (anchors, candidates) for x in t["label"].chunks]).dictionary_encode()
            label = label.indices.to_numpy()
            own, other = label[:len(a)], label[len(a):]
            least, most = _bounds(p_score, low, high)
            widest = np.minimum.reduceat(least, begin[:-1]), np.maximum.reduceat(most, begin[:-1])
            for rows, cols in _chunks(len(a), len(c)):
                score = products(a[rows], c[cols])
                i, j = np.nonzero((score >= widest[0][rows][:, None]) & (score <= widest[1][rows][:, None])
                                  & (own[rows][:, None] != other[cols][None, :]))
                s, i = score[i, j], i + rows.start
                for k in range(int(sizes[rows].max())):
                    of = begin[i] + k
                    # A list shorter than k + 1 has no bounds of its own there.
                    has = np.flatnonzero(k < sizes[i])
                    has = has[(s[has] >= least[of[has]]) & (s[has] <= most[of[has]])]
                    keep = has[_first(i[has], s[has], j[has], n)]
                    out.append([i[keep], of[keep], j[keep] + cols.start, s[keep]])
        i, of, j, s = (np.concatenate(x) for x in zip(*out))
        keep = _first(of, s, j, n)
        i, of, j, s = i[keep], of[keep], j[keep], s[keep]
        return pa.table({
            "r": _numbers(anchors, "r")[i], "anchor_id": _numbers(anchors, "vec_id")[i],
            "positive": pa.array((of - begin[i]).astype(np.int32)), "positive_id": p_id[of], "positive_score": p_score[of],
            "other_id": _numbers(candidates, "vec_id")[j], "score": s})
    return run


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, with the components as integers."""
    vector = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    fine = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs({scale}D * cast(x AS double)) < {largest}D)"
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(
        F.expr(fine.format(scale=scale, largest=LARGEST))).select("vec_id", "label", vector.alias("vector"))


def _block(parts: Column | int, seed: int) -> Column:
    return F.pmod(F.xxhash64("r", F.lit(seed)), F.lit(parts) if isinstance(parts, int) else parts).cast("int")


def _all(parts: Column | int) -> Column:
    """Every number below ``parts``: a row that goes to all blocks of the other side."""
    return F.explode(F.sequence(F.lit(0), (F.lit(parts) if isinstance(parts, int) else parts).cast("int") - 1))


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80,
                   high: int = 100, scale: int = 256) -> DataFrame:
    """For every anchor and positive the hardest rows of another label, one a row: ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id, embedding, label`` and any other columns; ``is_anchor`` is a condition on ``vec_id`` and
    ``label``. Scores are inner products of the integer components. Positives are an anchor's first ``n_positives``
    other rows of its label, negatives the first ``n_negatives`` rows of other labels whose score is from ``low`` to
    ``high`` percent of the positive's; higher scores come first, of equal ones the smaller ``vec_id``.

    Rows without vec_id, label or vector, with a component that is null or not finite, or so large that it is not below
    2**24 once scaled, take no part. Shorter vectors count as filled up with zeros; empty ones score 0. Rows that are
    repeated or share a vec_id are rows of their own: each may be positive, negative and anchor, also to the other.
    An empty table gives an empty result.
    """
    spark = rows.sparkSession
    table = stored(integer_vectors(rows, scale).withColumn("anchor", F.coalesce(is_anchor, F.lit(False)))
                   .withColumn("r", F.monotonically_increasing_id()), "vectors")
    n, n_anchors, dims = table.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("vector"))).first()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    fit = max(1, BLOCK_COMPONENTS // max(1, dims))
    # Small tables are cut finer, so that all tasks get some; which rows come out does not depend on it.
    spread = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    c_size, a_size = max(1, min(fit, CANDIDATES, max(LEAST_CANDIDATES, n // spread))), min(fit, ANCHORS)
    # Both sides of a tile come from one table: aliases keep their columns apart.
    columns = ["r", "vec_id", "vector", "label"]
    anchors = table.where("anchor").select(*[F.col(c).alias(c) for c in columns])

    # Positives: only rows of one label meet, so each label has blocks of its own.
    per_label = table.groupBy("label").agg(
        F.ceil(F.count("*") / c_size).alias("c_parts"), F.ceil(F.count_if("anchor") / a_size).alias("a_parts")).where(
        "a_parts > 0")
    left = anchors.join(per_label, "label").select(
        "r", "vec_id", "vector", "label", _block(F.col("a_parts"), 1).alias("a"), _all(F.col("c_parts")).alias("c"))
    right = table.join(per_label, "label").select(
        "r", "vec_id", "vector", "label", _all(F.col("a_parts")).alias("a"), _block(F.col("c_parts"), 2).alias("c"))
    met = left.groupBy("label", "a", "c").cogroup(right.groupBy("label", "a", "c")).applyInArrow(
        _positives_of_tile(n_positives), _POSITIVES)
    order = [F.desc("score"), F.asc("other_id")]
    ranked = met.withColumn("k", F.row_number().over(Window.partitionBy("r").orderBy(*order))).where(
        F.col("k") <= n_positives)
    positives = stored(ranked.groupBy("r").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("k", F.col("other_id").alias("id"), "score"))),
        lambda x: F.struct(x["id"].alias("id"), x["score"].alias("score"))).alias("positives")), "positives")

    # Negatives: every anchor with a positive meets every row of another label.
    a_parts, c_parts = -(-n_anchors // a_size), -(-n // c_size)
    left = anchors.join(positives, "r").select("r", "vec_id", "vector", "label", "positives",
                                               _block(a_parts, 1).alias("a"), _all(c_parts).alias("c"))
    right = table.select("r", "vec_id", "vector", "label", _all(a_parts).alias("a"), _block(c_parts, 2).alias("c"))
    met = left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(
        _negatives_of_tile(n_negatives, low, high), _NEGATIVES)
    return met.withColumn("rank", F.row_number().over(Window.partitionBy("r", "positive").orderBy(*order))).where(
        F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
