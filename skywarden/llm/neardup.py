"""Near-duplicate documents: b-bit MinHash signatures and a multi-index Hamming join.

A document is the set of its 5-word shingles. ``SLOTS`` minima of that set, ``BITS`` bits each, form its signature; two
documents with Jaccard similarity J differ in about ``(1 - J) * SLOTS`` slots. Signatures are cut into chunks of
``CHUNK`` slots. By the pigeonhole principle two signatures that differ in at most ``MAX_DISTANCE = 2 * chunks - 1``
slots have a chunk with at most one error, so indexing every chunk with each of its slots left out in turn meets every
such pair. At J = 0.75 the chance of more errors than that is 1 in 762,000 for a pair, and falls steeply above.
What the index finds is confirmed on the full shingle sets.

Sizes: equal sets are one node throughout. Within an index bucket each node first meets the smallest one only; after
those links are joined to components, nodes of small buckets that still are in different components are paired, and
those of large buckets meet in blocks of bounded size, two a task, which yields links and no candidates. Nothing is
capped, and no large bucket is listed pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywarden.llm.store import components, stored
from skywarden.llm.words import mix, word_slices
from skywarden.llm.workers import tidy

SHINGLE = 5
SLOTS, CHUNK, BITS = 80, 4, 16
MAX_DISTANCE = 2 * (SLOTS // CHUNK) - 1
# Similarity as a fraction of whole numbers: 100 * intersection >= 75 * union.
PERCENT = 75
# Buckets up to this size are paired by a join, larger ones in blocks of BLOCK signatures.
SMALL, BLOCK = 32, 1024
BLOCK_SHINGLES = 2_000_000
# Columns of a strip of a membership matrix.
STRIP = 4096
# Members that meet one head's text in one group while links are confirmed.
SHARE = 64

_SEED = np.random.Generator(np.random.Philox(20240601))
_FACTORS = _SEED.integers(0, 1 << 32, SLOTS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _SEED.integers(0, 1 << 32, SLOTS, dtype=np.uint64).astype(np.uint32)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` count as one shingle, none as no shingle."""
    for at, to, words in word_slices(texts, lower=True):
        every = words.windows(size)
        for first, last in zip(words.first[:-1], words.first[1:], strict=True):
            if last - first >= size:
                yield np.unique(every[first:last - size + 1])
            elif last > first:
                yield words.windows(int(last - first), np.array([first]))
            else:
                yield np.zeros(0, np.uint64)


def _signature(shingles: np.ndarray) -> bytes:
    if not len(shingles):
        return b""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    minima = np.full(SLOTS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        minima = np.minimum(minima, (low[at:at + 4096] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1))
    return (mix(minima.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).astype(np.uint16).tobytes()


def _set_id(shingles: np.ndarray) -> bytes:
    """128 bits that depend on the set alone; the two sums run over different one-to-one maps of the hashes."""
    one, two = mix(shingles), mix(shingles * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
    return one.sum(dtype=np.uint64).tobytes() + two.sum(dtype=np.uint64).tobytes()


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, signature`` of every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, marks = [], [], []
            for shingles in shingle_sets(batch.column("text")):
                sizes.append(len(shingles))
                ids.append(_set_id(shingles) if len(shingles) else None)
                marks.append(_signature(shingles) if len(shingles) else None)
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()),
                                   pa.array(ids, pa.binary()), pa.array(marks, pa.binary())],
                                  ["doc_id", "n_shingles", "set_id", "signature"])

    return docs.select("doc_id", "text").mapInArrow(
        tidy(run), "doc_id long, n_shingles long, set_id binary, signature binary")


def _index(nodes: DataFrame) -> DataFrame:
    """``key, node``: every chunk of each signature with each of its slots left out. A key holds its symbols exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            slots = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
            slots = slots.reshape(batch.num_rows, SLOTS).astype(np.int64)
            keys = np.empty((batch.num_rows, SLOTS), np.int64)
            for out in range(SLOTS):
                rest = [s for s in range(out // CHUNK * CHUNK, out // CHUNK * CHUNK + CHUNK) if s != out]
                key = np.full(batch.num_rows, out, np.int64)
                for s in rest:
                    key = (key << BITS) | slots[:, s]
                keys[:, out] = key
            offsets = pa.array(np.arange(0, keys.size + 1, SLOTS, dtype=np.int32))
            yield pa.record_batch([batch.column("node"), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
                                  ["node", "keys"])

    return (nodes.select("node", "signature").mapInArrow(tidy(run), "node long, keys array<long>")
            .select(F.explode("keys").alias("key"), "node"))


def _within(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, distance`` of the pairs whose signatures differ in at most MAX_DISTANCE slots and whose sizes allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SLOTS)
                        for c in ("signature_a", "signature_b"))
            far = (one != two).sum(axis=1)
            keep = far <= MAX_DISTANCE
            yield pa.record_batch([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep)),
                                   pa.array(far[keep].astype(np.int32))], ["a", "b", "distance"])

    sides = [nodes.select(F.col("node").alias(s), F.col("signature").alias(f"signature_{s}"),
                          F.col("n_shingles").alias(f"n_{s}")) for s in "ab"]
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return (pairs.join(sides[0], "a").join(sides[1], "b").where(100 * small >= PERCENT * large)
            .select("a", "b", "signature_a", "signature_b").mapInArrow(tidy(run), "a long, b long, distance int"))


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough.

    Groups have one text of node ``b`` and up to about SHARE texts to compare it with; a ``b`` with many partners is
    dealt over several groups. Texts stream through a group one after the other.
    """
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("parts"))
    dealt = pairs.join(sizes, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"))
    groups = dealt.select("b", "part").distinct()
    heads = groups.join(texts, groups.b == texts.node).select("b", "part", F.lit(None).cast("long").alias("a"), "text")
    others = dealt.join(texts, dealt.a == texts.node).select("b", "part", "a", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, mine, found = None, [], []
        for batch in batches:
            keys = zip(batch.column("b").to_pylist(), batch.column("part").to_pylist(), strict=True)
            for key, a, shingles in zip(keys, batch.column("a").to_pylist(), shingle_sets(batch.column("text")),
                                        strict=True):
                if key != group:
                    group, mine = key, []
                if a is None:
                    mine.append(shingles)
                    continue
                for other in mine:
                    both = len(np.intersect1d(shingles, other, assume_unique=True))
                    if 100 * both >= PERCENT * (len(shingles) + len(other) - both):
                        found.append((a, key[0]))
                        break
            yield pa.record_batch([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])
            found = []

    return (heads.unionByName(others).repartition("b", "part")
            .sortWithinPartitions("b", "part", F.col("a").asc_nulls_first()).mapInArrow(tidy(run), "a long, b long"))


def _common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of bounded strips of the membership matrices."""
    sets = [*one, *two]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    keep = times[column] > 1
    row, column = row[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(one), len(two)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, STRIP):
        low, high = np.searchsorted(column, [at, at + STRIP])
        strip = np.zeros((len(sets), STRIP), np.float32)
        strip[row[low:high], column[low:high] - at] = 1
        out += strip[:len(one)] @ strip[len(one):].T
    return out


def _links_of_blocks(one: pa.Table, two: pa.Table | None) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks (or within one) of texts in different components."""
    within = two is None
    two = one if within else two
    mark_a, mark_b = (np.frombuffer(b"".join(t["signature"].to_pylist()), np.uint16).reshape(-1, SLOTS) for t in (one, two))
    node_a, node_b, label_a, label_b, size_a, size_b = (
        t[c].to_numpy() for c in ("node", "label", "n_shingles") for t in (one, two))
    maybe = np.zeros((len(node_a), len(node_b)), bool)
    for i in range(len(node_a)):
        maybe[i] = (mark_b != mark_a[i]).sum(axis=1) <= MAX_DISTANCE
    maybe &= label_a[:, None] != label_b
    maybe &= 100 * np.minimum(size_a[:, None], size_b) >= PERCENT * np.maximum(size_a[:, None], size_b)
    if within:
        maybe &= np.arange(len(node_a))[:, None] < np.arange(len(node_a))
    rows, columns = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
    if not len(rows):
        return node_a[:0], node_a[:0]
    sets_a = list(shingle_sets(one["text"].take(pa.array(rows)).combine_chunks()))
    sets_b = list(shingle_sets(two["text"].take(pa.array(columns)).combine_chunks()))
    both = _common(sets_a, sets_b)
    union = size_a[rows][:, None] + size_b[columns] - both
    i, j = np.nonzero(maybe[np.ix_(rows, columns)] & (100 * both >= PERCENT * union))
    return node_a[rows[i]], node_b[columns[j]]


def _in_blocks(rows: DataFrame, nodes: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links across components among the nodes of the large buckets ``rows`` (key, head, node, label), and the cluster
    of each such node.

    A node's cluster is the smallest head of its buckets. Clusters are dealt into blocks of a bounded number of nodes
    and shingles, those of the cluster's most frequent component apart. Every two blocks of a cluster, and every two
    that share a bucket, meet in one task, unless all their nodes are in one component.
    """
    # A node is in at most SLOTS buckets.
    members = rows.groupBy("node", "label").agg(
        F.min("head").alias("cluster"), F.collect_list("key").alias("keys")).join(nodes, "node")
    members = stored(members, "clusters")
    by_label = members.groupBy("cluster", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    main = by_label.groupBy("cluster").agg(F.max_by(F.struct("label", "n", "shingles"), F.struct("n", "label")).alias("m"),
                                           F.sum("n").alias("n"), F.sum("shingles").alias("shingles")).select(
        "cluster", F.col("m.label").alias("main"), F.col("m.n").alias("n_main"), F.col("m.shingles").alias("s_main"),
        (F.col("n") - F.col("m.n")).alias("n_rest"), (F.col("shingles") - F.col("m.shingles")).alias("s_rest"))
    apart = F.col("label") == F.col("main")
    parts = F.ceil(F.greatest(F.when(apart, F.col("n_main")).otherwise(F.col("n_rest")) / BLOCK,
                              F.when(apart, F.col("s_main")).otherwise(F.col("s_rest")) / BLOCK_SHINGLES)).cast("int")
    dealt = members.join(main, "cluster").select(
        "node", "label", "n_shingles", "signature", "cluster", "keys", F.when(apart, F.col("label")).alias("single"),
        F.xxhash64("cluster", apart, F.pmod(F.xxhash64("node"), parts)).alias("block"))
    dealt = stored(dealt, "blocks")
    at_key = stored(dealt.select(F.explode("keys").alias("key"), "block", "single").distinct(), "blocks-of-buckets")
    in_cluster = stored(dealt.select(F.col("cluster").alias("key"), "block", "single").distinct(), "blocks-of-clusters")

    def meetings(places: DataFrame) -> DataFrame:
        return (places.select("key", F.col("block").alias("one"), F.col("single").alias("s1"))
                .join(places.select("key", F.col("block").alias("two"), F.col("single").alias("s2")), "key")
                .where("one <= two AND NOT coalesce(s1 = s2, false)").select("one", "two"))

    meet = meetings(at_key).unionByName(meetings(in_cluster)).distinct()
    sides = meet.select("one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    tables = sides.join(dealt.drop("cluster", "single", "keys"), "block").join(texts, "node")

    def run(table: pa.Table) -> pa.Table:
        first = pc.equal(table["block"], table["one"])
        one, two = table.filter(first), table.filter(pc.invert(first))
        a, b = _links_of_blocks(one, two if len(two) else None)
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    links = tables.groupBy("one", "two").applyInArrow(run, "a long, b long")
    return links, dealt.select("node", "cluster").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text and any other columns).

    Words are lower-cased (A-Z). Links join documents with ``100 * intersection >= 75 * union`` of their shingle sets;
    ``component_id`` is the smallest doc_id that links reach, and the document with that id is kept. Texts without a
    word, and null texts, have no shingles and no links. Repeated rows give repeated results; rows that share a doc_id
    but not the text count as one document with the links of either. A row without doc_id takes no part: it is
    returned with a null component and is kept. An empty table gives an empty result.
    """
    marks = stored(signatures(docs), "signatures")
    named = marks.where("doc_id IS NOT NULL AND n_shingles > 0")
    sets = named.groupBy("set_id", "n_shingles").agg(F.min("doc_id").alias("node"), F.max("signature").alias("signature"))
    sets = stored(sets, "sets")
    nodes = sets.select("node", "n_shingles", "signature")

    index = _index(nodes)
    heads = index.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"),
                                     F.count("*").alias("size")).where("head != last")
    buckets = stored(index.join(heads.select("key", "head", "size"), "key"), "buckets")

    texts = stored(docs.select(F.col("doc_id").alias("node"), "text")
                   .join(buckets.select("node").distinct(), "node", "left_semi"), "texts")
    first = _within(buckets.where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(),
                    nodes)
    first = stored(first, "head-pairs")
    nearest = first.groupBy("a").agg(F.min_by("b", F.struct("distance", "b")).alias("b"))
    links = stored(_confirm(nearest, texts), "links-nearest")
    labels = stored(components(links), "labels-nearest")

    rows = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(
        "low != high").select("key")
    rows = stored(rows.join(mixed, "key"), "mixed-buckets")
    in_blocks, clusters = _in_blocks(rows.where(F.col("size") > SMALL).select("key", "head", "node", "label"), nodes, texts)
    in_blocks = stored(in_blocks, "links-blocks")

    # Pairs of small buckets, but for those that have met in a cluster.
    placed = rows.where(F.col("size") <= SMALL).join(clusters, "node", "left").select("key", "node", "label", "cluster")
    left, right = (placed.select("key", F.col("node").alias(s), F.col("label").alias(f"label_{s}"),
                                 F.col("cluster").alias(f"cluster_{s}")) for s in "ab")
    apart = "a > b AND label_a != label_b AND NOT coalesce(cluster_a = cluster_b, false)"
    met = left.join(right, "key").where(apart).select("a", "b").distinct()
    rest = _within(met, nodes).select("a", "b").join(nearest, ["a", "b"], "left_anti")
    more = stored(_confirm(stored(rest, "other-pairs"), texts), "links-rest").unionByName(in_blocks)

    final = components(links.unionByName(more))
    found = (sets.select("set_id", "node").join(final, "node", "left")
             .select("set_id", F.coalesce("label", "node").alias("component_id")))
    return (marks.join(found, "set_id", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
            .select("doc_id", "n_shingles", "component_id", "kept"))
