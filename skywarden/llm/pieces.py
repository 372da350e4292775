"""SentencePiece encoding and decoding over a relational lattice.

Blanks are written as U+2581. A text is cut between any two characters that stand side by side in no piece of the
vocabulary: no merge goes across such a place, so every unit between two cuts is segmented by itself, once for the whole
table. Each distinct unit is exploded to its substrings of up to the longest piece's length, these are equi-joined to
the piece table (its size is fixed by the model and checked), and the edges that are left are grouped by unit. A fold
over the edges (``aggregate``) finds the segmentation: for a vocabulary of the BPE kind the best-scored edge that covers
exactly two symbols is applied as long as there is one; for one of the unigram kind the state is the best score and way
to each position. The folds work on units of at most ``LONGEST`` characters; longer ones are merged from a heap, to the
same result. Characters without a piece become their bytes' pieces.

The ids of the ``FREQUENT`` most frequent units go to every task, which encodes its texts with them. Texts travel from there
``GROUP`` together, as few bytes; the units that are left over in a group are looked up in a join, each once a group, which
sends back nothing but their numbers and cuts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.llm.store import stored
from skywarden.llm.workers import tidy

MARK = "▁"
LONGEST = 60
# Units whose ids are sent to every task: at most 60 characters and as many ids each.
FREQUENT = 800_000
# Bytes of texts that are cut together, and distinct units that a task counts before it hands them on.
SLICE_BYTES, COUNTED = 3 << 20, 500_000
# Texts that are cut together, that travel together, and that are decoded together.
TOGETHER, GROUP, ROWS = 32, 64, 128
# Frequent units that are looked up together.
LOOKED_UP = 250_000
# Rows of a piece table that may be sent to every executor.
TABLE_ROWS = 1_000_000


@lru_cache(maxsize=2)
def load(model_path: str | None = None):
    """The model's processor. Default: the public byte-fallback BPE vocabulary with 32,000 pieces."""
    import sentencepiece

    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece.SentencePieceProcessor(model_file=model_path)


def table_of(model_path: str | None = None) -> list[tuple[str, int, float]]:
    """Pieces that can stand in a text: piece, id, score."""
    model = load(model_path)
    return [(model.id_to_piece(i), i, model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def _edges(units: DataFrame, keys: list[str], pieces: DataFrame, longest: int, edge: Column) -> DataFrame:
    """``keys, unit, edges``: the substrings of each unit that are pieces, as sorted structs ``edge`` of ``start``,
    ``length`` and the columns of ``pieces``."""
    size = F.char_length("unit")
    starts = units.select(*keys, "unit", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    spans = starts.select(*keys, "unit", "start", F.explode(F.sequence(F.lit(1), F.least(
        F.lit(longest), size - F.col("start")))).alias("length")).withColumn(
        "piece", F.substring("unit", F.col("start") + 1, F.col("length")))
    # Joined by a number, as lookups of strings take most of the time; each prefix test holds for equal strings alone.
    known = pieces.withColumnRenamed("piece", "known").withColumn("number", F.xxhash64("known"))
    met = spans.withColumn("number", F.xxhash64("piece")).join(F.broadcast(known), "number").where(
        F.startswith("piece", "known") & F.startswith("known", "piece")).select(*keys, "unit", edge.alias("edge"))
    return met.groupBy(*keys, "unit").agg(F.sort_array(F.collect_list("edge")).alias("edges"))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def merge_edge() -> Column:
    """Edge of a merge, the best score first, then leftmost: its ends and the places between them as bits."""
    low, high = _bit(F.col("start")), _bit(F.col("start") + F.col("length"))
    return F.struct((F.col("rank") * 64 + F.col("start")).alias("place"), low.bitwiseOR(high).alias("ends"),
                    (high - low * 2).alias("inner"), "risky")


def _applies(edge: Column, mask: Column) -> Column:
    """Whether an edge covers exactly two symbols."""
    return (mask.bitwiseAND(edge["ends"]) == edge["ends"]) & (F.bit_count(mask.bitwiseAND(edge["inner"])) == 1)


def merged(edges: Column, size: Column) -> Column:
    """Starts of the symbols after all merges, as bits (bit ``size`` is set as well).

    One pass over the edges, best first, is enough unless a merge makes room for an edge that was passed already. Only a
    ``risky`` piece can: one that is half of a piece of a better score. Where that happens, ``merged_in_turns`` decides.
    """
    late = _bit(F.lit(62))

    def step(mask: Column, edge: Column) -> Column:
        new = mask.bitwiseXOR(mask.bitwiseAND(edge["inner"]))
        passed = edge["risky"] & F.exists(edges, lambda e: (e["place"] < edge["place"]) & _applies(e, new))
        return F.when(_applies(edge, mask), F.when(passed, new.bitwiseOR(late)).otherwise(new)).otherwise(mask)

    once = F.aggregate(edges, _bit(size + 1) - 1, step, lambda mask: F.when(mask < late, mask))
    return F.coalesce(once, merged_in_turns(edges, size))


def merged_in_turns(edges: Column, size: Column) -> Column:
    """The same for any order of scores: in every turn the best edge that covers two symbols."""
    def step(mask: Column, _: Column) -> Column:
        best = F.get(F.filter(edges, lambda e: _applies(e, mask)), 0)
        return F.when(best.isNull(), mask).otherwise(mask.bitwiseXOR(mask.bitwiseAND(best["inner"])))

    return F.aggregate(F.sequence(F.lit(1), F.least(F.size(edges), size)), _bit(size + 1) - 1, step)


def best_path(edges: Column, size: Column, unknown: float) -> Column:
    """Starts of the pieces on the path with the highest total score, as bits: Viterbi as a fold over positions.

    ``unknown`` is the score of a character that is no piece.
    """
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(1).cast("long").alias("mask")))

    def step(ways: Column, end: Column) -> Column:
        into = F.transform(F.filter(edges, lambda e: e["end"] == end), lambda e: F.struct(
            (F.get(ways, e["start"])["score"] - e["cost"]).alias("score"),
            F.get(ways, e["start"])["mask"].bitwiseOR(_bit(end)).alias("mask")))
        lone = F.struct((F.get(ways, end - 1)["score"] + F.lit(unknown)).alias("score"),
                        F.get(ways, end - 1)["mask"].bitwiseOR(_bit(end)).alias("mask"))
        has_one = F.exists(edges, lambda e: (e["end"] == end) & (e["start"] == end - 1))
        return F.concat(ways, F.array(F.array_max(F.when(has_one, into).otherwise(F.concat(into, F.array(lone))))))

    return F.get(F.aggregate(F.sequence(F.lit(1), size), start, step), size)["mask"]


class Ids:
    """Ids of segmented units, and the way back."""

    def __init__(self, model_path: str | None):
        model = load(model_path)
        self.ids = {p: i for p, i, _ in table_of(model_path)}
        self.scores = {p: s for p, _, s in table_of(model_path)}
        self.longest = max(map(len, self.ids))
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.texts = [bytes([self.bytes.index(i)]) if model.is_byte(i) else
                      b"" if model.is_control(i) else model.id_to_piece(i).replace(MARK, " ").encode()
                      for i in range(model.get_piece_size())]
        # Characters that stand in pieces of two or more, numbered from 1, and which of them stand side by side.
        letters = sorted({c for p in self.ids if len(p) > 1 for c in p})
        number = {c: i for i, c in enumerate(letters, 1)}
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for p in self.ids:
            for a, b in zip(p, p[1:]):
                self.beside[number[a], number[b]] = True
        self.raw = pa.array(self.texts, pa.large_binary())
        self.names = pa.array(list(self.ids), pa.large_string())
        self.numbers = np.array(list(self.ids.values()), np.int32)

    def units(self, texts: pa.Array) -> tuple[pa.ChunkedArray, np.ndarray]:
        """Units of some texts, in order, and the number of each text's first one (and of the one past the last)."""
        # A few texts at a time, so that the arrays stay small.
        parts, counts = [], []
        for a in range(0, len(texts), TOGETHER):
            marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts.slice(a, TOGETHER).to_pylist()]
            line = "".join(marked)
            letter = self.letter[np.frombuffer(line.encode("utf-32-le"), np.uint32)]
            starts = np.concatenate([[0], np.cumsum([len(t) for t in marked])])
            cut = np.ones(len(letter) + 1, bool)
            cut[1:-1] = ~self.beside[letter[:-1], letter[1:]]
            cut[starts] = True
            at = np.flatnonzero(cut) if len(letter) else np.zeros(1, np.int64)
            parts.append(self._strings(line, at))
            counts.append(np.diff(np.searchsorted(at, starts)))
        return pa.chunked_array(parts, pa.large_string()), np.concatenate([[0], np.cumsum(np.concatenate([[0], *counts])[1:])]).astype(np.int64)

    def of(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            else:
                out += [self.bytes[b] for b in s.encode()]
        return out

    def split(self, units: pa.Array, masks: np.ndarray) -> pa.ListArray:
        """Ids of units that are cut at the bits of ``masks``."""
        texts = units.to_pylist()
        line = "".join(texts)
        sizes = np.array([len(u) for u in texts], np.int64)
        begins = np.cumsum(sizes) - sizes
        place = np.arange(len(line)) - np.repeat(begins, sizes)
        at = np.append(np.flatnonzero(np.repeat(masks, sizes) >> place & 1), len(line))
        symbols = self._strings(line, at)
        found = pc.index_in(symbols, self.names)
        first = np.searchsorted(at, np.append(begins, len(line)))
        if found.null_count:
            lost = np.flatnonzero(np.asarray(found.is_null()))
            spelled = [[self.bytes[b] for b in s.encode()] for s in symbols.take(pa.array(lost)).to_pylist()]
            lengths = np.ones(len(symbols), np.int64)
            lengths[lost] = [len(x) for x in spelled]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            out = np.repeat(self.numbers[np.asarray(found.fill_null(0))], lengths)
            out[_spread(lengths[lost], ends[lost])] = [i for x in spelled for i in x]
            first = ends[first]
        else:
            out = self.numbers[np.asarray(found)]
        return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(out))

    @staticmethod
    def _strings(line: str, at: np.ndarray) -> pa.LargeStringArray:
        """The parts of a string between the characters ``at``, its first and its end among them."""
        codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
        width = 1 + (codes > 0x7F).astype(np.int8) + (codes > 0x7FF) + (codes > 0xFFFF)
        offsets = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[at]
        return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(offsets), pa.py_buffer(line.encode()))

    def long(self, unit: str) -> list[int]:
        """Merges of a long unit, best score and then leftmost first, from a heap."""
        end, before, scores = list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1)), self.scores
        alive, queue = [True] * len(unit), []

        def offer(a: int) -> None:
            b = end[a]
            if b < len(unit):
                score = scores.get(unit[a:end[b]]) if end[b] - a <= self.longest else None
                if score is not None:
                    heapq.heappush(queue, (-score, a, b, end[b]))

        for a in range(len(unit)):
            offer(a)
        while queue:
            _, a, b, to = heapq.heappop(queue)
            if not alive[a] or end[a] != b or not alive[b] or end[b] != to:
                continue
            end[a], alive[b] = to, False
            if to < len(unit):
                before[to] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return self.of([unit[a:end[a]] for a in range(len(unit)) if alive[a]])

@lru_cache(maxsize=2)
def _ids(model_path: str | None) -> Ids:
    return Ids(model_path)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``SLICE_BYTES`` of text, or one longer text."""
    for batch in batches:
        sizes = np.cumsum(np.array(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


def _spread(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of runs of items one behind the other: ``starts[i]`` and the following, ``lengths[i]`` of them."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _laid_out(n: int, *parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, starts and values of ``n`` lists, out of parts of their numbers, sizes and values (the others: empty)."""
    size = np.zeros(n, np.int64)
    for which, sizes, _ in parts:
        size[which] = sizes
    start = np.cumsum(size) - size
    values = np.empty(size.sum(), np.int32)
    for which, sizes, flat in parts:
        values[_spread(sizes, start[which])] = flat
    return size, start, values


def _ends(sizes: np.ndarray) -> np.ndarray:
    """0 and the sums up to each size."""
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return ends


def _part_of(which: np.ndarray, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return which, np.array([len(x) for x in lists], np.int64), np.array([i for x in lists for i in x], np.int32)


def unit_counts(texts: DataFrame, model_path: str | None = None) -> DataFrame:
    """``unit, n``: how often the units of 2 to ``LONGEST`` characters come in ``texts`` (text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(model_path)
        held: list[pa.Table] = []

        def counted() -> pa.Table:
            whole = pa.concat_tables(held).group_by("unit").aggregate([("n", "sum")])
            held[:] = [pa.table({"unit": whole["unit"], "n": whole["n_sum"]})]
            return held[0]

        def sorted_(table: pa.Table) -> Iterator[pa.RecordBatch]:
            # Neighbours that begin alike take less room in the shuffle.
            yield from table.cast(_COUNTS).sort_by("unit").combine_chunks().to_batches(65_536)

        for batch in _slices(batches):
            found = ids.units(batch.column("text"))[0].value_counts()
            table = pa.table({"unit": found.field("values"), "n": found.field("counts")})
            size = pc.utf8_length(table["unit"])
            held.append(table.filter(pc.and_(pc.greater_equal(size, 2), pc.less_equal(size, LONGEST))))
            if sum(t.num_rows for t in held) > COUNTED and counted().num_rows > COUNTED // 2:
                yield from sorted_(held.pop())
        if held:
            yield from sorted_(counted())

    return texts.select("text").mapInArrow(tidy(run), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


_COUNTS = pa.schema([("unit", pa.string()), ("n", pa.int64())])


def _ranked(scores: dict[str, float]) -> list[tuple[str, int, bool]]:
    """``piece, rank, risky`` of the pieces of two or more characters: rank by score, the best first; risky if another
    piece consists of it and one more symbol and its own score is not the better one."""
    ranks = {s: i for i, s in enumerate(sorted({s for s in scores.values()}, reverse=True))}
    risky = set()
    for piece, score in scores.items():
        for m in range(1, len(piece)):
            halves = piece[:m], piece[m:]
            if all(len(h) == 1 or h in scores for h in halves):
                risky.update(h for h in halves if len(h) > 1 and scores[h] <= score)
    return [(p, ranks[s], p in risky) for p, s in scores.items() if len(p) > 1]


def unit_cuts(units: DataFrame, model_path: str | None = None) -> DataFrame:
    """``unit, n, mask`` of distinct units (unit, n) of 2 to ``LONGEST`` characters, by lattice and fold: the starts of its
    pieces as bits. Units without an edge are left out."""
    spark = units.sparkSession
    table = table_of(model_path)
    longest = max(len(p) for p, _, _ in table)
    if len(table) > TABLE_ROWS:
        raise ValueError(f"{len(table)} pieces are too many to send to every executor")
    rows = _ranked({p: s for p, _, s in table})
    pieces = spark.createDataFrame(pa.table(dict(zip(["piece", "rank", "risky"], map(list, zip(*rows)), strict=True))))
    # Dealt by unit once: neither the explosion nor the join with the pieces moves a unit again.
    dealt = units.repartition("unit")
    return _edges(dealt, ["n"], pieces, longest, merge_edge()).select(
        "unit", "n", merged(F.col("edges"), F.char_length("unit")).alias("mask"))


def cut_ids(cuts: DataFrame, model_path: str | None = None) -> DataFrame:
    """``unit, n, ids`` of units that are cut (unit, n, mask)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(model_path)
        for batch in batches:
            found = ids.split(batch.column("unit"), np.asarray(batch.column("mask")))
            yield pa.record_batch([batch.column("unit"), batch.column("n"), found], ["unit", "n", "ids"])

    return cuts.select("unit", "n", "mask").mapInArrow(tidy(run), "unit string, n long, ids array<int>")


def unit_ids(units: DataFrame, model_path: str | None = None) -> DataFrame:
    """``unit, n, ids`` of distinct units (unit, n) of 2 to ``LONGEST`` characters, by lattice and fold."""
    return cut_ids(unit_cuts(units, model_path), model_path)


class Packing:
    """Ids in few bytes, for the way to another task: frequent ids as small numbers."""

    def __init__(self, counts: np.ndarray):
        self.by_rank = np.argsort(-counts, kind="stable").astype(np.int32)
        self.kind = np.uint16 if len(counts) <= 1 << 16 else np.uint32
        self.rank = np.empty(len(counts), self.kind)
        self.rank[self.by_rank] = np.arange(len(counts))

    def pack(self, ids: np.ndarray) -> bytes:
        return zstandard.ZstdCompressor(level=6).compress(self.rank[ids].tobytes())

    def unpack(self, raw: bytes) -> np.ndarray:
        return self.by_rank[np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), self.kind)]


def pack_units(places: np.ndarray, units: pa.StringArray, ends: np.ndarray) -> list[bytes | None]:
    """Units that are left over in some texts, ``ends[i]:ends[i + 1]`` in text i, in few bytes a text (none: null): how many,
    the first bytes of their places and lengths, then the second ones and so on, and the units one behind the other."""
    if not len(units):
        return [None] * (len(ends) - 1)
    _, offsets, data = units.buffers()
    at = np.frombuffer(offsets, np.int32)[units.offset:units.offset + len(units) + 1]
    data = data.to_pybytes() if data is not None else b""
    numbers = np.stack([places, np.diff(at)]).astype(np.uint32)
    packer = zstandard.ZstdCompressor(level=3, write_checksum=False)
    return [packer.compress((b - a).to_bytes(4, "little") + numbers[:, a:b].copy().view(np.uint8).reshape(-1, 4).T.tobytes()
                            + data[at[a]:at[b]]) if b > a else None for a, b in zip(ends.tolist(), ends[1:].tolist())]


def unpack_units(raw: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Places, lengths and bytes of the units of one text."""
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = int.from_bytes(raw[:4], "little")
    numbers = np.frombuffer(raw, np.uint8, 8 * n, 4).reshape(4, -1).T.copy().view(np.uint32)[:, 0].astype(np.int64)
    return numbers[:n], numbers[n:], raw[4 + 8 * n:]


def _left_over(raw: bytes) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Places of units, and the units: each distinct one has a number, in the order of their first places."""
    places, lengths, data = unpack_units(raw)
    units = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(_ends(lengths).astype(np.int32)), pa.py_buffer(data))
    return places, units.dictionary_encode()


def _table_bytes(units: pa.Table) -> bytes:
    """Units and their ids in one piece."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, units.schema) as out:
        out.write_table(units.combine_chunks(), max_chunksize=max(1, len(units)))
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def _table_of(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(raw)).read_all().combine_chunks()


def _index_in(values: pa.Array, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is among ``names``, and where; some names at a time, as each call builds a hash table of them."""
    met, place = np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    for a in range(0, len(names), LOOKED_UP):
        found = pc.index_in(values, names.slice(a, LOOKED_UP))
        here = np.asarray(found.is_valid())
        place[here] = np.asarray(found.drop_null()) + a
        met |= here
    pa.default_memory_pool().release_unused()
    return met, place


def half_encoded(texts: DataFrame, sent: Broadcast, model_path: str | None = None) -> DataFrame:
    """Groups of up to ``GROUP`` neighbouring texts (doc_id, text), encoded but for the units that ``sent`` does not hold.

    ``row`` is the group's number, ``doc_ids``, ``sizes`` (how many ids) and ``lefts`` (how many units without) have an
    item per text, ``packed`` are the ids one text behind the other, ``left`` the units left over and their places among
    these ids (none: null). ``sent`` has the table of units and ids as bytes, and a ``Packing``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, (raw, packing) = _ids(model_path), sent.value
        table = _table_of(raw)
        names, lists = (table[c].chunk(0) if len(table) else pa.array([], table.schema.field(c).type) for c in ("unit", "ids"))
        first, flat = np.asarray(lists.offsets), np.asarray(lists.values)
        for batch in _slices(batches):
            units, begins = ids.units(batch.column("text"))
            units = units.cast(names.type).dictionary_encode().combine_chunks()
            distinct, code = units.dictionary, np.asarray(units.indices)
            met, place = _index_in(distinct, names)
            # Single characters and long units are not among the ways; units without an edge are not, either: the join
            # has no cuts of them, and they are spelled out behind it.
            length = np.asarray(pc.utf8_length(distinct))
            here = np.flatnonzero(~met & ((length == 1) | (length > LONGEST)))
            spelled = [ids.of([u]) if len(u) == 1 else ids.long(u) for u in distinct.take(pa.array(here)).to_pylist()]
            there = np.flatnonzero(met)
            sizes = (first[place[there] + 1] - first[place[there]]).astype(np.int64)
            size, start, values = _laid_out(
                len(distinct), (there, sizes, flat[_spread(sizes, first[place[there]])]), _part_of(here, spelled))
            open_ = ~met
            open_[here] = False
            behind = _ends(size[code])
            rest = np.flatnonzero(open_[code])
            heads = np.append(np.arange(0, batch.num_rows, GROUP), batch.num_rows)
            packed = []
            for a, b in zip(begins[heads], begins[heads[1:]]):
                some = code[a:b]
                packed.append(packing.pack(values[_spread(size[some], start[some])]))
            group = np.searchsorted(begins[heads], rest, "right") - 1
            left = pack_units(behind[rest] - behind[begins[heads]][group],
                              distinct.take(pa.array(code[rest])).cast(pa.string()), np.searchsorted(rest, begins[heads]))
            items = pa.array(heads.astype(np.int32))
            yield pa.record_batch([
                batch.column("row").take(pa.array(heads[:-1])),
                pa.ListArray.from_arrays(items, batch.column("doc_id")),
                pa.ListArray.from_arrays(items, pa.array(np.diff(behind[begins]).astype(np.int32))),
                pa.ListArray.from_arrays(items, pa.array(np.diff(np.searchsorted(rest, begins)).astype(np.int32))),
                pa.array(packed, pa.binary()), pa.array(left, pa.binary())],
                ["row", "doc_ids", "sizes", "lefts", "packed", "left"])

    return texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        tidy(run), "row long, doc_ids array<long>, sizes array<int>, lefts array<int>, packed binary, left binary")


def left_over(half: DataFrame) -> DataFrame:
    """``row, number, unit``: the distinct units that are left over in each group of ``half``."""
    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("left").is_valid())
            units = [_left_over(x)[1].dictionary for x in batch.column("left").to_pylist()]
            sizes = np.array([len(u) for u in units], np.int64)
            yield pa.record_batch([
                pa.array(np.repeat(np.asarray(batch.column("row")), sizes)),
                pa.array(_spread(sizes, np.zeros(len(sizes), np.int64)).astype(np.int32)),
                pa.concat_arrays([pa.array([], pa.string()), *units])], ["row", "number", "unit"])

    return half.mapInArrow(unfold, "row long, number int, unit string")


def encode(docs: DataFrame, model_path: str | None = None, back: bool = False) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs`` (doc_id, text and any other columns), for a vocabulary of the BPE kind.

    Null and empty texts have no ids. Texts of any length are encoded whole. Repeated rows give repeated results, rows
    without doc_id are encoded like any other, an empty table gives an empty result. Extra columns are not read. With
    ``back`` the ids are decoded in the same tasks, as by ``decode`` (column ``text``): that takes fewer Python workers.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = stored(unit_cuts(unit_counts(texts, model_path), model_path), "units", compression="zstd")
    often = F.floor(F.log2("n") * 16)
    # At most 1,024 rows: how many units come about so often.
    sizes = known.groupBy(often.alias("often")).count().orderBy(F.desc("often")).collect()
    least, room = 1024, FREQUENT
    for size in sizes:
        room -= size["count"]
        if room < 0:
            break
        least = size["often"]
    frequent = cut_ids(known.where(often >= least), model_path).toArrow()
    lists = frequent["ids"].combine_chunks()
    packing = Packing(np.bincount(np.asarray(pc.list_flatten(lists)), np.repeat(
        np.asarray(frequent["n"]), np.asarray(pc.list_value_length(lists))), len(_ids(model_path).texts)))
    sent = spark.sparkContext.broadcast((_table_bytes(frequent.select(["unit", "ids"])), packing))
    del frequent, lists
    # Moved once: both uses below take all columns, so that they share the exchange.
    half = half_encoded(texts, sent, model_path).repartition("row")
    rare = known.where(often < least).select("unit", "mask")
    # Only numbers and cuts go back to the texts, which still hold places and units.
    found = left_over(half).join(rare, "unit").groupBy("row").agg(F.collect_list(F.struct("number", "mask")).alias("found"))
    whole = half.join(found, "row", "left")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(model_path)
        packing = sent.value[1]
        none = np.empty(0, np.int64), pa.array([], pa.string()).dictionary_encode()
        for batch in batches:
            left = [none if x is None else _left_over(x) for x in batch.column("left").to_pylist()]
            firsts = _ends(np.array([len(u.dictionary) for _, u in left], np.int64))
            units = pa.concat_arrays([pa.array([], pa.string()), *(u.dictionary for _, u in left)])
            mask = np.zeros(len(units), np.int64)
            found = batch.column("found")
            numbers, masks = pc.list_flatten(found).flatten()
            met = np.repeat(firsts[:-1], np.asarray(pc.fill_null(pc.list_value_length(found), 0)))
            mask[met + np.asarray(numbers)] = np.asarray(masks)
            cut, lost = np.flatnonzero(mask), np.flatnonzero(mask == 0)
            lists = ids.split(units.take(pa.array(cut)), mask[cut])
            size, start, values = _laid_out(
                len(units), (cut, np.asarray(pc.list_value_length(lists)), np.asarray(lists.values)),
                _part_of(lost, [ids.of(list(u)) for u in units.take(pa.array(lost)).to_pylist()]))
            for i, (places, codes) in enumerate(left):
                out = packing.unpack(batch.column("packed")[i].as_py())
                code = np.asarray(codes.indices) + firsts[i]
                out = np.insert(out, np.repeat(places, size[code]), values[_spread(size[code], start[code])])
                # Units at the end of a text and at the start of the next have one place: their numbers tell them apart.
                offsets = _ends(batch.column("sizes")[i].values) + _ends(size[code])[_ends(batch.column("lefts")[i].values)]
                yield pa.record_batch([batch.column("doc_ids")[i].values, pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(out))], ["doc_id", "ids"])

    if back:
        return whole.mapInArrow(tidy(lambda batches: _decoded(fill(batches), model_path)),
                                "doc_id long, ids array<int>, text string")
    return whole.mapInArrow(tidy(fill), "doc_id long, ids array<int>")


def _decoded(batches: Iterator[pa.RecordBatch], model_path: str | None) -> Iterator[pa.RecordBatch]:
    raw = _ids(model_path).raw
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            lists = part.column("ids")
            values = pc.list_flatten(lists)
            ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
            _, offsets, data = raw.take(values).buffers()
            data = data.to_pybytes() if data is not None else b""
            places = np.frombuffer(offsets, np.int64)[np.concatenate([[0], ends])] if len(values) else (
                np.zeros(part.num_rows + 1, np.int64))
            texts = [data[a:b].decode("utf-8", "replace")[1:] for a, b in zip(places, places[1:])]
            yield pa.record_batch([part.column("doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """``doc_id, ids, text`` of rows of ids; bytes that are no UTF-8 become replacement characters."""
    return encoded.select("doc_id", "ids").mapInArrow(
        tidy(lambda batches: _decoded(batches, model_path)), "doc_id long, ids array<int>, text string")
