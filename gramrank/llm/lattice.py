"""SentencePiece encoding and decoding on tables.

A text falls into units that no piece reaches across: it is cut between two characters
that are neighbours in no piece. Documents are read in blocks. A block sends each
of its different units once, and every different unit of all blocks is encoded once: its
substrings of at most the longest piece's length are exploded and equi-joined to the piece
table; the edges found are grouped by unit, and a higher-order aggregate folds them. The
ids go back to the blocks, where they meet the texts again.

For a unigram model the fold is Viterbi's, the path of the best total score. The model
at hand is a byte-pair model, for which that path is not the library's result. There the
fold merges: it starts from single characters and in each step removes the boundary
whose two neighbours span the edge of the best score, the leftmost of equals.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramrank.llm import textarrays as T
from gramrank.llm.language_model import code_points
from gramrank.session import new_shared_path

BLANK = "▁"
#: Characters of a unit up to which it goes through the lattice. The fold's cost grows
#: with the cube of the length, so a longer unit is merged by a heap in a task instead.
#: The boundaries of a unit are bits of one number, which sets a limit of 62.
LONGEST_UNIT = 40
#: Bytes of text whose units are numbered together, at least, if a task has as many.
BLOCK_BYTES = 32 << 20

#: A unit of a block with its code, or the block's texts as codes.
BLOCKS = "block long, unit string, code int, texts binary, codes binary"
#: Where a unit stands.
PLACES = "array<struct<block:long,code:int>>"
#: Ids of some units of a block.
ANSWERS = "block long, codes binary, sizes binary, ids binary"

#: Documents of a block that get their ids at a time.
SLICE = 1000
#: Bits of an id; those above have the place of the edge.
ID_BITS = 32
#: Set beside the boundaries if a merge should have come earlier.
_TOO_LATE = 1 << 62


@dataclass(frozen=True)
class Model:
    """Pieces of a SentencePiece file: ``pieces`` are ``(text, id, score)`` of those that
    stand for text, ``spelled`` the bytes of every id, ``byte_ids`` the ids of bytes."""

    pieces: tuple[tuple[str, int, float], ...]
    spelled: tuple[bytes, ...]
    byte_ids: tuple[int, ...]
    merges: bool

    @property
    def longest(self) -> int:
        return max(len(piece) for piece, _, _ in self.pieces)

    def pairs(self) -> frozenset[str]:
        """Characters that stand side by side in a piece."""
        return frozenset(
            piece[i : i + 2] for piece, _, _ in self.pieces for i in range(len(piece) - 1)
        )

    def late(self) -> frozenset[str]:
        """Pieces with two parts of which one may be merged after the piece's own turn."""
        score = {piece: score for piece, _, score in self.pieces}

        def turn(part: str) -> float:
            return score.get(part, float("inf")) if len(part) > 1 else float("inf")

        def joins(part: str) -> bool:
            return len(part) == 1 or part in score

        return frozenset(
            piece
            for piece in score
            if any(
                min(turn(piece[:i]), turn(piece[i:])) <= score[piece]
                for i in range(1, len(piece))
                if joins(piece[:i]) and joins(piece[i:])
            )
        )


def load_model(path: str) -> Model:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, spelled, byte_ids = [], [], {}
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
            spelled.append(bytes([int(text[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            spelled.append(b"")
        else:
            pieces.append((text, i, float(model.get_score(i))))
            spelled.append(text.replace(BLANK, " ").encode("utf-8"))
    if len(byte_ids) != 256:
        raise ValueError("the model has no piece for every byte")
    # a byte-pair model's scores are its merges' numbers, from 0 down in whole steps
    merges = all(score == int(score) for _, _, score in pieces)
    return Model(tuple(pieces), tuple(spelled), tuple(byte_ids[b] for b in range(256)), merges)


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """``[piece, id, score, late]``, and a piece without characters, which every unit has."""
    late = model.late()
    rows = [(piece, i, score, piece in late) for piece, i, score in model.pieces]
    return spark.createDataFrame(
        [("", -1, 0.0, False), *rows], "piece string, id int, score double, late boolean"
    ).coalesce(1)


def mark_blanks(text: Column) -> Column:
    """A text with a blank before it and U+2581 for blanks; empty for an empty or null one."""
    marked = F.concat(F.lit(BLANK), F.replace(text, F.lit(" "), F.lit(BLANK)))
    return F.when(F.length(text) > 0, marked).otherwise("")


@functools.cache
def _neighbours(pairs: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every code point, 0 for those in no pair; whether two numbers are a
    pair."""
    chars = sorted({c for pair in pairs for c in pair})
    number = np.zeros(0x110000, dtype=np.int32)
    number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
    joined = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
    for a, b in pairs:
        joined[number[ord(a)], number[ord(b)]] = True
    return number, joined


def split_units(texts: T.Texts, pairs: frozenset[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The units of texts in order, which leave nothing out, and how many each text has."""
    number, joined = _neighbours(pairs)
    lead = np.flatnonzero((texts.data & 0xC0) != 0x80)
    char = number[code_points(texts.data)]
    starts = np.ones(len(lead) + 1, dtype=bool)
    starts[1:-1] = ~joined.ravel()[char[:-1] * len(joined) + char[1:]]
    starts[np.searchsorted(lead, texts.bounds)] = True
    at = np.append(lead, len(texts.data))[starts]
    units = pa.StringArray.from_buffers(
        len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(texts.data)
    )
    return units, np.diff(np.searchsorted(at, texts.bounds))


def edges_of(units: DataFrame, pieces: DataFrame, shortest: int, longest: int) -> DataFrame:
    """``[unit, places, edges]``: the pieces of ``shortest`` to ``longest`` characters
    found in each unit. ``part`` has an edge's place and id, ``ends`` the bits of its two
    boundaries, ``inner`` of those between; the best score comes first, then the leftmost
    edge. ``places`` go with the empty piece, not with each substring."""
    n = F.length("unit")
    starts = F.transform(
        F.sequence(F.lit(-1), n - shortest),
        lambda s: F.struct(s.alias("start"), F.when(s < 0, F.col("places")).alias("places")),
    )
    sizes = F.when(F.col("start") < 0, F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(shortest), F.least(F.lit(longest), n - F.col("start")))
    )
    substrings = (
        units.select("unit", F.inline(starts))
        .select("*", F.explode(sizes).alias("size"))
        .withColumn("piece", F.expr("substring(unit, start + 1, size)"))
    )
    low, high = F.expr("shiftleft(1L, start)"), F.expr("shiftleft(1L, start + size)")
    edge = F.struct(
        (-F.col("score")).alias("cost"),
        _part(F.col("start"), F.col("id")).alias("part"),
        "late",
        (low + high).alias("ends"),
        (high - low - low).alias("inner"),
    )
    return (
        substrings.join(F.broadcast(pieces), "piece")
        # rows are sorted by the number first
        .groupBy(F.xxhash64("unit"), "unit")
        .agg(
            F.first("places", ignorenulls=True).alias("places"),
            F.sort_array(F.collect_list(F.when(F.col("size") > 0, edge))).alias("edges"),
        )
        .select("unit", "places", "edges")
    )


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _part(place: Column, number: Column) -> Column:
    return place.cast("long") * (1 << ID_BITS) + number


def _is_part(bounds: Column, edge: Column) -> Column:
    inside = edge["ends"].bitwiseOR(edge["inner"])
    return bounds.bitwiseAND(inside) == edge["ends"]


def _joins(bounds: Column, edge: Column) -> Column:
    """Whether both ends of the edge are boundaries, with one more between."""
    return (bounds.bitwiseAND(edge["ends"]) == edge["ends"]) & (
        F.bit_count(bounds.bitwiseAND(edge["inner"])) == 1
    )


def fold_in_turn(unit: Column, edges: Column) -> Column:
    """Boundaries left after all merges of a byte-pair model, as bits, with one look at
    each edge; marked if a merge made another one possible whose turn was over."""
    late = F.filter(edges, lambda e: e["late"])

    def step(bounds: Column, edge: Column) -> Column:
        merged = bounds.bitwiseAND(F.bitwise_not(edge["inner"]))
        missed = F.exists(late, lambda e: (e["cost"] <= edge["cost"]) & _joins(merged, e))
        mark = F.when(missed, F.lit(_TOO_LATE)).otherwise(F.lit(0).cast("long"))
        return F.when(_joins(bounds, edge), merged.bitwiseOR(mark)).otherwise(bounds)

    return F.aggregate(edges, _bit(F.length(unit) + 1) - 1, step)


def fold_merges(unit: Column, edges: Column) -> Column:
    """Boundaries left after all merges of a byte-pair model, as bits."""

    def step(bounds: Column, _: Column) -> Column:
        ways = F.filter(edges, lambda e: _joins(bounds, e))
        merged = F.coalesce(F.get(ways, F.lit(0))["inner"], F.lit(0).cast("long"))
        return bounds.bitwiseAND(F.bitwise_not(merged))

    return F.aggregate(edges, _bit(F.length(unit) + 1) - 1, step)


def fold_viterbi(unit: Column, edges: Column) -> Column:
    """Boundaries of the path of the best total score, as bits; characters without a piece
    cost ten more than the worst score."""
    worst = F.coalesce(F.array_min(F.transform(edges, lambda e: -e["cost"])), F.lit(0.0)) - 10
    none = F.array(
        F.struct(F.lit(0.0).alias("score"), F.array(F.lit(0)).alias("bounds"))
    )

    def start(edge: Column) -> Column:
        return F.shiftright(edge["part"], ID_BITS).cast("int")

    def step(best: Column, end: Column) -> Column:
        last = F.element_at(best, -1)
        single = F.struct(
            (last["score"] + worst).alias("score"),
            F.concat(last["bounds"], F.array(end)).alias("bounds"),
        )
        ways = F.transform(
            F.filter(edges, lambda e: start(e) + F.bit_count(e["inner"]) + 1 == end),
            lambda e: F.struct(
                (F.element_at(best, start(e) + 1)["score"] - e["cost"]).alias("score"),
                F.concat(F.element_at(best, start(e) + 1)["bounds"], F.array(end)).alias("bounds"),
            ),
        )
        return F.concat(best, F.array(F.array_max(F.concat(ways, F.array(single)))))

    all_best = F.aggregate(F.sequence(F.lit(1), F.length(unit)), none, step)
    return F.aggregate(
        F.element_at(all_best, -1)["bounds"],
        F.lit(0).cast("long"),
        lambda bits, place: bits + _bit(place),
    )


def _byte_ids(char: Column, byte_ids: tuple[int, ...]) -> Column:
    code = F.hex(F.encode(char, "utf-8"))
    places = F.sequence(F.lit(1), F.length(code), F.lit(2))
    table = F.array(*[F.lit(i) for i in byte_ids])
    return F.transform(
        places,
        lambda p: F.element_at(
            table, F.conv(F.substring(code, p, F.lit(2)), 16, 10).cast("int") + 1
        ),
    )


def encode_units(units: DataFrame, model: Model) -> DataFrame:
    """``[unit, places, ids]`` of each of ``units``: ``unit`` and, if there are any, the
    ``places`` where it stands. No unit comes twice."""
    spark = units.sparkSession
    if "places" not in units.columns:
        units = units.withColumn("places", F.array().cast(PLACES))
    short = units.where(F.length("unit") <= LONGEST_UNIT)
    shortest = 2 if model.merges else 1
    longest = max(shortest, model.longest)
    lattice = edges_of(short, piece_table(spark, model), shortest, longest)
    unit, edges, bounds = F.col("unit"), F.col("edges"), F.col("bounds")
    if model.merges:
        folded = lattice.withColumn("bounds", fold_in_turn(unit, edges))
        marked = bounds.bitwiseAND(F.lit(_TOO_LATE)) != 0
        folded = folded.withColumn(
            "bounds", F.when(marked, fold_merges(unit, edges)).otherwise(bounds)
        )
    else:
        folded = lattice.withColumn("bounds", fold_viterbi(unit, edges))
    done = folded.select("unit", "places", _ids(model).alias("ids"))
    return done.unionByName(_encode_long(units.where(F.length("unit") > LONGEST_UNIT), model))


def _ids(model: Model) -> Column:
    """Ids of the pieces between ``bounds``, or of the bytes of characters that are none."""
    by_char = {ord(piece): i for piece, i, _ in model.pieces if len(piece) == 1}
    listed = ",".join(str(by_char.get(code, -1)) for code in range(max(by_char, default=0) + 1))
    table = F.split(F.lit(listed), ",").cast("array<int>")
    bounds, none = F.col("bounds"), (1 << ID_BITS) - 1
    alone = bounds.bitwiseAND(F.shiftright(bounds, 1))

    def char(place: Column) -> Column:
        return F.substring(F.col("unit"), place + 1, F.lit(1))

    def of_char(place: Column) -> Column:
        found = F.get(table, F.ascii(char(place)))
        return _part(place, F.when(found >= 0, found).otherwise(F.lit(none)))

    joined = F.transform(
        F.filter("edges", lambda e: (e["inner"] > 0) & _is_part(bounds, e)), lambda e: e["part"]
    )
    places = F.sequence(F.lit(0), F.length("unit") - 1)
    chars = F.transform(
        F.filter(places, lambda i: alone.bitwiseAND(_bit(i)) != 0), of_char
    )
    parts = F.sort_array(F.when(alone == 0, joined).otherwise(F.concat(joined, chars)))
    number = lambda part: part.bitwiseAND(F.lit(none))
    spelled = F.flatten(
        F.transform(
            parts,
            lambda p: F.when(number(p) != none, F.array(number(p).cast("int"))).otherwise(
                _byte_ids(char(F.shiftright(p, ID_BITS).cast("int")), model.byte_ids)
            ),
        )
    )
    return (
        F.when(F.exists(parts, lambda p: number(p) == none), spelled)
        .otherwise(F.transform(parts, lambda p: number(p).cast("int")))
        .cast("array<int>")
    )


def merge_long(unit: str, scores: dict[str, tuple[int, float]], byte_ids: tuple[int, ...]) -> list:
    """Ids of a unit of any length: the same merges, the next one taken from a heap."""
    right = list(range(1, len(unit) + 1))
    left = list(range(-1, len(unit) - 1))
    parts = list(unit)
    heap: list = []

    def offer(i: int) -> None:
        j = right[i] if 0 <= i else len(unit)
        if 0 <= i and j < len(unit) and (found := scores.get(parts[i] + parts[j])):
            heapq.heappush(heap, (-found[1], i, j, parts[i] + parts[j]))

    for i in range(len(unit) - 1):
        offer(i)
    while heap:
        _, i, j, joined = heapq.heappop(heap)
        if not parts[i] or right[i] != j or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j] = joined, ""
        right[i] = right[j]
        if right[i] < len(unit):
            left[right[i]] = i
        offer(left[i])
        offer(i)
    ids = []
    for part in filter(None, parts):
        found = scores.get(part)
        ids += [found[0]] if found else [byte_ids[b] for b in part.encode("utf-8")]
    return ids


def _encode_long(units: DataFrame, model: Model) -> DataFrame:
    scores = {piece: (i, score) for piece, i, score in model.pieces}
    byte_ids = model.byte_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [merge_long(u.as_py(), scores, byte_ids) for u in batch["unit"]]
            yield batch.append_column("ids", pa.array(ids, pa.list_(pa.int32())))

    found = units.select("unit", "places")
    return found.mapInArrow(encode, f"unit string, places {PLACES}, ids array<int>")


def _planes(numbers: np.ndarray) -> bytes:
    """Whole numbers byte by byte, the lowest of all first: the higher ones pack well."""
    return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def _write(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _read(packed: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(packed.as_buffer()).read_all()


class _Block:
    """Documents of a block and their units so far."""

    def __init__(self) -> None:
        self.size = 0
        self.ids: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.units: list[pa.StringArray] = []

    def add(self, texts: T.Texts, doc_id: pa.Array, pairs: frozenset[str]) -> None:
        units, counts = split_units(texts, pairs)
        self.ids.append(doc_id)
        self.counts.append(counts)
        self.units.append(units)
        self.size += len(texts.data)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """A row for each different unit, by name, the frequent ones with the smallest
        codes; a row with the documents."""
        coded = pa.chunked_array(self.units).dictionary_encode()
        self.units = []
        names = coded.chunk(coded.num_chunks - 1).dictionary
        index = np.concatenate([chunk.indices.to_numpy() for chunk in coded.chunks])
        del coded
        order = np.argsort(-np.bincount(index, minlength=len(names)), kind="stable")
        code = np.empty(len(order), dtype=np.int32)
        code[order] = np.arange(len(order))
        index = code[index]
        texts = {"doc_id": pa.concat_arrays(self.ids), "n": np.concatenate(self.counts)}
        codes = {"codes": np.frombuffer(_planes(index), dtype=np.uint8)}
        del index
        packed = [pa.array([_write(pa.record_batch(part))]) for part in (texts, codes)]
        del texts, codes
        yield self._batch(number, pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), *packed)
        by_name = pc.array_sort_indices(names)
        none = pa.nulls(len(names), pa.binary())
        yield self._batch(number, names.take(by_name), pa.array(code).take(by_name), none, none)

    @staticmethod
    def _batch(number: int, *parts: pa.Array) -> pa.RecordBatch:
        names = [part.split()[0] for part in BLOCKS.split(", ")]
        return pa.record_batch([np.full(len(parts[0]), number), *parts], names=names)


def read_blocks(docs: DataFrame, model: Model) -> DataFrame:
    """Blocks of ``docs`` (``doc_id``, ``text`` with marked blanks): a row for each
    different unit of a block, and a row with the block's documents."""
    pairs = model.pairs()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = None
        for batch in batches:
            for texts in T.chunks(batch["text"]):
                block = block or _Block()
                block.add(texts, batch["doc_id"].slice(texts.first, len(texts)), pairs)
                if block.size >= BLOCK_BYTES:
                    yield from block.rows(number)
                    number, block = number + 1, None
                    pa.default_memory_pool().release_unused()
        if block:
            yield from block.rows(number)
        block = None
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(cut, BLOCKS)


def answers_of(encoded: DataFrame) -> DataFrame:
    """Ids of units by block, those of a task together: ``encoded`` has ``places, ids``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, code = (batch[name].to_numpy() for name in ("block", "code"))
            ids, sizes = batch["ids"], batch["sizes"].to_numpy()
            values, ends = ids.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))
            first = np.flatnonzero(np.diff(block, prepend=-1))
            last = np.append(first[1:], len(block))
            rows = [
                (
                    int(block[low]),
                    _planes(code[low:high]),
                    _planes(sizes[low:high]),
                    _planes(values[ends[low] : ends[high]]),
                )
                for low, high in zip(first, last, strict=True)
            ]
            names = [part.split()[0] for part in ANSWERS.split(", ")]
            yield pa.record_batch([pa.array(x) for x in zip(*rows, strict=True)], names=names)

    found = encoded.select(F.explode("places").alias("place"), "ids")
    found = found.select("place.block", "place.code", "ids", F.size("ids").alias("sizes"))
    return found.sortWithinPartitions("block").mapInArrow(pack, ANSWERS)


def join_ids(blocks: DataFrame, answers: DataFrame, id_type: str) -> DataFrame:
    """``[doc_id, ids]`` of the texts of all blocks."""

    def spell(texts: pa.Table, answered: pa.Table) -> pa.Table:
        code, sizes, ids = (
            np.concatenate(
                [
                    np.zeros(0, np.int32),
                    *(_numbers(np.frombuffer(x.as_buffer(), np.uint8)) for x in answered[name]),
                ]
            )
            for name in ("codes", "sizes", "ids")
        )
        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        by_unit = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
        by_code = by_unit.take(pa.array(np.argsort(code)))
        docs = _read(texts["texts"][0])
        planes = _read(texts["codes"][0])["codes"].chunk(0).to_numpy().reshape(4, -1)
        counts, low = docs["n"].to_numpy(), 0
        by_text = []
        for first in range(0, len(counts), SLICE):
            bounds = np.concatenate(([0], np.cumsum(counts[first : first + SLICE])))
            found = by_code.take(pa.array(_numbers(planes[:, low : low + bounds[-1]])))
            ends = pa.array(found.offsets.to_numpy()[bounds])
            by_text.append(pa.ListArray.from_arrays(ends, found.values))
            low += bounds[-1]
        del by_unit, by_code, planes
        pa.default_memory_pool().release_unused()
        by_text = pa.chunked_array(by_text)
        return pa.table({"doc_id": docs["doc_id"], "ids": by_text})

    texts = blocks.where("texts is not null").select(
        F.col("block").alias("of_block"), "texts", "codes"
    )
    return (
        texts.groupBy("of_block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(spell, f"doc_id {id_type}, ids array<int>")
    )


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """``[doc_id, ids]`` for each of ``docs`` (``doc_id``, ``text``; other columns are
    ignored), the ids the library gives. An empty or null text has none. A literal
    U+2581 counts as a blank. Rows that repeat an id are encoded each for itself; an
    empty table gives no rows."""
    spark = docs.sparkSession
    # in buckets by block, so that the texts, written once, are not shuffled as well
    path = new_shared_path(spark, "lattice-blocks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = docs.select("doc_id", mark_blanks(F.col("text")).alias("text"))
    writer = read_blocks(marked, model).write.bucketBy(buckets, "block").format("parquet")
    writer.option("compression", "zstd").option("path", path).saveAsTable(name)
    blocks = spark.table(name)
    units = blocks.where("unit is not null").repartition(buckets, "unit")
    places = F.collect_list(F.struct("block", "code")).cast(PLACES).alias("places")
    encoded = encode_units(units.groupBy("unit").agg(places), model)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = join_ids(blocks, answers_of(encoded), id_type)
    spark.sql(f"drop table {name}")  # its files stay
    return found


def decode(ids: Column, model: Model) -> Column:
    """The text of an array of ids, without the blank that opens it."""
    spelled = F.split(F.lit(",".join(b.hex() for b in model.spelled)), ",")
    code = F.array_join(F.transform(ids, lambda i: F.element_at(spelled, i + 1)), "")
    text = F.decode(F.unhex(code), "utf-8")
    return F.when(F.startswith(text, F.lit(" ")), F.substr(text, F.lit(2))).otherwise(text)
