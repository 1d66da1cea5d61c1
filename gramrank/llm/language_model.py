"""Modified Kneser-Ney model of order four over code points, one for each language.

It grows with the corpus: its n-grams are rows of tables, hashed with their language to
64 bits, and no task or driver holds them all. Documents are read in blocks. A block
adds up its own n-grams before the shuffle, and asks for each of its different ones
once, by an equi-join on the hash, so that a frequent n-gram has at most one row a block
there; what comes back meets the texts of the block again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramrank.llm import textarrays as T

ORDER = 4
#: Bits of a code point.
BITS = 21
#: Bytes of text whose n-grams are counted together, at least, if a task has as many.
BLOCK_BYTES = 32 << 20
CHUNK_BYTES = 1 << 20

BLOCKS = "block long, key long, lang_key long, a int, b int, c int, d int, n long, docs binary"

_IS_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])


def lang_key(lang: Column) -> Column:
    return F.xxhash64(F.coalesce(lang.cast("string"), F.lit("")))


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 bytes."""
    lead = np.flatnonzero(_IS_LEAD[data])
    points = data[lead].astype(np.int32)
    for least, size in ((0xC0, 2), (0xE0, 3), (0xF0, 4)):
        mine = np.flatnonzero((points >= least) & (data[lead] >= least))
        if size < 4:
            mine = mine[data[lead[mine]] < (0xE0 if size == 2 else 0xF0)]
        value = data[lead[mine]].astype(np.int32) & (0x7F >> size)
        for place in range(1, size):
            value = value << 6 | (data[lead[mine] + place] & 0x3F)
        points[mine] = value
    return points


def gram_keys(
    texts: T.Texts, langs: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts, in order, and their bounds by text; symbols and
    where in them each n-gram ends. A symbol is a code point and one, 0 the edge, which
    stands three times before a text and once after it. ``langs`` has a key a text."""
    sizes = texts.sums(_IS_LEAD[texts.data])
    bounds = np.concatenate(([0], np.cumsum(sizes + ORDER)))
    symbols = np.zeros(bounds[-1], dtype=np.int32)
    place = np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)), sizes) * ORDER + 3
    symbols[place] = code_points(texts.data) + 1
    inside = np.ones(len(symbols), dtype=bool)
    for edge in range(ORDER - 1):
        inside[bounds[:-1] + edge] = False
    ends = np.flatnonzero(inside)
    wide = symbols.astype(np.uint64)
    pairs = wide[:-1] << np.uint64(BITS) | wide[1:]
    lang = np.repeat(langs.astype(np.int64).view(np.uint64), sizes + 1)
    keys = T.mix(T.mix(pairs[ends - 3] ^ lang) ^ pairs[ends - 1]).view(np.int64)
    return keys, np.concatenate(([0], np.cumsum(sizes + 1))), symbols, ends


class _Block:
    """Documents of a block, compressed, and its different n-grams so far."""

    def __init__(self, schema: pa.Schema) -> None:
        self.size = 0
        self.sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        self.docs = pa.ipc.new_stream(self.sink, schema, options=options)
        self.grams: list[tuple[np.ndarray, ...]] = []

    def add(self, texts: T.Texts, docs: pa.RecordBatch) -> None:
        langs = docs["lang_key"].to_numpy(zero_copy_only=False)
        keys, bounds, symbols, ends = gram_keys(texts, langs)
        key, at, n = np.unique(keys, return_index=True, return_counts=True)
        of_text = np.searchsorted(bounds, at, side="right") - 1
        last = ends[at]
        self.grams.append(
            (key, n, langs[of_text], *(symbols[last - back] for back in (3, 2, 1, 0)))
        )
        if len(self.grams) > 8:
            self.grams = [self.merged()]
        self.docs.write_batch(docs)
        self.size += len(texts.data)

    def merged(self) -> tuple[np.ndarray, ...]:
        key, n, *others = (np.concatenate(part) for part in zip(*self.grams, strict=True))
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
        at = order[first]
        return key[at], np.add.reduceat(n[order], first), *(part[at] for part in others)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        key, n, *others = self.merged()
        yield _batch(block, key, *others, n, None)
        self.docs.close()
        yield _batch(block, *[None] * 7, self.sink.getvalue().to_pybytes())


_TYPES = [pa.int64()] * 3 + [pa.int32()] * 4 + [pa.int64(), pa.binary()]
_NAMES = [part.split()[0] for part in BLOCKS.split(", ")]


def _batch(block: int, *parts) -> pa.RecordBatch:
    n = 1 if parts[0] is None else len(parts[0])
    key, *others = parts
    columns = [
        pa.array(np.full(n, block)),
        *(
            pa.nulls(n, kind)
            if part is None
            else pa.array([part], kind)
            if isinstance(part, bytes)
            else pa.array(part, kind)
            for part, kind in zip((key, *others), _TYPES[1:], strict=True)
        ),
    ]
    return pa.record_batch(columns, names=_NAMES)


def read_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of ``docs`` (``doc_id, lang, lang_key, text``): a row for each different
    n-gram of a block with its count, and a row with the block's documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = None
        for batch in batches:
            for texts in T.chunks(batch.column("text"), CHUNK_BYTES):
                block = block or _Block(batch.schema)
                block.add(texts, batch.slice(texts.first, len(texts)))
                if block.size >= BLOCK_BYTES:
                    yield from block.rows(number)
                    number, block = number + 1, None
        if block:
            yield from block.rows(number)

    return docs.mapInArrow(cut, BLOCKS)


def count_grams(blocks: DataFrame) -> DataFrame:
    """``[key, lang_key, a, b, c, d, n]`` over all blocks."""
    grams = blocks.where("docs is null")
    return grams.groupBy("key", "lang_key", "a", "b", "c", "d").agg(F.sum("n").alias("n"))


def _discounted(grams: DataFrame) -> DataFrame:
    """``grams`` with ``off``, what is taken off a count of 1, 2 and 3 or more in a
    language, by Chen and Goodman. The list that is broadcast has a row a language."""
    n1, n2, n3, n4 = (F.col(f"n{k}") for k in range(1, 5))
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    enough = (n1 > 0) & (n2 > 0) & (n3 > 0)
    found = grams.groupBy("lang_key").agg(
        *[F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)]
    )
    offs = found.select(
        "lang_key",
        *[
            F.when(enough, F.least(F.lit(k - 0.05), F.greatest(F.lit(0.05), value)))
            .otherwise(0.5)
            .alias(f"off{k}")
            for k, value in enumerate(raw, 1)
        ],
    )
    off = F.when(F.col("n") == 1, F.col("off1")).when(F.col("n") == 2, F.col("off2"))
    joined = grams.join(F.broadcast(offs), "lang_key")
    return joined.withColumn("off", off.otherwise(F.col("off3"))).drop("off1", "off2", "off3")


def fit(counts: DataFrame) -> DataFrame:
    """``[key, log_p]`` of all n-grams of ``counts``.

    Lower orders count the different symbols seen before an n-gram. Order 0 is a uniform
    choice among the language's symbols and one more."""
    symbols = ["a", "b", "c", "d"]
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):
        word = symbols[ORDER - order :]
        levels.insert(0, levels[0].groupBy("lang_key", *word).agg(F.count("*").alias("n")))
    lower = None
    for order, level in enumerate(levels, 1):
        context, suffix = symbols[ORDER - order : -1], symbols[ORDER - order + 1 :]
        level = _discounted(level)
        contexts = level.groupBy("lang_key", *context).agg(
            F.sum("n").alias("total"), F.sum("off").alias("taken"), F.count("*").alias("kinds")
        )
        if lower is None:
            level = level.join(F.broadcast(contexts), "lang_key")
            level = level.withColumn("lower", 1 / (F.col("kinds") + 1))
        else:
            level = level.join(contexts, ["lang_key", *context])
            level = level.join(lower, ["lang_key", *suffix])
        p = (F.col("n") - F.col("off") + F.col("taken") * F.col("lower")) / F.col("total")
        lower = level.select("lang_key", *symbols[ORDER - order :], p.alias("lower"), *(
            ["key"] if order == ORDER else []
        ))
    return lower.select("key", F.log("lower").cast("float").alias("log_p"))


def answers(blocks: DataFrame, model: DataFrame) -> DataFrame:
    """``[block, key, log_p]`` of the different n-grams of each block."""
    return blocks.where("docs is null").select("block", "key").join(model, "key")


class Answered:
    """Log probabilities of a block's n-grams."""

    def __init__(self, answers: pa.Table) -> None:
        key = answers["key"].to_numpy()
        place = np.argsort(key)
        self.key, self.log_p = key[place], answers["log_p"].to_numpy()[place]

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        if (self.key[place] != keys).any():
            raise RuntimeError("an n-gram of the block is not in the model")
        return self.log_p[place].astype(np.float64)


def documents_of(docs: pa.Table) -> Iterator[pa.RecordBatch]:
    for one in docs["docs"]:
        yield from pa.ipc.open_stream(pa.py_buffer(one.as_py()))
