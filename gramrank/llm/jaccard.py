"""Exact join of word-shingle sets by Jaccard similarity, with set relations skipped.

Every set lists its rarest shingles, the prefix in which two similar sets must meet.
Of the pairs in the list of a shingle most are not compared:

* a position in a list tells how many rarer shingles a set has, all of which differ
  from its partner's where the two meet first; entries whose positions add up to more
  than the difference allowed are skipped;
* a set is first compared only with the leader of its list. The sets similar to the
  same leader are in the same class, and pairs within a class are never looked at;
* what is left are pairs of sets of different classes, made list by list (lists are not cut
  into blocks that could be skipped unseen). Bitmaps of the sets, a small one
  in the lists and one that grows with the set for the pairs, bound their difference from
  below, and only pairs within the bounds are compared in full.

Equal sets are one set. Links come out as classes, so a group of near copies costs a
comparison or a few for each member, and no link between different classes is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramrank.llm import textarrays as T
from gramrank.llm.components import components
from gramrank.session import new_shared_path

#: Counters of the shingle frequencies, whatever the size of the corpus.
COUNTER_BITS = 20
#: Bytes of text whose words are hashed at a time; a longer text by itself.
HASHED_BYTES = 1 << 18
#: Sets of so many shingles are told apart by the bitmaps in the lists.
LISTED_SHINGLES = 2300

INDEX = (
    "doc_id {id}, text_key long, set long, n int, bits array<long>, wide array<long>,"
    " tokens array<long>"
)


@dataclass(frozen=True)
class Rule:
    """Two sets link if ``per * |intersection| >= least * |union|``."""

    words: int = 5
    least: int = 80
    per: int = 100

    def prefix(self, n: int) -> int:
        return n - -(-self.least * n // self.per) + 1

    @property
    def smallest(self) -> int:
        """Sets below this size link with no other set."""
        return max(1, -(-self.least // max(self.per - self.least, 1)))

    @property
    def bitmap_words(self) -> int:
        """64-bit words of the bitmaps in the lists. Unrelated sets differ in half the bits
        or fewer, which must be more than linked sets may differ in."""
        bits = 4 * LISTED_SHINGLES * (self.per - self.least) // (self.per + self.least)
        return 1 << max(0, (max(bits, 1) - 1) // 64).bit_length()

    def sizes(self, n: Column, m: Column) -> Column:
        return F.least(n, m) * self.per >= F.greatest(n, m) * self.least

    def difference(self, n: Column, m: Column) -> Column:
        """How many shingles two linked sets can differ in."""
        both = n + m
        return both - 2 * F.ceil(both * self.least / (self.least + self.per))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shingle_sets(texts: T.Texts, words: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    found = texts.words()
    hashes = found.hashes(T.FOLDED_VALUES)
    for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True):
        yield np.unique(T.windows(hashes[a:b], words))


def set_key(tokens: np.ndarray) -> int:
    """64-bit key of a set."""
    total = int(T.mix(tokens).sum(dtype=np.uint64)) + len(tokens)
    both = np.array([total % (1 << 64)], dtype=np.uint64) ^ np.bitwise_xor.reduce(tokens)
    return int(T.mix(both).view(np.int64)[0])


def bitmap(tokens: np.ndarray, words: int) -> np.ndarray:
    """Bits that an odd number of the set's shingles fall on: two sets differ in at least
    as many shingles as their bitmaps in bits. ``words`` is a power of two."""
    place = (tokens & np.uint64(words * 64 - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=words * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def wide_bitmap(tokens: np.ndarray) -> np.ndarray:
    """A bitmap with a bit or more to a shingle, so that it tells large sets apart too."""
    return bitmap(tokens, max(8, 1 << (-(-len(tokens) // 64)).bit_length()))


def counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def count_shingles(docs: DataFrame, words: int) -> np.ndarray:
    """How many texts hold a shingle, by counters that shingles share. The counters of
    the tasks are added up in two steps; only their sum reaches the driver."""
    size = 1 << COUNTER_BITS

    def pack(total: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["counts"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for texts in T.chunks(batch.column(0), HASHED_BYTES):
                tokens = list(shingle_sets(texts, words))
                total += np.bincount(counter(np.concatenate(tokens)), minlength=size)
        if rows:
            yield pack(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.frombuffer(zlib.decompress(packed.as_py()), dtype=np.int64)
        yield pack(total)

    of_tasks = docs.select("text").mapInArrow(count, "counts binary")
    spread = max(1, int(of_tasks.sparkSession.sparkContext.defaultParallelism))
    summed = of_tasks.repartition(spread).mapInArrow(add, "counts binary")
    total = summed.coalesce(1).mapInArrow(add, "counts binary").first()
    return np.frombuffer(zlib.decompress(total[0]), dtype=np.int64)


def text_key() -> Column:
    """With the id, tells rows apart whose texts differ."""
    return F.xxhash64("text")


def index_sets(docs: DataFrame, rule: Rule, counts: np.ndarray) -> DataFrame:
    """``[doc_id, text_key, set, n, bits, wide, tokens]``: each text's set, its size,
    bitmaps and prefix, rarest shingle first. A text without words has no set and size
    0; a set too small to link with another has no prefix."""
    ranks = np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = sent.value
        for batch in batches:
            for texts in T.chunks(batch.column(2), HASHED_BYTES):
                key, n, bits, wide, prefix = [], [], [], [], []
                for tokens in shingle_sets(texts, rule.words):
                    n.append(len(tokens))
                    key.append(set_key(tokens) if len(tokens) else None)
                    bits.append(bitmap(tokens, rule.bitmap_words))
                    wide.append(wide_bitmap(tokens))
                    if len(tokens) >= rule.smallest:
                        order = np.lexsort((tokens, ranks[counter(tokens)]))
                        prefix.append(tokens[order[: rule.prefix(len(tokens))]].view(np.int64))
                    else:
                        prefix.append(np.empty(0, dtype=np.int64))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(texts.first, len(texts)),
                        batch.column(1).slice(texts.first, len(texts)),
                        pa.array(key, pa.int64()),
                        pa.array(n, pa.int32()),
                        _lists(bits),
                        _lists(wide),
                        _lists(prefix),
                    ],
                    names=["doc_id", "text_key", "set", "n", "bits", "wide", "tokens"],
                )

    plain = docs.select("doc_id", text_key().alias("text_key"), "text")
    return plain.mapInArrow(
        index, INDEX.format(id=plain.schema["doc_id"].dataType.simpleString())
    )


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays)))


def _apart(a: Column, b: Column) -> Column:
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def _folded(wide: Column, words: Column) -> Column:
    """A bitmap as one of ``words`` words, a power of two not above its own number."""
    return F.transform(
        F.sequence(F.lit(1), words),
        lambda i: F.aggregate(
            F.sequence(i, F.size(wide), words),
            F.lit(0).cast("long"),
            lambda total, k: total.bitwiseXOR(F.element_at(wide, k)),
        ),
    )


def within_wide_bitmaps(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` whose wide bitmaps do not rule out a link."""
    side = lambda name: sets.select(
        F.col("set").alias(name), F.col("n").alias(f"n_{name}"), F.col("wide").alias(f"wide_{name}")
    )
    words = F.least(F.size("wide_a"), F.size("wide_b"))
    apart = _apart(_folded(F.col("wide_a"), words), _folded(F.col("wide_b"), words))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(apart <= rule.difference(F.col("n_a"), F.col("n_b")))
        .select("a", "b")
    )


def verify(
    pairs: DataFrame, sets: DataFrame, docs: DataFrame, rule: Rule, grows: bool
) -> DataFrame:
    """The pairs ``a, b`` of set keys that link, compared shingle by shingle. ``grows``:
    the pairs grow with the corpus, so their ids are not to be broadcast to the texts."""

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in T.chunks(batch.column(0), HASHED_BYTES):
                tokens = list(shingle_sets(texts, rule.words))
                yield pa.record_batch(
                    [
                        pa.array([set_key(t) if len(t) else None for t in tokens], pa.int64()),
                        pa.array([t.tobytes() for t in tokens], pa.binary()),
                    ],
                    names=["set", "body"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x = np.frombuffer(left.as_buffer(), dtype=np.uint64)
                y = np.frombuffer(right.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(rule.per * both >= rule.least * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    # written first, so that Spark knows its size when it plans the join with the texts
    needed = _stored(
        ends.join(sets.select("set", "rep"), "set").select("rep").distinct().sort("rep"),
        "jaccard-needed",
    )
    if grows:
        needed = needed.hint("merge")
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    found = texts.join(needed, texts["id"].eqNullSafe(needed["rep"]), "left_semi")
    body = _stored(
        found.select("text").mapInArrow(bodies, "set long, body binary"), "jaccard-bodies"
    )
    left = body.select(F.col("set").alias("a"), F.col("body").alias("left"))
    right = body.select(F.col("set").alias("b"), F.col("body").alias("right"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long").distinct()


def similar_classes(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``[doc_id, text_key, n_shingles, component_id]`` for each of ``docs`` (``doc_id,
    text``; other columns are ignored).

    Words are longest runs without white space, A-Z as a-z; a set holds the shingles of
    ``rule.words`` words, or the whole text if it has fewer words. A text without words,
    or null, has size 0 and is in a class of its own. ``component_id`` is the smallest
    id reachable by links. Equal sets link. Rows that repeat an id belong to each of
    their sets' classes; null ids count for nothing in a class that has others. An empty
    table gives no rows. Shingles are compared by 64-bit hashes."""
    index = _stored(
        index_sets(docs, rule, count_shingles(docs, rule.words)), "jaccard-index"
    )
    chosen = index.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("rep"))
    chosen = chosen.withColumnRenamed("set", "chosen")
    same = (F.col("set") == F.col("chosen")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    sets = _stored(
        index.join(chosen, same).select("set", "rep", "n", "bits", "wide", "tokens"), "jaccard-sets"
    )
    info = sets.select("set", "n", "bits")

    # lists of two sets or more, and the size and position of each list's leader
    entries = sets.select("set", "n", F.posexplode("tokens").alias("pos", "token"))
    shared = (
        entries.groupBy("token")
        .agg(F.min("set").alias("leader"), F.count(F.lit(1)).alias("held_by"))
        .where("held_by > 1")
    )
    lists = _stored(
        entries.join(_stored(shared, "jaccard-leaders"), "token").select(
            "token", "set", "n", "pos", "leader", "held_by"
        ),
        "jaccard-lists",
    )
    leads = lists.where("set = leader").select(
        "token", F.col("n").alias("n_a"), F.col("pos").alias("pos_a")
    )

    # each set against the leaders of its lists
    end = lambda name: info.select(
        F.col("set").alias(name), F.col("bits").alias(f"bits_{name}")
    )
    allowed = rule.difference(F.col("n_a"), F.col("n_b"))
    may_meet = rule.sizes(F.col("n_a"), F.col("n_b")) & (
        F.col("pos_a") + F.col("pos_b") <= allowed
    )
    near = _apart(F.col("bits_a"), F.col("bits_b")) <= allowed
    led = (
        lists.where("set <> leader")
        .select(
            "token",
            F.col("leader").alias("a"),
            F.col("set").alias("b"),
            F.col("n").alias("n_b"),
            F.col("pos").alias("pos_b"),
        )
        .join(leads, "token")
        .where(may_meet)
        .select("a", "b", "n_a", "n_b")
        .distinct()
    )
    led = led.join(end("a"), "a").join(end("b"), "b").where(near).select("a", "b")
    candidates = _stored(within_wide_bitmaps(led, sets, rule), "jaccard-candidates")
    classes = components(verify(candidates, sets, docs, rule, grows=True), "a", "b")

    # pairs of sets that meet in a list and are in different classes; a list of two has
    # only the pair that was compared
    known = info.join(classes.withColumnRenamed("node", "set"), "set", "left").withColumn(
        "component", F.coalesce("component", "set")
    )
    class_of = known.select("set", "component")
    placed = _stored(
        lists.where("held_by > 2").drop("held_by").join(class_of, "set"), "jaccard-placed"
    )
    mixed = (
        placed.groupBy("token")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.max(F.when(F.col("set") == F.col("leader"), F.col("component"))).alias("home"),
        )
        .where("low <> high")
        .select("token", "home")
    )
    open_lists = _stored(
        placed.where("set <> leader")
        .join(_stored(mixed, "jaccard-mixed"), "token")
        .join(info.select("set", "bits"), "set"),
        "jaccard-open",
    )
    side = lambda name: open_lists.select(
        "token",
        "home",
        F.col("set").alias(name),
        F.col("pos").alias(f"pos_{name}"),
        F.col("n").alias(f"n_{name}"),
        F.col("bits").alias(f"bits_{name}"),
        F.col("component").alias(f"class_{name}"),
    )
    # one of the two is outside the class its list's leader is in
    outside = side("a").where("class_a <> home").drop("home")
    meets = outside.join(side("b"), "token").where(
        (F.col("class_a") != F.col("class_b"))
        & ((F.col("class_b") == F.col("home")) | (F.col("a") < F.col("b")))
        & may_meet
        & near
    )
    met = meets.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    across = _stored(within_wide_bitmaps(met, sets, rule), "jaccard-across")
    more = verify(across, sets, docs, rule, grows=False)
    bridges = more.join(
        class_of.select(F.col("set").alias("a"), F.col("component").alias("low")), "a"
    ).join(class_of.select(F.col("set").alias("b"), F.col("component").alias("high")), "b")
    merged = components(bridges, "low", "high")

    final = class_of.join(
        merged.select(F.col("node").alias("component"), F.col("component").alias("merged")),
        "component",
        "left",
    ).select("set", F.coalesce("merged", "component").alias("class"))
    members = _stored(
        index.select("doc_id", "text_key", "n", "set").join(final, "set", "left"), "jaccard-members"
    )
    first = members.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"))
    return members.join(_stored(first, "jaccard-first"), "class", "left").select(
        "doc_id",
        "text_key",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("first", "doc_id").alias("component_id"),
    )


def one_of_each_class(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs``, all columns, whose id is the smallest of their class."""
    known = similar_classes(docs, rule)
    gone = _stored(
        known.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
            F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")
        ),
        "jaccard-gone",
    )
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = docs.select(row, F.col("doc_id").alias("own_id"), text_key().alias("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_key") == F.col("gone_key"))
    return rows.join(gone, same, "left_anti").select("row.*")
