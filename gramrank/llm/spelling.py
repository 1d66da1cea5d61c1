"""Words grouped by spelling: which words differ from which by one code point.

Asymmetric chunks: of two words, the one that is not longer gives two disjoint chunks, its
halves; the other gives the positional grams a chunk can meet: those of a half's length,
where the half would stand, shifted by one if the word is longer by one. One edit leaves a
half as it is, so an equi-join of chunks with grams meets every pair, and the edit
distance is then verified.

A half may be shared by very many words. Chunks whose pairs would exceed a bound are cut
once more: the rest of the word is split into pieces and all of them but one join the key.
The edit lies in one piece, so no pair is lost, and words under one key then differ in one
piece of the rest only, an eighth of the word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramrank.session import cut_lineage, new_shared_path

#: Letters of a word: Latin letters of the first 256 code points, and the two signs there.
LETTER = "[A-Za-zÀ-ÿ]"
NO_LETTER = re.compile("[^A-Za-zÀ-ÿ]")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Characters of a text taken at a time, and words a task holds before it hands them on.
WINDOW = 1 << 20
HELD_WORDS = 100_000
#: Pairs under one chunk above which it is cut once more, and pieces its rest is cut into.
CHUNK_PAIRS = 10_000
REST_PIECES = 4

#: Code points of a word up to which Spark's edit distance is fast.
SHORT_WORD = 256

#: What becomes of a lower-cased run in a document; None for the run itself.
Alter = Callable[[object, str], str]


def _windows(text: str, size: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Parts of a text of ``size`` characters or more, cut where no letter stands."""
    low = 0
    while low < len(text):
        gap = NO_LETTER.search(text, min(low + size, len(text)))
        high = gap.start() if gap else len(text)
        yield low, high
        low = high


def count_words(docs: DataFrame, least_run: int = 7, alter: Alter | None = None) -> DataFrame:
    """``[word, n]``: lower-cased (A to Z) maximal runs of at least ``least_run`` letters,
    as ``alter(doc_id, run)`` leaves them, and how often they occur in all texts.

    A null text has no runs; further columns are ignored. Texts are gone through in
    windows, and a task adds up its words before anything is shuffled."""
    runs = re.compile(f"{LETTER}{{{least_run},}}")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed_on() -> Iterator[pa.RecordBatch]:
            table = pa.table(
                {"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())}
            )
            yield from table.to_batches(max_chunksize=10_000)
            held.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, text = doc_id.as_py(), text.as_py() or ""
                for low, high in _windows(text):
                    found: Counter[str] = Counter()
                    for run, n in Counter(runs.findall(text, low, high)).items():
                        found[run.lower() if run.isascii() else run.translate(FOLD)] += n
                    for run, n in found.items():
                        held[alter(doc_id, run) if alter else run] += n
                    if len(held) > HELD_WORDS:
                        yield from handed_on()
        yield from handed_on()

    counted = docs.select("doc_id", "text").mapInArrow(tally, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _halves(length: Column) -> Column:
    """The two ranges of a word that may hold the edit, each with the other half as chunk."""
    middle = F.floor(length / 2).cast("int")
    zero = F.lit(0)
    return F.array(
        F.struct(zero.alias("low"), middle.alias("high")),
        F.struct(middle.alias("low"), length.alias("high")),
    )


def _pieces(span: Column) -> Column:
    """A range cut into at most ``REST_PIECES`` ranges of a code point or more."""
    low, size = span["low"], span["high"] - span["low"]
    pieces = F.greatest(F.least(size, F.lit(REST_PIECES)), F.lit(1))
    edge = lambda i: (low + F.floor(size * i / pieces)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), pieces - 1),
        lambda i: F.struct(edge(i).alias("low"), edge(i + 1).alias("high")),
    )


def _with_key(sides: DataFrame) -> DataFrame:
    """``key``: what stands outside the range, for partners of length ``length``. In a word
    that is longer by ``shift`` the range is longer by as much."""
    before = F.col("word").substr(F.lit(1), F.col("span.low"))
    behind = F.col("word").substr(
        F.col("span.high") + F.col("shift") + 1, F.col("length") - F.col("span.high")
    )
    return sides.withColumn("key", F.xxhash64("length", "span.low", "span.high", before, behind))


def _sides(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks and grams ``[word, n, length, shift, span, key]``; ``length`` is that of the
    word of the pair that is not longer."""
    sized = words.select("word", "n", F.char_length("word").alias("size"))

    def side(shifts: list[int]) -> DataFrame:
        shifted = sized.withColumn("shift", F.explode(F.lit(shifts)))
        ranged = shifted.withColumn("length", F.col("size") - F.col("shift"))
        return _with_key(ranged.withColumn("span", F.explode(_halves(F.col("length")))).drop("size"))

    return side([0]), side([0, 1])


def _one_edit(word: Column, near: Column, shift: Column) -> Column:
    """Whether ``near``, longer by ``shift`` (0 or 1), is one edit away. Spark's distance
    takes time quadratic in the length, so of long words what stands behind the first
    difference is compared."""
    letters = lambda text: F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    differ = F.zip_with(letters(word), letters(near), lambda a, b: ~a.eqNullSafe(b))
    first = F.array_position(differ, True).cast("int")
    behind = F.substr(word, first + 1 - shift) == F.substr(near, first + 1)
    short = F.levenshtein(word, near, 1) == 1
    return F.when(F.char_length(word) <= SHORT_WORD, short).otherwise((first > 0) & behind)


def near_pairs(words: DataFrame, chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """``[word, n, near, near_n]``: all pairs of ``words`` (``[word, n]``, each word once)
    that differ by one inserted, deleted or replaced code point, in both directions, a pair
    once or more often.

    Chunks with more than ``chunk_pairs`` pairs are found by counting, before any pair is
    made."""
    chunks, grams = _sides(words)
    counted = chunks.select("key", F.lit(1).alias("chunk"), F.lit(0).alias("gram")).unionAll(
        grams.select("key", F.lit(0).alias("chunk"), F.lit(1).alias("gram"))
    )
    hot = cut_lineage(
        counted.groupBy("key")
        .agg(F.sum("chunk").alias("chunks"), F.sum("gram").alias("grams"))
        .where(F.col("chunks") * F.col("grams") > chunk_pairs)
        .select("key", F.lit(True).alias("hot"))
    )

    def cut(side: DataFrame) -> DataFrame:
        spans = F.when(F.col("hot"), _pieces(F.col("span"))).otherwise(F.array("span"))
        marked = side.join(hot, "key", "left").withColumn("span", F.explode(spans))
        return _with_key(marked).select("key", "word", "n", "shift")

    left = cut(chunks).select("key", "word", "n")
    right = cut(grams).select(
        "key", F.col("word").alias("near"), F.col("n").alias("near_n"), "shift"
    )
    once = (F.col("shift") == 1) | (F.col("word") < F.col("near"))
    edit = _one_edit(F.col("word"), F.col("near"), F.col("shift"))
    pairs = left.join(right, "key").where(once & edit)
    both = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(
            F.col("near").alias("word"),
            F.col("near_n").alias("n"),
            F.col("word").alias("near"),
            F.col("n").alias("near_n"),
        ),
    )
    return pairs.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """``[word, root]`` of ``[word, form]``: where following the forms ends. Every step is
    one to a more frequent word, so there are no circles, and each round doubles the steps
    taken."""
    paths = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        beyond = paths.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = paths.join(beyond, "root", "left")
        longer = cut_lineage(
            longer.select(
                "word",
                F.coalesce("beyond", "root").alias("root"),
                F.col("beyond").isNotNull().alias("moved"),
            )
        )
        if longer.where("moved").isEmpty():
            return paths
        paths = longer.select("word", "root")


def group_variants(
    words: DataFrame, times: int = 10, chunk_pairs: int = CHUNK_PAIRS
) -> DataFrame:
    """``[word, form, root, n, n_near, form_n]`` of ``words`` (``[word, n]``, each word once,
    no null words).

    Two words are near if they differ by exactly one inserted, deleted or replaced code
    point. A word's form is its near word of the largest ``n``, of equal ones the smallest
    in code point order, if that ``n`` is at least ``times`` its own; else null, as is
    ``form_n``. The root is where following the forms ends, the word itself without a form.
    ``n_near`` counts the near words. ``times`` is above 1. An empty table gives no rows.
    Words of any length are compared whole.
    """
    if times <= 1:
        raise ValueError("a form must be more frequent than its word")
    path = new_shared_path(words.sparkSession, "spelling-words")
    words.select("word", "n").write.parquet(path)
    words = words.sparkSession.read.parquet(path)
    # A word's pairs lie together from here on: at most some hundreds for each code point.
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near")))
    near = cut_lineage(
        near_pairs(words, chunk_pairs)
        .repartition("word")
        .dropDuplicates(["word", "near"])
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.when(-best["rank"] >= times * F.first("n"), best).alias("best"),
        )
        .select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.rank")).alias("form_n"))
    )
    roots = _roots(near.where("form is not null"))
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )
