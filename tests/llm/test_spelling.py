import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gramrank.llm import queries, spelling

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, times=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best and counts[best] >= times * counts[word] else None

    def root(word):
        while form[word]:
            word = form[word]
        return word

    return {
        (w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()
    }


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made_up(seed, size, letters, lengths):
    chance = random.Random(seed)
    words = {"".join(chance.choices(letters, k=chance.choice(lengths))) for _ in range(size)}
    for word in list(words):
        at = chance.randrange(len(word) + 1)
        kind = chance.randrange(4)
        if kind < 3:
            words.add(word[:at] + chance.choice(letters) * (kind != 0) + word[at + (kind != 1) :])
    return {w: chance.choice([2, 3, 20, 25, 300, 4000]) for w in words if w}


CASES = {
    "two letters": made_up(1, 150, "ab", [7, 8, 9]),
    "accents": made_up(2, 250, "abcé÷Àÿ", [7, 8, 11]),
    "one chunk": {"pre" * 3 + w: n for w, n in made_up(3, 200, "abcdef", [4, 5, 6]).items()},
    "short": made_up(4, 60, "abc", [1, 2, 3]),
}


@pytest.mark.parametrize("chunk_pairs", [1, 40, 10_000])
@pytest.mark.parametrize("case", CASES)
def test_groups_equal_all_pairs(spark, case, chunk_pairs):
    words = spark.createDataFrame(list(CASES[case].items()), "word string, n long")
    groups = spelling.group_variants(words, chunk_pairs=chunk_pairs)
    assert groups.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(groups) == sorted(plain(CASES[case]), key=repr)


def test_a_chunk_of_very_many_words_is_cut(spark):
    """Half of all words begin alike; no key keeps more than a small part of them."""
    chance = random.Random(5)
    words = {"prefix" + "".join(chance.choices("abcdefghij", k=6)) for _ in range(3000)}
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    chunks, _ = spelling._sides(df)
    assert chunks.groupBy("key").count().agg(F.max("count")).first()[0] == len(words)
    pairs = spelling.near_pairs(df)
    joined = re.search(r"\[key#\d+L\], \[key#\d+L\], Inner", pairs._jdf.queryExecution().executedPlan().toString())
    assert joined
    near = {(r["word"], r["near"]) for r in pairs.collect()}
    by_rest = {}
    for w in words:
        for i in range(6, 12):
            by_rest.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    want = {(a, b) for group in by_rest.values() for a in group for b in group if a != b}
    assert near == want


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    roots = {r["word"]: r["root"] for r in spelling.group_variants(df).collect()}
    assert set(roots.values()) == {"aaabbbb"}
    with pytest.raises(ValueError):
        spelling.group_variants(df, times=1)


def test_of_equal_forms_the_smallest_in_code_points(spark):
    counts = {"wordsée": 30, "wordsze": 30, "wordsxe": 2, "wordsx": 30}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    forms = {r["word"]: r["form"] for r in spelling.group_variants(df).collect()}
    assert forms["wordsxe"] == "wordsx"


def test_long_words_and_empty_tables(spark):
    long = 20_000
    words = ["x" * long, "x" * (long - 1), "x" * (long // 2) + "y" + "x" * (long // 2 - 1)]
    words += ["xy" * 200, "xy" * 199 + "yx", "xy" * 199 + "x", "y" + "xy" * 199, "é" + "xy" * 199 + "x"]
    groups = spelling.group_variants(
        spark.createDataFrame([(w, 2) for w in words], "word string, n long"), chunk_pairs=1
    )
    want = {w: sum(one_edit(w, v) for v in words) for w in words}
    assert {r["word"]: r["n_near"] for r in groups.collect()} == want
    df = groups
    assert spelling.group_variants(df.where("n = 0")).count() == 0


def plain_words(rows, alter=None):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            counts[alter(doc_id, run) if alter else run] += 1
    return counts


@pytest.mark.parametrize("size", [1, 5, 100])
def test_windows_end_between_runs(size):
    text = "ÀÉ×÷ÿ Ünïcode, MiXeD-case\nwordsÐ7 " * 3 + "end"
    parts = [text[low:high] for low, high in spelling._windows(text, size)]
    assert "".join(parts) == text
    runs = re.compile("[A-Za-zÀ-ÿ]+")
    assert [run for part in parts for run in runs.findall(part)] == runs.findall(text)


def test_counts_equal_plain_counts(docs, odd_rows, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    rows = [*odd_rows, (20, "ÀÉ×÷ÿ Ünïcode MiXeD-case\nwordsÐ7 wordsß ŁódźWords")]
    counted = spelling.count_words(docs(rows), 1, queries.slipped)
    want = plain_words(rows, queries.slipped)
    assert {r["word"]: r["n"] for r in counted.collect()} == want
    assert spelling.count_words(docs([])).count() == 0


def test_runs_lose_a_letter_by_their_hash():
    hit = next(i for i in range(1000) if zlib.crc32(f"{i}:someword".encode()) % 31 == 0)
    at = zlib.crc32(f"{hit}:someword".encode()) % 8
    assert queries.slipped(hit, "someword") == "someword"[:at] + "someword"[at + 1 :]
    assert queries.slipped(None, "abc") in ("abc", "bc", "ac", "ab")
