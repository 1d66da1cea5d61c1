import math
import random
from collections import Counter, defaultdict

import llm_plain
import pytest

from gramrank.llm import language_model as L
from gramrank.llm import perplexity as P
from gramrank.llm import textarrays as T


def some_texts(n=60, seed=1):
    draw = random.Random(seed)
    words = ["the", "of", "Ähre", "naïve", "x1", "b,", "c!", "word"]
    return [" ".join(draw.choices(words, k=draw.randrange(0, 40))) for _ in range(n)]


def test_counts_equal_plain_counts(docs, odd_rows):
    texts = [t for _, t in odd_rows[:5]] + [
        "a b c a b c\na b c\n\n \na b c",
        "#*$%&|<> ok",
        "é ü\x85x",
        *some_texts(20, 3),
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r for r in P.judge_quality(docs(rows)).collect()}
    for doc_id, text in rows:
        n, *others = llm_plain.text_counts(text)
        row = found[doc_id]
        got = [row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        assert got == [n, *others]
        assert row["base_failed"] == (n < 50 or 100 * others[-1] > 50 * n)
        assert not (row["kept"] and row["base_failed"])


@pytest.mark.parametrize("few", [0, 10_000])
def test_a_hot_language_is_not_dealt_by_language(docs, monkeypatch, few):
    """Unless there are very many languages; verdicts do not depend on it."""
    monkeypatch.setattr(P, "FEW_LANGUAGES", few)
    rows = [(i, t + " x" * i, "en" if i % 3 else "de") for i, t in enumerate(some_texts(40, 5))]
    judged = P.judge_quality(docs(rows))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (few > 0)
    assert judged.count() == 40


def test_bands_reject_what_no_other_text_looks_like(docs):
    draw = random.Random(4)
    words = [f"{a}{b}{c}" for a in "btk" for b in "aeiou" for c in "nrs"]
    plain = [" ".join(draw.choices(words, k=120)) for _ in range(80)]
    odd = " ".join("".join(draw.choices("zqxj7#|&%wvyp,", k=5)) for _ in range(60))
    dull = " ".join(f"ka{'na' * i}" for i in range(60))
    rows = [(i, t, "en") for i, t in enumerate(plain)] + [(900, odd, "en"), (901, dull, "en")]
    rows += [(2000, plain[0], None)]
    found = {r["doc_id"]: r for r in P.judge_quality(docs(rows)).collect()}
    assert not found[900]["kept"] and found[900]["perplexity"] > found[900]["band_high"]
    assert not found[901]["kept"] and found[901]["perplexity"] < found[901]["band_low"]
    assert sum(found[i]["kept"] for i in range(80)) >= 78
    assert found[2000]["band_low"] is not None


def test_odd_rows_and_empty_tables(docs, odd_rows):
    assert P.judge_quality(docs(odd_rows)).count() == len(odd_rows)
    assert P.judge_quality(docs([])).count() == 0


def real_points(text):
    return [0, 0, 0, *(ord(c) + 1 for c in text or ""), 0]


def plain_point_model(texts, kinds):
    """Interpolated modified Kneser-Ney by dictionaries over code points."""
    counts = [None, *(Counter() for _ in range(4))]
    for text in texts:
        c = real_points(text)
        for i in range(3, len(c)):
            counts[4][tuple(c[i - 3 : i + 1])] += 1
    for order in (3, 2, 1):
        for gram in counts[order + 1]:
            counts[order][gram[1:]] += 1
    off = [None]
    for order in range(1, 5):
        n = Counter(min(v, 5) for v in counts[order].values())
        if not (n[1] and n[2] and n[3]):
            off.append([0, 0.5, 0.5, 0.5])
            continue
        y = n[1] / (n[1] + 2 * n[2])
        raw = [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
        off.append([0, *(min(max(r, 0.05), k - 0.05) for k, r in zip((1, 2, 3), raw[1:]))])
    totals = [None, *(defaultdict(lambda: [0, 0.0]) for _ in range(4))]
    for order in range(1, 5):
        for gram, c in counts[order].items():
            slot = totals[order][gram[:-1]]
            slot[0] += c
            slot[1] += off[order][min(c, 3)]

    def p(gram):
        order = len(gram)
        if order == 0:
            return 1 / kinds
        total, taken = totals[order].get(gram[:-1], (0, 0.0))
        if not total:
            return p(gram[1:])
        c = counts[order][gram]
        return (c - off[order][min(c, 3)]) / total + taken / total * p(gram[1:])

    return p


def plain_log_p(texts):
    """Sum of log probabilities of each text by the model of code points."""
    p = plain_point_model(texts, len({c for t in texts for c in real_points(t)[3:]}) + 1)
    found = []
    for text in texts:
        c = real_points(text)
        found.append(sum(math.log(p(tuple(c[i - 3 : i + 1]))) for i in range(3, len(c))))
    return found


def test_perplexity_is_that_of_code_points_of_the_language(docs):
    by_lang = {
        "en": [*some_texts(), None, ""],
        "ko": [t.replace("o", "한").replace("e", "국😀") for t in some_texts(40, 2)],
    }
    rows = [(t, lang) for lang, texts in by_lang.items() for t in texts]
    frame = docs([(i, *row) for i, row in enumerate(rows)])
    got = {r["doc_id"]: r["perplexity"] for r in P.judge_quality(frame).collect()}
    want = [x for texts in by_lang.values() for x in plain_log_p(texts)]
    for i, ((text, _), log_p) in enumerate(zip(rows, want, strict=True)):
        assert math.log(got[i]) == pytest.approx(-log_p / (len(text or "") + 1), abs=1e-4)


def test_scrambled_text_beyond_ascii_is_rejected(docs):
    draw = random.Random(6)
    words = [f"{a}{b}{c}" for a in "бтк" for b in "аеиоу" for c in "нрс"]
    plain = [" ".join(draw.choices(words, k=120)) for _ in range(60)]
    scrambled = " ".join("".join(draw.sample(w, 3)) for w in plain[0].split())
    rows = [(i, t, "ru") for i, t in enumerate(plain)] + [(900, scrambled, "ru")]
    found = {r["doc_id"]: r for r in P.judge_quality(docs(rows)).collect()}
    assert not found[900]["kept"] and found[900]["perplexity"] > found[900]["band_high"]
    assert sum(found[i]["kept"] for i in range(60)) >= 58


def test_the_model_grows_with_the_texts(docs):
    def size(n):
        frame = docs([(i, "".join(map(chr, range(0x4E00 + 40 * i, 0x4E28 + 40 * i)))) for i in range(n)])
        plain = frame.select("doc_id", "lang", L.lang_key(frame["lang"]).alias("lang_key"), "text")
        return L.fit(L.count_grams(L.read_blocks(plain))).count()

    assert size(40) == 40 * 41 and size(80) == 80 * 41
