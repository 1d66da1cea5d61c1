import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gramrank.llm import pii as P
from gramrank.llm.tagger import Tagger

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in digits(m)][::-1]
        total = sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])
        if 13 <= len(d) <= 19 and total % 10 == 0:
            found.append((2, *m.span()))
    return found + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=500, deadline=None)
@given(st.text("a.@-+1209() é", max_size=45))
def test_rules_equal_the_expressions(text):
    assert [tuple(s) for s in P.base_spans(text)] == plain(text)


def test_long_runs_take_no_long_time():
    text = "9" * 200_000 + "@" + "a" * 200_000 + "." * 10 + "0" * 5000 + ".1.1.1"
    assert [s.kind for s in P.base_spans(text)] == [1]


def test_gradients():
    tagger = Tagger.new(5, embed=4, hidden=3)
    draw = np.random.default_rng(0)
    ids, tags = draw.integers(0, 129, (3, 7)), draw.integers(0, 5, (3, 7))
    tagger.weights["step"] = draw.normal(0, 1, (5, 5))
    _, grads = tagger.loss(ids, tags)
    for name, w in tagger.weights.items():
        for _ in range(3):
            at = tuple(draw.integers(0, s) for s in w.shape)
            at = (ids[0, 0], *at[1:]) if name == "chars" else at
            old = w[at]
            w[at] = old + 1e-5
            up = tagger.loss(ids, tags)[0]
            w[at] = old - 1e-5
            down = tagger.loss(ids, tags)[0]
            w[at] = old
            assert (up - down) / 2e-5 == pytest.approx(grads[name][at], abs=1e-6)


def test_decoding_finds_the_best_path():
    draw = np.random.default_rng(1)
    tagger = Tagger.new(3, embed=2, hidden=2)
    tagger.weights["step"] = draw.normal(0, 2, (3, 3))
    emit = draw.normal(0, 1, (5, 4, 3))
    tags, sure = tagger.decode(emit)
    paths = np.array(np.meshgrid(*[range(3)] * 5)).reshape(5, -1).T
    for n in range(4):
        scores = [
            sum(emit[t, n, p[t]] for t in range(5))
            + sum(tagger.weights["step"][p[t - 1], p[t]] for t in range(1, 5))
            for p in paths
        ]
        assert tags[:, n].tolist() == paths[int(np.argmax(scores))].tolist()
        weights = np.exp(scores) / np.exp(scores).sum()
        for t in range(5):
            same = paths[:, t] == tags[t, n]
            assert sure[t, n] == pytest.approx(weights[same].sum())


@pytest.mark.parametrize("size", [1, 63, 64, 65, 96, 97, 500])
def test_windows_cover_a_stretch(size):
    starts = P.window_starts(size)
    covered = set()
    for at in starts:
        covered |= set(range(at, min(at + P.WINDOW, size)))
    assert covered == set(range(size))


def sentence(draw, words, extra=""):
    parts = draw.choices(words, k=14)
    parts.insert(draw.randrange(14), extra)
    return " ".join(parts)


def private(draw):
    n = lambda k: "".join(draw.choices("0123456789", k=k))
    return draw.choice(
        [
            f"{draw.choice(['ann', 'bo', 'kim'])}.{n(2)}@mail{n(1)}.example.com",
            ".".join(str(draw.randrange(256)) for _ in range(4)),
            f"+1 ({n(3)}) 555-{n(4)}",
        ]
    )


@pytest.fixture(scope="module")
def written():
    draw = random.Random(5)
    words = ["river", "stone", "and", "the", "walked", "slowly", "über", "green", "hills", "in 2021"]
    return [sentence(draw, words, private(draw) if i % 2 else "") for i in range(700)]


def test_tagger_finds_what_it_was_shown_and_more(docs, written):
    tagger = P.train_tagger(docs(list(enumerate(written[:500]))))
    held = written[500:]
    found = P.tagged_spans(held, tagger)
    spans = [{(s.start, s.end, s.kind) for s in P.base_spans(t)} for t in held]
    hits = sum(len(s & {(f.start, f.end, f.kind) for f in fs}) for s, fs in zip(spans, found))
    assert hits >= 0.8 * sum(map(len, spans))
    clean = [fs for s, fs in zip(spans, found) if not s]
    assert sum(map(bool, clean)) <= 0.05 * len(clean)


def test_rules_stay_and_the_text_is_cleaned(docs, written):
    rows = [*enumerate(written), (1000, None), (1001, "")]
    frame = docs(rows)
    found = P.find_personal_data(frame, tagger=P.train_tagger(frame, steps=20)).collect()
    for row in found:
        text = row["row"]["text"]
        base = plain(text or "")
        listed = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in sorted(base))
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in P.KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
        assert set(listed.split(",")) - {""} <= set(row["spans"].split(","))
        if text is None:
            assert row["redacted"] is None
        elif not row["spans"]:
            assert row["redacted"] == text
        else:
            assert not plain(row["redacted"])


def test_redaction_merges_overlaps():
    spans = [P.Span(0, 2, 5), P.Span(2, 4, 8), P.Span(1, 9, 10)]
    assert P.redact("abcdefghijk", spans) == "ab[EMAIL]i[IP]k"


def test_odd_rows_and_empty_tables(docs, odd_rows):
    assert P.train_tagger(docs(odd_rows)) is None
    found = P.find_personal_data(docs(odd_rows), carry=["doc_id"], with_text=False)
    assert found.count() == len(odd_rows)
    assert P.find_personal_data(docs([])).count() == 0


def test_rare_spans_train_a_tagger(docs, written):
    plain_texts = [f"{t} on {i}" for i, t in enumerate(written[::2] * 8)]
    rows = list(enumerate([*plain_texts, *written[1:41:2]]))
    assert P.train_tagger(docs(rows), texts=100, steps=5) is not None
    dates = "the 12 of May and more words than a window holds, all of them plain ones. " * 40
    assert P.train_tagger(docs([(1, dates + "ann.12@mail1.example.com")]), steps=5) is not None
