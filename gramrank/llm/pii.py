"""Personal data in texts: rules and a character tagger.

Rules find e-mail addresses, IP addresses, payment cards and phone numbers. A
bidirectional LSTM with CRF transitions, trained on the rules' spans in the corpus,
adds spans the rules miss, such as a number in another spelling. It looks wherever a
digit or an ``@`` stands: the stretches around them are cut into overlapping windows,
the windows' scores are averaged character by character, more weight on the middle of
a window, and each stretch is decoded as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramrank.llm.tagger import Tagger, char_ids
from gramrank.session import new_shared_path

#: The kinds in the order they are listed.
KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)

#: Texts whose windows the tagger is trained on, and windows of each, at most.
TRAIN_TEXTS = 1_500
TRAIN_WINDOWS = 4
TRAIN_STEPS = 500
WINDOW = 64
STRIDE = 32
MARGIN = 20
#: A span is added if the tagger is as sure of its characters on the average.
SURE = 0.9
LEAST_LENGTH = 7

TRIGGER = re.compile("[0-9@]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


class Span(NamedTuple):
    kind: int
    start: int
    end: int


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = (2 * v - 9 * (v > 4) for v in values[1::2])
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of a local part, ``@`` and a dotted domain, found from the ``@``
    so that long runs without one cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield Span(0, start, domain.end())
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def _ips(text: str) -> Iterator[Span]:
    """Four dotted numbers at a time of each longest dotted chain."""
    for chain in DOTTED.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = len(".".join(four))
            values = [p.lstrip("0") or "0" for p in four]
            if all(len(v) <= 3 and int(v) <= 255 for v in values):
                yield Span(1, at, at + size)
            at += size + 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the rules by kind, then start; offsets count code points."""
    found: list[Span] = []
    if not TRIGGER.search(text):
        return found
    found.extend(_emails(text))
    found.extend(_ips(text))
    for match in CARD.finditer(text):
        digits = _digits(match.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(Span(2, match.start(), match.end()))
    for match in PHONE.finditer(text):
        if 9 <= len(_digits(match.group())) <= 15:
            found.append(Span(3, match.start(), match.end()))
    return found


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


# Windows


def stretches(text: str) -> list[tuple[int, int]]:
    """Where a digit or ``@`` is near, as separate stretches from left to right."""
    found: list[tuple[int, int]] = []
    for match in TRIGGER.finditer(text):
        low, high = max(0, match.start() - MARGIN), min(len(text), match.end() + MARGIN)
        if found and low <= found[-1][1]:
            found[-1] = (found[-1][0], high)
        else:
            found.append((low, high))
    return found


def window_starts(size: int) -> list[int]:
    """Overlapping windows over a stretch of ``size``, the last one flush with its end."""
    if size <= WINDOW:
        return [0]
    starts = list(range(0, size - WINDOW, STRIDE))
    return [*starts, size - WINDOW]


def window_tags(spans: list[Span], low: int) -> np.ndarray:
    tags = np.zeros(WINDOW, dtype=np.int64)
    for kind, start, end in spans:
        a, b = max(start - low, 0), min(end - low, WINDOW)
        if a < b:
            tags[a:b] = 2 * kind + 2
            if start >= low:
                tags[a] = 2 * kind + 1
    return tags


def training_windows(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Character ids and tags of windows of texts with a trigger. Which texts and which
    windows is drawn by hashes; half the windows of a text hold a span, if it has any."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, tags = [], [], []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                spans = base_spans(text)
                places = [
                    (low + at, min(high, low + at + WINDOW))
                    for low, high in stretches(text)
                    for at in window_starts(high - low)
                ]
                draw = np.random.default_rng(key.as_py() % (1 << 32))
                order = draw.permutation(len(places)).tolist()
                marked = [i for i in order if window_tags(spans, places[i][0]).any()]
                marked = marked[: TRAIN_WINDOWS // 2] if spans else []
                for i in [*marked, *(i for i in order if i not in marked)][:TRAIN_WINDOWS]:
                    low, high = places[i]
                    keys.append(key.as_py())
                    ids.append(char_ids(text[low:high], WINDOW).tobytes())
                    tags.append(window_tags(spans, low).tobytes())
            yield pa.record_batch(
                [pa.array(keys, pa.int64()), pa.array(ids, pa.binary()), pa.array(tags, pa.binary())],
                names=["key", "ids", "tags"],
            )

    found = texts.mapInArrow(cut, "key long, ids binary, tags binary").toArrow()
    found = found.sort_by([("key", "ascending"), ("ids", "ascending")])
    stack = lambda name: np.array(
        [np.frombuffer(x.as_py(), dtype=np.int64) for x in found[name]]
    ).reshape(-1, WINDOW)
    return stack("ids"), stack("tags")


def smallest_keys(texts: DataFrame, most: int) -> DataFrame:
    """``[key, marked]``: the ``most`` smallest keys a task has of texts that hold a span
    of the rules, and of texts that do not."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bool, set[int]] = {True: set(), False: set()}
        below = {True: np.inf, False: np.inf}
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key >= max(below.values()) or key in kept[True] or key in kept[False]:
                    continue
                mark = bool(base_spans(text.as_py()))
                if key < below[mark]:
                    kept[mark].add(key)
                if len(kept[mark]) > 2 * most:
                    kept[mark] = set(sorted(kept[mark])[:most])
                    below[mark] = max(kept[mark], default=-np.inf)
        for mark, keys in kept.items():
            rows = sorted(keys)[:most]
            yield pa.record_batch(
                [pa.array(rows, pa.int64()), pa.array([mark] * len(rows), pa.bool_())],
                names=["key", "marked"],
            )

    return texts.mapInArrow(pick, "key long, marked boolean")


def train_tagger(
    docs: DataFrame, texts: int = TRAIN_TEXTS, steps: int = TRAIN_STEPS, seed: int = 9
) -> Tagger | None:
    """Tagger fitted on the rules' spans in a bounded number of texts: half of them hold a
    span, half a digit or ``@`` only, more of one kind if there are fewer of the other.
    Those with the smallest hash among all ``docs`` are taken. ``None`` if no text holds a
    span."""
    key = F.xxhash64("text", F.lit(seed))
    triggered = docs.where(F.col("text").rlike("[0-9@]")).select(key.alias("key"), "text")
    path = new_shared_path(docs.sparkSession, "tagger-draw")
    smallest_keys(triggered, texts).write.parquet(path)
    found = docs.sparkSession.read.schema("key long, marked boolean").parquet(path)
    smallest = lambda rows: [
        row["key"] for row in rows.select("key").distinct().orderBy("key").limit(texts).collect()
    ]
    marked, others = smallest(found.where("marked")), smallest(found.where("not marked"))
    marked = marked[: max(texts // 2, texts - len(others))]
    chosen = [(k,) for k in marked + others[: texts - len(marked)]]
    drawn = docs.sparkSession.createDataFrame(chosen, "key long")
    texts_drawn = triggered.join(F.broadcast(drawn), "key").dropDuplicates(["key"])
    ids, tags = training_windows(texts_drawn.select("key", "text"))
    if not (tags > 0).any():
        return None
    tagger = Tagger.new(TAGS)
    tagger.train(ids, tags, steps)
    return tagger.single()


# Finding


def _window_weights() -> np.ndarray:
    edge = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1.0
    return (edge / edge.max()).astype(np.float32)


def tagged_spans(texts: list[str], tagger: Tagger, batch: int = 512) -> list[list[Span]]:
    """Spans the tagger finds in each text."""
    places = [
        (i, low, high) for i, text in enumerate(texts) for low, high in stretches(text)
    ]
    found: list[list[Span]] = [[] for _ in texts]
    places.sort(key=lambda p: p[2] - p[1])
    low = 0
    while low < len(places):
        # stretches of like length, as many as give a batch of windows
        high, windows = low, 0
        while high < len(places) and (high == low or windows < batch):
            windows += len(window_starts(places[high][2] - places[high][1]))
            high += 1
        for (i, start, _), spans in zip(
            places[low:high], _decode(texts, places[low:high], tagger, batch), strict=True
        ):
            found[i].extend(Span(kind, start + a, start + b) for kind, a, b in spans)
        low = high
    return found


def _decode(texts: list[str], places: list, tagger: Tagger, batch: int) -> list[list[Span]]:
    sizes = [high - low for _, low, high in places]
    longest = max(sizes)
    emit = np.zeros((longest, len(places), TAGS), dtype=np.float32)
    weight = np.zeros((longest, len(places), 1), dtype=np.float32)
    each = _window_weights()[:, None]
    windows = [
        (k, at) for k, size in enumerate(sizes) for at in window_starts(size)
    ]
    for first in range(0, len(windows), batch):
        part = windows[first : first + batch]
        ids = np.stack(
            [
                char_ids(
                    texts[places[k][0]][
                        places[k][1] + at : min(places[k][1] + at + WINDOW, places[k][2])
                    ],
                    WINDOW,
                )
                for k, at in part
            ]
        )
        scores = tagger.emissions(ids)
        for j, (k, at) in enumerate(part):
            n = min(WINDOW, sizes[k] - at)
            emit[at : at + n, k] += each[:n] * scores[:n, j]
            weight[at : at + n, k] += each[:n]
    emit /= np.maximum(weight, 1e-6)
    for k, size in enumerate(sizes):
        emit[size:, k, 1:] = -1e4  # nothing stands after the end
    tags, sure = tagger.decode(emit)
    return [_runs(tags[:size, k], sure[:size, k]) for k, size in enumerate(sizes)]


def _runs(tags: np.ndarray, sure: np.ndarray) -> list[Span]:
    out, at = [], 0
    while at < len(tags):
        if tags[at] == 0:
            at += 1
            continue
        kind, end = (int(tags[at]) - 1) // 2, at + 1
        while end < len(tags) and tags[end] == 2 * kind + 2:
            end += 1
        if end - at >= LEAST_LENGTH and sure[at:end].mean() >= SURE:
            out.append(Span(kind, at, end))
        at = end
    return out


def added(base: list[Span], tagged: list[Span]) -> list[Span]:
    """The tagger's spans that touch none of the rules'."""
    return [
        s for s in tagged if not any(s.start < b.end and b.start < s.end for b in base)
    ]


class Found(NamedTuple):
    base: list[Span]
    more: list[Span]


def find_in(texts: list[str], tagger: Tagger | None) -> list[Found]:
    base = [base_spans(text) for text in texts]
    tagged = tagged_spans(texts, tagger) if tagger else [[] for _ in texts]
    return [Found(b, added(b, t)) for b, t in zip(base, tagged, strict=True)]


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, named by its kind."""
    out, at, merged = [], 0, []
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if merged and span.start < merged[-1].end:
            if span.end > merged[-1].end:
                merged[-1] = merged[-1]._replace(end=span.end)
        else:
            merged.append(span)
    for kind, start, end in merged:
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


RESULT = (
    "row {row}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
    " spans string, redacted string"
)


def find_personal_data(
    docs: DataFrame,
    carry: list[str] | None = None,
    with_text: bool = True,
    tagger: Tagger | None = None,
) -> DataFrame:
    """``[row, n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted]`` for each of
    ``docs``.

    The counts and ``base_sha256`` (of the rules' spans as listed) are the rules'; ``spans``
    lists theirs and the tagger's; ``redacted`` is the text without any of them (null if
    ``with_text`` is off). A null text is an empty one and stays null in ``redacted``.
    ``row`` has the columns ``carry`` of ``docs``, all of them by default. Repeated rows
    are looked at each for itself; an empty table gives no rows."""
    if tagger is None:
        tagger = train_tagger(docs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                whole = part.column("text").to_pylist()
                texts = [text or "" for text in whole]
                found = find_in(texts, tagger)
                counts = [
                    pa.array([sum(s.kind == k for s in f.base) for f in found], pa.int64())
                    for k in range(len(KINDS))
                ]
                digests = [
                    hashlib.sha256(listed(f.base).encode("ascii")).hexdigest() for f in found
                ]
                clean = [
                    None if t is None or not with_text else redact(t, f.base + f.more)
                    for t, f in zip(whole, found, strict=True)
                ]
                yield pa.record_batch(
                    [
                        part.column("row"),
                        *counts,
                        pa.array(digests, pa.string()),
                        pa.array([listed(f.base + f.more) for f in found], pa.string()),
                        pa.array(clean, pa.string()),
                    ],
                    names=[
                        "row",
                        *(f"n_{kind}" for kind in KINDS),
                        "base_sha256",
                        "spans",
                        "redacted",
                    ],
                )

    row = F.struct(*[F.col(f"`{name}`") for name in carry or docs.columns])
    plain = docs.select(row.alias("row"), "text")
    schema = RESULT.format(row=plain.schema["row"].dataType.simpleString())
    return plain.mapInArrow(find, schema)
