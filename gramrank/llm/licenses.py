"""Licence scans: notice phrases and identifier tags, and the expressions behind tags.

An Aho-Corasick automaton runs once over a text's words and finds every notice phrase
and every tag. What follows a tag is a licence expression; a shunting-yard parser turns
it into postfix order, which is then evaluated for the licences it names and for
whether a set of accepted licences fulfils it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

#: Phrases whose places are counted, with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notices; a label of its own for each.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG_WORDS = "spdx license identifier"
TAG = re.compile(r"SPDX-License-Identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.:-]*\+?)")
#: Licences that grant use with notices kept at most.
PERMISSIVE = frozenset(
    "mit apache-2.0 bsd-2-clause bsd-3-clause isc zlib unlicense cc0-1.0 cc-by-4.0 0bsd".split()
)
BINDING = {"or": 1, "and": 2, "with": 3}

#: Lower case, every other ASCII character but digits a blank; UTF-8 parts stay.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

RESULT = (
    "doc_id {id}, n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double, expressions array<string>,"
    " permissive boolean"
)


def postfix(expression: str) -> list[str] | None:
    """Licences and operators in postfix order; ``None`` if no expression starts the
    text. What cannot continue the expression ends it, so comments may follow."""
    output: list[str] = []
    waiting: list[str] = []
    operand, at = True, 0
    while match := TOKEN.match(expression, at):
        token, word = match[1], match[1].lower()
        if operand and token == "(":
            waiting.append(token)
        elif operand and token != ")" and word not in BINDING:
            output.append(word)
            operand = False
        elif not operand and token == ")":
            if "(" not in waiting:
                break
            while (top := waiting.pop()) != "(":
                output.append(top)
        elif not operand and word in BINDING:
            while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= BINDING[word]:
                output.append(waiting.pop())
            waiting.append(word)
            operand = True
        else:
            break
        at = match.end()
    if operand or "(" in waiting:
        return None
    return output + waiting[::-1]


def evaluate(steps: list[str], accepted: frozenset[str]) -> tuple[set[str], bool] | None:
    """Licences named and whether ``accepted`` fulfils the expression; an exception
    only adds permissions. ``None`` if an exception has no plain licence before it."""
    stack: list[tuple[set[str], bool, bool]] = []
    for step in steps:
        if step not in BINDING:
            stack.append(({step}, step.rstrip("+") in accepted, True))
            continue
        right, left = stack.pop(), stack.pop()
        if step == "with":
            if not (left[2] and right[2]):
                return None
            stack.append(({f"{min(left[0])} with {min(right[0])}"}, left[1], False))
        elif step == "and":
            stack.append((left[0] | right[0], left[1] and right[1], False))
        else:
            stack.append((left[0] | right[0], left[1] or right[1], False))
    return stack[0][0], stack[0][1]


def parse(expression: str, accepted: frozenset[str] = PERMISSIVE) -> tuple[set[str], bool] | None:
    steps = postfix(expression)
    return evaluate(steps, accepted) if steps else None


@dataclass
class Scan:
    n_words: int
    places: list[tuple[int, str]]
    notices: set[str]
    expressions: list[str]
    named: set[str]
    permissive: bool | None

    @property
    def score(self) -> float:
        """1 with an identifier tag that parses, else one half more of what is missing
        for every different label a notice gives."""
        labels = self.notices | {label for _, label in self.places}
        return 1.0 if self.named else 1.0 - 0.5 ** len(labels)


def scanner(accepted: frozenset[str] = PERMISSIVE) -> Callable[[str], Scan]:
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for phrase in [*BASE_PHRASES, *NOTICE_PHRASES, TAG_WORDS]:
        automaton.add_word(f" {phrase} ", phrase)
    automaton.make_automaton()

    def scan(text: str) -> Scan:
        words = text.encode("utf-8", "surrogatepass").translate(FOLD).split()
        # one character per byte; a blank before and after every word
        line = f" {b' '.join(words).decode('latin-1')} " if words else ""
        found = Scan(len(words), [], set(), [], set(), None)
        tagged = False
        passed = counted = 0  # words up to the last match, and where it ends
        for end, phrase in automaton.iter(line):
            if phrase in BASE_PHRASES:
                passed += line.count(" ", counted, end)
                counted = end
                found.places.append((passed - len(phrase.split()), BASE_PHRASES[phrase]))
            elif phrase == TAG_WORDS:
                tagged = True
            else:
                found.notices.add(NOTICE_PHRASES[phrase])
        if tagged:
            for match in TAG.finditer(text):
                if parsed := parse(match[1], accepted):
                    found.expressions.append(match[1].strip())
                    found.named |= parsed[0]
                    found.permissive = parsed[1] and found.permissive is not False
        return found

    return scan


def scan_licenses(docs: DataFrame, accepted: frozenset[str] = PERMISSIVE) -> DataFrame:
    """A row for each of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    ``n_words`` words; ``n_base`` places of base phrases, ``first_word`` and
    ``last_word`` the first and last of them (null without any); ``base_labels`` their
    labels; ``labels`` these with those of further notices and of tagged expressions;
    ``score`` from 0 (no notice) to 1 (an identifier tag); ``expressions`` as written;
    ``permissive`` whether ``accepted`` fulfils all of them (null without any). A null
    text is an empty one: no words, empty labels, score 0. Repeated rows are scanned
    each for itself; an empty table gives no rows.
    """

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(accepted)
        for batch in batches:
            scans = [scan(text.as_py() or "") for text in batch.column(1)]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([s.n_words for s in scans], pa.int64()),
                    pa.array([len(s.places) for s in scans], pa.int64()),
                    pa.array([min(s.places)[0] if s.places else None for s in scans], pa.int64()),
                    pa.array([max(s.places)[0] if s.places else None for s in scans], pa.int64()),
                    pa.array([_joined({x for _, x in s.places}) for s in scans], pa.string()),
                    pa.array(
                        [_joined({x for _, x in s.places} | s.notices | s.named) for s in scans],
                        pa.string(),
                    ),
                    pa.array([s.score for s in scans], pa.float64()),
                    pa.array([s.expressions for s in scans], pa.list_(pa.string())),
                    pa.array([s.permissive for s in scans], pa.bool_()),
                ],
                names=[part.split()[0] for part in RESULT.split(", ")],
            )

    plain = docs.select("doc_id", "text")
    return plain.mapInArrow(
        scan_batches, RESULT.format(id=plain.schema["doc_id"].dataType.simpleString())
    )


def _joined(labels: set[str]) -> str:
    return ",".join(sorted(labels))
