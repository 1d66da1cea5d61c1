import time

import llm_plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gramrank.llm import licenses as L


@pytest.mark.parametrize(
    "text, steps",
    [
        ("MIT", ["mit"]),
        ("MIT OR Apache-2.0 AND BSD-3-Clause", ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]),
        ("(MIT or ISC) and Zlib", ["mit", "isc", "or", "zlib", "and"]),
        ("GPL-2.0+ WITH Bison-exception-2.2 OR MIT", ["gpl-2.0+", "bison-exception-2.2", "with", "mit", "or"]),
        ("MIT */ more words", ["mit"]),
        ("MIT -->", ["mit"]),
        ("(MIT", None),
        ("AND MIT", None),
        ("MIT OR", None),
        ("", None),
        ("MIT) x", ["mit"]),
    ],
)
def test_postfix(text, steps):
    assert L.postfix(text) == steps


def test_evaluation():
    accepted = frozenset({"mit", "gpl-2.0"})
    assert L.parse("MIT AND X11", accepted) == ({"mit", "x11"}, False)
    assert L.parse("MIT OR X11", accepted) == ({"mit", "x11"}, True)
    assert L.parse("X11 OR GPL-2.0+ WITH Foo AND MIT", accepted) == (
        {"x11", "gpl-2.0+ with foo", "mit"},
        True,
    )
    assert L.parse("(MIT OR ISC) WITH Foo", accepted) is None


expressions = st.recursive(
    st.sampled_from(["a", "b", "c"]),
    lambda inner: st.tuples(inner, st.sampled_from([" or ", " and "]), inner).map(
        lambda p: f"({p[0]}{p[1]}{p[2]})"
    ),
    max_leaves=12,
)


@settings(max_examples=100, deadline=None)
@given(expressions, st.sets(st.sampled_from(["a", "b", "c"])))
def test_evaluation_equals_pythons(text, accepted):
    want = eval(text, {}, {name: name in accepted for name in "abc"})  # noqa: S307
    assert L.parse(text, frozenset(accepted))[1] == want


ODD = [
    "GNU General Public License, the MIT-License. mit license",
    "smit license mit licenses",
    "cc by cc-by; CC BY-NC 4.0",
    "éapache license apacheé license",
    "mit\x00license gnu general public general public license",
    None,
    "",
]


def test_base_places_equal_a_plain_search(docs):
    rows = [(i, text) for i, text in enumerate(ODD)]
    found = {r["doc_id"]: r for r in L.scan_licenses(docs(rows)).collect()}
    for doc_id, text in rows:
        n, places = llm_plain.license_places(text, L.BASE_PHRASES)
        row = found[doc_id]
        assert (row["n_words"], row["n_base"]) == (n, len(places))
        assert row["first_word"] == (places[0][0] if places else None)
        assert row["last_word"] == (places[-1][0] if places else None)
        labels = sorted({label for _, label in places})
        assert row["base_labels"] == ",".join(labels)
        assert set(labels) <= set(row["labels"].split(","))  if labels else True
        assert 0 <= row["score"] <= 1
    assert "cc-by-nc" in found[2]["labels"].split(",")
    assert found[6]["labels"] == "" and found[6]["score"] == 0


def test_tags(docs):
    text = "# SPDX-License-Identifier: MIT OR GPL-3.0-only\nx\n// spdx-license-identifier: X11 */"
    row = L.scan_licenses(docs([(1, text)])).first()
    assert row["expressions"] == ["MIT OR GPL-3.0-only", "X11 */"]
    assert row["labels"] == "gpl-3.0-only,mit,x11"
    assert (row["permissive"], row["score"], row["base_labels"]) == (False, 1.0, "")


def test_odd_rows_and_empty_tables(docs, odd_rows):
    assert L.scan_licenses(docs(odd_rows)).count() == len(odd_rows)
    assert L.scan_licenses(docs([])).count() == 0


def test_many_notices_in_one_text_take_time_in_proportion():
    """A hundred thousand of them in seconds, each at its place."""
    scan = L.scanner()
    began = time.perf_counter()
    found = scan("apache license cc by mit license " * 40_000)
    assert time.perf_counter() - began < 10
    assert found.places[:4] == [(0, "apache"), (2, "cc-by"), (4, "mit"), (6, "apache")]
    assert len(found.places) == 120_000 and found.places[-1] == (239_998, "mit")
