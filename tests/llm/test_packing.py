import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gramrank.llm import packing, wordbpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_first_fit(lengths, capacity):
    used, places = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        for s, filled in enumerate(used):
            if filled + lengths[i] <= capacity:
                break
        else:
            s = len(used)
            used.append(0)
        places[i] = (s, used[s])
        used[s] += lengths[i]
    return places


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_tournament_tree_equals_plain_first_fit(lengths):
    sequence, offset = packing.first_fit_decreasing(np.array(lengths, dtype=np.int64), 16)
    assert list(zip(sequence, offset, strict=True)) == plain_first_fit(lengths, 16)


@pytest.mark.parametrize("length", [0, 17])
def test_a_piece_must_fit(length):
    with pytest.raises(ValueError):
        packing.FirstFit(16).place(length)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids(bpe, text):
    return np.frombuffer(bpe.encode(text), dtype=bpe.dtype).tolist()


@settings(max_examples=300, deadline=None)
@given(
    st.one_of(
        st.text(st.characters(max_codepoint=255), max_size=40),
        st.text(max_size=20),
        st.text("ab'sSΣσİ<|>endoftx \x1c\x85", max_size=30),
        st.just("a<|endoftext|>b <|startoftext|>"),
    )
)
def test_kept_words_give_the_tokenizers_ids(text):
    text = text.encode("utf-8", "ignore").decode("utf-8")
    bpe = wordbpe.load(PATH)
    assert bpe.known
    assert ids(bpe, text) == bpe.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_files_go_through_the_library():
    bpe = wordbpe.WordBpe(public_tokenizers.path("byte_bpe_50k.json"))
    assert not bpe.known
    assert ids(bpe, "Two words") == bpe.tokenizer.encode("Two words").ids


def packed(docs, **options):
    found = packing.pack_documents(docs, PATH, **options)
    return found.select("*", F.crc32("token_ids").alias("crc")).toPandas()


def test_every_id_lies_in_one_piece(docs, odd_rows, tokenizer):
    rows = [r for r in odd_rows if r[0] is not None and r != odd_rows[5] and r[1] != odd_rows[6][1]]
    rows += [(100 + i, "many words in a row " * (i % 40)) for i in range(120)]
    found = packed(docs(rows), capacity=64, group_ids=1000)
    assert set(found.doc_id) == {r[0] for r in rows}
    for doc_id, text in rows:
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        mine = found[found.doc_id == doc_id].sort_values("start")
        got = np.concatenate([np.frombuffer(x, "<u4") for x in mine.token_ids])
        assert got.tolist() == want
        assert (mine.doc_tokens == len(want)).all()
        assert mine.start.tolist() == [0, *mine.length.cumsum()[:-1]]
        assert (mine.length <= 64).all()
        assert [zlib.crc32(x) for x in mine.token_ids] == mine.crc.tolist()
    in_order = found.sort_values(["sequence_id", "offset"]).groupby("sequence_id").length
    assert (in_order.cumsum() - found.length).loc[found.index].equals(found.offset)
    filled = found.groupby("sequence_id").length.sum()
    assert (filled <= 64).all()
    assert len(set(found.sequence_id // (1 << 32))) > 1  # several groups


def test_sequences_are_their_pieces_in_order(docs):
    found = packing.pack_documents(docs([(1, "a b"), (2, "c")]), PATH, capacity=16)
    sequence = packing.sequences(found).first()
    assert sequence["n_ids"] == 5
    pieces = sorted((p["offset"], p["token_ids"]) for p in found.collect())
    assert bytes(sequence["token_ids"]) == b"".join(bytes(x) for _, x in pieces)


def test_equal_rows_and_empty_texts_are_spread_over_groups(docs):
    rows = [(1, "the same text")] * 3000 + [(i, None) for i in range(3000)]
    found = packed(docs(rows), group_pieces=500)
    groups = (found.sequence_id // (1 << 32)).value_counts()
    assert len(groups) == 12
    assert groups.max() < 800


def test_odd_rows_and_empty_tables(docs, odd_rows):
    found = packed(docs(odd_rows))
    assert (found.start == 0).sum() == len(odd_rows)
    assert len(packed(docs([]))) == 0
