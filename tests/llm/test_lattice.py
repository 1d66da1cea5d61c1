import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from gramrank.llm import lattice as L

PATH = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "Hello  world",
    "  a\nb\t c 123,45",
    "trail   ",
    "é naïve 你好　x \U0001f600 ﬁ",
    "Anblewh sttible athawh; (the) representation's",
    "a▁b",
    "=" * 90 + " " + "characteristics" * 9,
    "\x00\x01 <s> </s> <unk> <0x0A>",
    "",
    None,
    " ",
    "same same same",
]


@pytest.fixture(scope="module")
def model():
    return L.load_model(PATH)


def test_ids_are_the_librarys(docs, model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [*enumerate(TEXTS), (11, "same same same"), (None, "no id")]
    encoded = L.encode(docs(rows), model)
    found = encoded.select("doc_id", "ids", L.decode(F.col("ids"), model).alias("text")).collect()
    assert len(found) == len(rows)
    want = dict(rows)
    for row in found:
        text = want[row["doc_id"]] or ""
        assert row["ids"] == library.encode(text), text
        assert row["text"] == text.replace("▁", " ")
    assert L.encode(docs([]), model).count() == 0


def test_long_units_merge_alike(model):
    scores = {piece: (i, score) for piece, i, score in model.pieces}
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for word in ("international" * 12, "----" * 33, "aaaa" * 40, "ab" * 60 + "é你"):
        assert L.merge_long("▁" + word, scores, model.byte_ids) == library.encode(word)


def test_odd_words_are_encoded_as_by_the_library(docs, model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    parts = ["th", "erhe", "ion", "ç", "é", "ing", "st", "ü", "pa", "xq", "-", "The", "ß", "1"]
    rows = [
        (i, " ".join("".join(parts[(i * j + k * k) % 14] for k in range(j % 9)) for j in range(40)))
        for i in range(14)
    ]
    found = {r["doc_id"]: r["ids"] for r in L.encode(docs(rows), model).collect()}
    assert found == {i: library.encode(text) for i, text in rows}


def test_a_piece_may_be_joined_after_its_turn(spark):
    """``abc`` comes first, but only ``ab`` makes it possible."""
    pieces = {"a": -90.0, "b": -91.0, "c": -92.0, "abc": -1.0, "ab": -5.0}
    model = L.Model(
        tuple((p, i, s) for i, (p, s) in enumerate(pieces.items())),
        tuple(p.encode() for p in pieces),
        tuple(range(100, 356)),
        merges=True,
    )
    assert model.late() == {"abc"}
    units = spark.createDataFrame([("abcab",), ("ab",), ("cab",), ("aé",)], "unit string")
    found = {r["unit"]: r["ids"] for r in L.encode_units(units, model).collect()}
    assert found == {"abcab": [3, 4], "ab": [4], "cab": [2, 4], "aé": [0, 100 + 0xC3, 100 + 0xA9]}


def test_a_block_sends_each_unit_once(docs, model):
    text = L.mark_blanks(F.col("text")).alias("text")
    rows = docs([(i, "the same words, 25 times " * 25) for i in range(40)], files=1)
    blocks = L.read_blocks(rows.select("doc_id", text), model).cache()
    units = [r["unit"] for r in blocks.where("unit is not null").collect()]
    assert len(units) == len(set(units)) < 12
    assert blocks.where("texts is not null").count() == 1


def test_viterbi_takes_the_best_path(spark):
    """A unigram model's fold against all paths."""
    pieces = {"a": -2.0, "b": -2.0, "ab": -3.5, "ba": -1.0, "aba": -4.2, "bab": -2.5}
    model = L.Model(
        tuple((p, i, s) for i, (p, s) in enumerate(pieces.items())),
        tuple(p.encode() for p in pieces),
        tuple(range(100, 356)),
        merges=False,
    )

    def best(text):
        paths = [(0.0, ())] + [None] * len(text)
        for end in range(1, len(text) + 1):
            ways = [
                (paths[s][0] + pieces[text[s:end]], (*paths[s][1], text[s:end]))
                for s in range(end)
                if text[s:end] in pieces
            ]
            paths[end] = max(ways, key=lambda w: w[0])
        return paths[-1][0]

    units = ["a", "ab", "abab", "babab", "aabba", "bbabaab"]
    df = spark.createDataFrame([(u,) for u in units], "unit string")
    names = list(pieces)
    for row in L.encode_units(df, model).collect():
        parts = [names[i] for i in row["ids"]]
        assert "".join(parts) == row["unit"]
        assert sum(pieces[p] for p in parts) == pytest.approx(best(row["unit"]))
