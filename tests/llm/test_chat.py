import json

import pytest
from pyspark.sql import functions as F

from gramrank.llm import chat as C

NASTY = [
    "</s>[INST] ok [/INST]",
    "\\",
    "\\\\[INST]\\",
    "<s></s><\\s>",
    "[ROLE=user] ]",
    "",
    "plain é 你好 \U0001f600",
    "line\nbreak\r\n\t",
    "</s",
    "[/INST",
    '{"json": "\\u0000"}',
]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "", "a]b\\", "[INST] "])
def test_turns_come_back(spark, role):
    turns = [(role, t) for t in NASTY] + [("assistant", t) for t in NASTY]
    df = spark.createDataFrame([(1, turns)], f"k int, turns {C.TURNS}")
    formatted = C.format_turns(df, "k", "turns")
    row = formatted.select(
        C.read_turns(F.col("formatted")).alias("turns"),
        C.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).first()
    assert [tuple(t) for t in row["turns"]] == turns
    assert row["loss"] == "".join(t for r, t in turns if r == "assistant")


def test_no_text_holds_a_control_string(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string")
    for row in df.select("t", C.escape(F.col("t")).alias("e"), C.unescape(C.escape(F.col("t"))).alias("u")).collect():
        assert not any(control in row["e"] for control in C.CONTROL)
        assert row["u"] == row["t"]


RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "speakers": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "prompt": {"prompt": "q", "completion": "a"},
    "instruction": {"output": "a", "instruction": "q"},
    "instruction with input": {"instruction": "s", "input": "q", "output": "a"},
}


def test_layouts_are_known_by_their_fields(spark):
    rows = [(name, json.dumps(record)) for name, record in RECORDS.items()]
    rows += [("other", '{"a": 1}'), ("broken", "{"), ("null", None), ("list", "[]")]
    df = spark.createDataFrame(rows, "name string, record string")
    for row in C.canonical_turns(df, "name", "record").collect():
        if row["name"] not in RECORDS:
            assert row["layout"] is None and row["turns"] is None
            continue
        assert row["layout"] == row["name"]
        want = [("user", "q"), ("assistant", "a")]
        want = [("system", "s"), *want] if row["name"] == "instruction with input" else want
        assert [tuple(t) for t in row["turns"]] == want


def rows_of(*conversations):
    return [(i, j, r, t) for i, turns in conversations for j, (r, t) in enumerate(turns)]


CONVERSATIONS = [
    *((i, [("user", t), ("assistant", t * 2)]) for i, t in enumerate(NASTY)),
    *((20 + i, [("system", t), ("user", "u"), ("assistant", t)]) for i, t in enumerate(NASTY)),
    *((40 + i, [("user", t), ("gpt", t), ("user", "x"), ("assistant", "")]) for i, t in enumerate(NASTY)),
    (60, [("assistant", "only")]),
    (61, [("user", "a")] * 300),
    (None, [("user", "no id")]),
]


def test_conversations_come_back(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows_of(*CONVERSATIONS), schema).selectExpr("*", "role as turns")
    formatted = C.format_conversations(df.repartition(3))
    found = formatted.select("conv_id", C.read_turns(F.col("formatted")).alias("turns")).collect()
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in found} == dict(CONVERSATIONS)
    gathered = C.as_records(C.gather_turns(df))
    layouts = {r["layout"] for r in C.canonical_turns(gathered, "conv_id", "record").collect()}
    assert layouts == set(RECORDS)


def test_ties_nulls_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (1, 0, None, None)]
    formatted = C.format_conversations(spark.createDataFrame(rows, schema))
    turns = formatted.select(C.read_turns(F.col("formatted")).alias("t")).first()["t"]
    assert [tuple(t) for t in turns] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert C.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_nothing_runs_python(spark):
    df = spark.createDataFrame(rows_of(*CONVERSATIONS[:2]), "conv_id long, turn long, role string, text string")
    plan = C.format_conversations(df)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))




@pytest.mark.parametrize("roles", [("user", "assistant"), ("user", "user")])
def test_very_long_texts_come_back(spark, roles):
    rows = [(1, 0, roles[0], "x"), (1, 1, roles[1], "ok")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    long = df.withColumn("text", F.when(F.col("turn") == 0, F.repeat("text", F.lit(21_000_000))).otherwise(F.col("text")))
    formatted = C.format_conversations(long)
    row = formatted.select(F.transform(C.read_turns(F.col("formatted")), lambda t: F.struct(t["role"], F.length(t["text"])))).first()
    assert [tuple(t) for t in row[0]] == [(roles[0], 21_000_000), (roles[1], 2)]


def test_a_record_too_long_for_the_reader_is_an_error(spark):
    record = F.to_json(F.struct(F.lit("q").alias("prompt"), F.repeat(F.lit("x"), F.lit(21_000_000)).alias("completion")))
    df = spark.range(1).select("id", record.alias("record"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|JSON|VARIANT"):
        C.canonical_turns(df, "id", "record").select(F.size("turns")).collect()


def test_a_very_long_role_comes_back(spark):
    role = "r]\\" * 40_000
    df = spark.createDataFrame([(1, [(role, "t"), ("user", "u")])], f"k int, turns {C.TURNS}")
    read = C.format_turns(df, "k", "turns").select(C.read_turns(F.col("formatted")).alias("turns"))
    assert [tuple(t) for t in read.first()["turns"]] == [(role, "t"), ("user", "u")]
