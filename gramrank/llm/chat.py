"""Chat formatting by schema fingerprint.

Records of a chat corpus come in many layouts: one prompt and one answer, an
instruction with input, lists of messages under several names. The fingerprint of a
record is a hash of its nested field paths. It selects a declarative mapping, an
expression that gives the record's turns, and the turns go through one template.
Nothing here runs Python on the executors.

The template marks turns with control strings. Where a text holds one, a backslash is
put after its first character, and backslashes are doubled, so that the formatted text
can be read back without loss.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
USER, ASSISTANT, OTHER = "[INST] ", "[/INST] ", "[ROLE="
#: Strings no text may hold in a formatted conversation.
CONTROL = (OPEN, CLOSE, "[INST]", "[/INST]", OTHER)

TURNS = "array<struct<role:string,text:string>>"


# Fingerprints and mappings


@dataclass(frozen=True)
class Mapping:
    """``paths``: the record's fields as Spark SQL prints their schema, names in order.
    ``turns``: SQL over ``record`` (a variant) for an array of ``role, text``."""

    name: str
    paths: str
    turns: str


def _field(path: str) -> str:
    return f"coalesce(variant_get(record, '$.{path}', 'string'), '')"


def _list(path: str, role: str, text: str) -> str:
    return (
        f"transform(variant_get(record, '$.{path}', 'array<variant>'), t -> named_struct("
        f"'role', coalesce(variant_get(t, '$.{role}', 'string'), ''),"
        f" 'text', coalesce(variant_get(t, '$.{text}', 'string'), '')))"
    )


def _pair(question: str, answer: str, system: str | None = None) -> str:
    first = f"named_struct('role', 'system', 'text', {system}), " if system else ""
    return (
        f"array({first}named_struct('role', 'user', 'text', {question}),"
        f" named_struct('role', 'assistant', 'text', {answer}))"
    )


#: ``from`` of message lists that name speakers otherwise.
SPEAKERS = {"human": "user", "gpt": "assistant"}

MAPPINGS = (
    Mapping(
        "messages",
        "OBJECT<messages: ARRAY<OBJECT<content: STRING, role: STRING>>>",
        _list("messages", "role", "content"),
    ),
    Mapping(
        "speakers",
        "OBJECT<conversations: ARRAY<OBJECT<from: STRING, value: STRING>>>",
        f"transform({_list('conversations', 'from', 'value')}, t -> named_struct('role',"
        + " case t.role "
        + " ".join(f"when '{name}' then '{role}'" for name, role in SPEAKERS.items())
        + " else t.role end, 'text', t.text))",
    ),
    Mapping(
        "prompt",
        "OBJECT<completion: STRING, prompt: STRING>",
        _pair(_field("prompt"), _field("completion")),
    ),
    Mapping(
        "instruction",
        "OBJECT<instruction: STRING, output: STRING>",
        _pair(_field("instruction"), _field("output")),
    ),
    Mapping(
        "instruction with input",
        "OBJECT<input: STRING, instruction: STRING, output: STRING>",
        _pair(_field("input"), _field("output"), _field("instruction")),
    ),
)


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant."""
    return F.xxhash64(F.schema_of_variant(record))


#: A longer record is never taken for a broken one: the JSON reader ends at strings of
#: this many characters.
LONGEST_STRING = 20_000_000


def canonical_turns(
    records: DataFrame,
    key: str,
    json: str,
    mappings: tuple[Mapping, ...] = MAPPINGS,
    texts: str | None = None,
) -> DataFrame:
    """``[key, layout, turns]`` of JSON records in any of the layouts of ``mappings``.

    ``layout`` is the mapping's name, and null, with null ``turns``, for a record of
    another layout or none. With ``texts``, an array column, the records hold positions in
    it instead of texts, and one that cannot be read is an error; so is one of more than
    20 million characters that the JSON reader refuses."""
    whole = F.col(json)
    record = F.parse_json(whole)
    if texts is None:
        long = F.length(whole) > LONGEST_STRING
        record = F.when(long, record).otherwise(F.try_parse_json(whole))
    known = records.select(
        key, record.alias("record"), *([F.col(texts).alias("texts")] if texts else [])
    ).withColumn("layout_hash", fingerprint(F.col("record")))
    chosen = [
        (F.col("layout_hash") == F.xxhash64(F.lit(m.paths)), m.name, F.expr(m.turns))
        for m in mappings
    ]
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for matches, name, expression in reversed(chosen):
        layout = F.when(matches, name).otherwise(layout)
        turns = F.when(matches, expression).otherwise(turns)
    if texts is not None:
        turns = F.transform(
            turns,
            lambda t: F.struct(
                t["role"].alias("role"),
                F.element_at("texts", t["text"].cast("int") + 1).alias("text"),
            ),
        )
    return known.select(key, layout.alias("layout"), turns.alias("turns"))


# Template


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("]"), F.lit("\\]"))


def _tag(role: Column) -> Column:
    return (
        F.when(role == "user", F.lit(USER))
        .when(role == "assistant", F.lit(ASSISTANT))
        .otherwise(F.concat(F.lit(OTHER), _escape_role(role), F.lit("] ")))
    )


def format_turns(conversations: DataFrame, key: str, turns: str) -> DataFrame:
    """``[key, formatted, loss_spans]``.

    A turn is ``<s>``, its role, its text and ``</s>``. ``loss_spans`` are start and end,
    in code points, of the assistant's texts within ``formatted``. No turns give an
    empty text. Null roles and texts are empty."""
    parts = F.transform(
        F.col(turns),
        lambda t: F.struct(
            F.concat(F.lit(OPEN), _tag(F.coalesce(t["role"], F.lit("")))).alias("head"),
            escape(F.coalesce(t["text"], F.lit(""))).alias("text"),
            (F.coalesce(t["role"], F.lit("")) == "assistant").alias("loss"),
        ),
    )
    written = conversations.select(key, parts.alias("parts"))
    formatted = F.array_join(
        F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(CLOSE))), ""
    )
    no_spans = F.array().cast("array<struct<start:long,end:long>>")
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).cast("long").alias("at"), no_spans.alias("spans")),
        lambda state, p: F.struct(
            (state["at"] + F.length(p["head"]) + F.length(p["text"]) + len(CLOSE)).alias("at"),
            F.when(
                p["loss"],
                F.concat(
                    state["spans"],
                    F.array(
                        F.struct(
                            (state["at"] + F.length(p["head"])).alias("start"),
                            (state["at"] + F.length(p["head"]) + F.length(p["text"])).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(state["spans"])
            .alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return written.select(key, formatted.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, roles and texts as they were."""
    # possessive: the regex engine would keep a stack frame for each character of a role
    named = r"(?s)^<s>\[ROLE=((?:\\.|[^\\\]])*+)\] (.*)$"

    def turn(part: Column) -> Column:
        user, assistant = F.lit(OPEN + USER), F.lit(OPEN + ASSISTANT)
        role = (
            F.when(F.startswith(part, user), "user")
            .when(F.startswith(part, assistant), "assistant")
            .otherwise(unescape(F.regexp_extract(part, named, 1)))
        )
        text = (
            F.when(F.startswith(part, user), F.substr(part, F.length(user) + 1))
            .when(F.startswith(part, assistant), F.substr(part, F.length(assistant) + 1))
            .otherwise(F.regexp_extract(part, named, 2))
        )
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(F.filter(F.split(formatted, CLOSE), lambda p: p != ""), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between the spans."""
    texts = F.transform(
        spans,
        lambda s: unescape(
            F.substr(
                formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")
            )
        ),
    )
    return F.array_join(texts, "")


# Rows by turn


def gather_turns(rows: DataFrame) -> DataFrame:
    """``[conv_id, turns]`` of rows ``conv_id, turn, role, text``: in order of the turn,
    equal turns by role and text. Null roles and texts are empty, a null ``conv_id`` is
    a conversation."""
    one = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    in_order = F.transform(
        F.array_sort(F.collect_list(one)), lambda t: F.struct(t["role"], t["text"])
    )
    return rows.groupBy("conv_id").agg(in_order.cast(TURNS).alias("turns"))


def as_records(conversations: DataFrame) -> DataFrame:
    """``[conv_id, record, texts]``: conversations as JSON in the layouts they come in: a
    pair of user and assistant as prompt or instruction, anything else as a message list,
    the choice made by a hash of the id. The JSON holds the positions of the texts in
    ``texts``, which may be of any length."""
    turns = F.transform(
        "turns", lambda t, i: F.struct(t["role"].alias("role"), i.cast("string").alias("text"))
    )
    draw = F.pmod(F.xxhash64("conv_id"), F.lit(2))
    role = lambda i: F.try_element_at(turns["role"], F.lit(i))
    text = lambda i: F.try_element_at(turns["text"], F.lit(i))
    roles = F.array_join(turns["role"], ",")
    pair = (F.size(turns) == 2) & (roles == "user,assistant")
    triple = (F.size(turns) == 3) & (roles == "system,user,assistant")
    plain = ~F.exists(turns, lambda t: t["role"].isin(*SPEAKERS))
    renamed = F.transform(
        turns,
        lambda t: F.struct(
            F.when(t["role"] == "user", "human")
            .when(t["role"] == "assistant", "gpt")
            .otherwise(t["role"])
            .alias("from"),
            t["text"].alias("value"),
        ),
    )
    messages = F.transform(
        turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))
    )
    record = (
        F.when(
            pair & (draw == 0),
            F.to_json(F.struct(text(1).alias("prompt"), text(2).alias("completion"))),
        )
        .when(
            pair,
            F.to_json(F.struct(text(1).alias("instruction"), text(2).alias("output"))),
        )
        .when(
            triple & (draw == 0),
            F.to_json(
                F.struct(
                    text(1).alias("instruction"), text(2).alias("input"), text(3).alias("output")
                )
            ),
        )
        .when(plain & (draw == 1), F.to_json(F.struct(renamed.alias("conversations"))))
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return conversations.select(
        "conv_id", record.alias("record"), F.col("turns")["text"].alias("texts")
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """``[conv_id, formatted, loss_spans]`` of rows ``conv_id, turn, role, text`` by way
    of their records. Other columns are ignored; an empty table gives no rows; repeated
    rows are repeated turns."""
    records = as_records(gather_turns(rows.select("conv_id", "turn", "role", "text")))
    turns = canonical_turns(records, "conv_id", "record", texts="texts")
    return format_turns(turns, "conv_id", "turns")
