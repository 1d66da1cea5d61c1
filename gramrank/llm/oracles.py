"""The training-data queries in the checking engine's SQL, where SQL can express them."""

from __future__ import annotations


OP4 = """
    with texts as (select doc_id, coalesce(text, '') as text from documents)
    select doc_id, max(doc_id) over copies as keep_id, count(*) over copies as group_size,
        doc_id = max(doc_id) over copies as kept, sha256(text) as text_sha256
    from texts window copies as (partition by text)
"""


OP7 = """
    with payloads as (
        select page_id, coalesce(html, '') as html from pages
    ), hashed as (
        select page_id, octet_length(encode(html)) as payload_bytes, sha1(html) as hex,
            min(page_id) over (partition by html) as first_id
        from payloads
    )
    select page_id, payload_bytes,
        translate(
            to_base(cast('0x' || substr(hex, 1, 10) as bigint), 32, 8)
            || to_base(cast('0x' || substr(hex, 11, 10) as bigint), 32, 8)
            || to_base(cast('0x' || substr(hex, 21, 10) as bigint), 32, 8)
            || to_base(cast('0x' || substr(hex, 31, 10) as bigint), 32, 8),
            '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
        ) as payload_digest,
        case when page_id = first_id then 'response' else 'revisit' end as record_type,
        case when page_id <> first_id then first_id end as refers_to
    from hashed
"""

_ESCAPED = "replace(text, chr(92), chr(92) || chr(92))"
for _control in ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE="):
    _ESCAPED = (
        f"replace({_ESCAPED}, '{_control}', '{_control[0]}' || chr(92) || '{_control[1:]}')"
    )

OP9 = f"""
    with rows as (
        select conv_id, turn, role, coalesce(text, '') as text from conversations
        union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
        union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), sized as (
        select *, length('<s></s>') + length({_ESCAPED}) + case role
            when 'user' then length('[INST] ') when 'assistant' then length('[/INST] ')
            else length('[ROLE=] ') + length(role) end as chars
        from rows
    ), joined as (
        select conv_id, count(*) as n_turns, sum(chars) as formatted_chars,
            string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
            coalesce(string_agg(case when role = 'assistant' then text end, ''
                order by turn, role, text), '') as loss
        from sized group by conv_id
    )
    select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars,
        sha256(loss) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars
    from joined
"""


# A run's CRC-32 is folded over a list of its bytes, each followed by eight steps (-1).
# Near words share what a deleted letter leaves: at one place, or one of them itself.
OP12 = """
    with recursive runs as (
        select coalesce(cast(doc_id as varchar), '') as doc_id, translate(
            unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
        from documents
    ), counted as (
        select run, count(*) as n, hex(encode(doc_id || ':' || run)) as hex
        from runs where length(run) >= 7 group by doc_id, run
    ), drawn as (
        select run, n, xor(list_reduce(
            list_prepend(4294967295::bigint, flatten([
                [('0x' || substr(hex, 2 * i + 1, 2))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]
                for i in range(length(hex) // 2)])),
            lambda c, b: case when b >= 0 then xor(c, b)
                else xor(c >> 1, (c & 1) * 3988292384) end
        ), 4294967295) as h
        from counted
    ), slipped as (
        select n, case when h % 31 <> 0 then run
            else left(run, h % length(run)) || substr(run, h % length(run) + 2) end as word
        from drawn
    ), words as (
        select word, cast(sum(n) as bigint) as n from slipped
        where length(word) >= 7 group by word having sum(n) >= 2
    ), places as (
        select word, n, unnest(range(1, length(word) + 1)) as place from words
    ), shorter as (
        select word, n, place, left(word, place - 1) || substr(word, place + 1) as rest
        from places
    ), near as (
        select a.word, a.n, b.word as near, b.n as near_n
        from shorter a join shorter b on a.place = b.place and a.rest = b.rest
        where a.word <> b.word
        union select s.word, s.n, w.word, w.n from shorter s join words w on s.rest = w.word
        union select w.word, w.n, s.word, s.n from shorter s join words w on s.rest = w.word
    ), ranked as (
        select *, count(*) over (partition by word) as n_near,
            row_number() over (partition by word order by near_n desc, near) as place
        from near
    ), formed as (
        select word, n_near, case when near_n >= 10 * n then near end as form,
            case when near_n >= 10 * n then near_n end as form_n
        from ranked where place = 1
    ), steps as (
        select word, form as root, 1 as depth from formed where form is not null
        union all
        select s.word, f.form, s.depth + 1 from steps s join formed f on s.root = f.word
        where f.form is not null
    ), ends as (
        select word, arg_max(root, depth) as root from steps group by word
    )
    select w.word, f.form, coalesce(e.root, w.word) as root, w.n,
        coalesce(f.n_near, 0) as n_near, f.form_n
    from words w left join formed f using (word) left join ends e using (word)
"""


OP13 = """
    with vectors as (
        select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as vector
        from embeddings
        where label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select a.id as anchor_id, a.label as anchor_label, r.id, r.label,
            coalesce(list_sum(list_transform(list_zip(a.vector, r.vector),
                lambda p: p[1] * p[2])), 0)::bigint as score
        from vectors a, vectors r where a.id % 50 = 0
    ), positives as (
        select anchor_id, anchor_label, id as positive_id, score as positive_score,
            row_number() over (partition by anchor_id order by score desc, id) as place
        from scored where label = anchor_label and id <> anchor_id
    ), ranked as (
        select p.anchor_id, positive_id, s.id as negative_id, positive_score,
            s.score as negative_score, row_number() over (
                partition by p.anchor_id, positive_id order by s.score desc, s.id) as rank
        from positives p join scored s on p.anchor_id = s.anchor_id
        where place <= 5 and s.label <> p.anchor_label
            and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
    )
    select anchor_id, positive_id, cast(rank as integer) as rank, negative_id,
        positive_score, negative_score
    from ranked where rank <= 3
"""


def build() -> dict[str, str]:
    return {
        "op4_stream_dedup": OP4,
        "op7_warc": OP7,
        "op9_chat": OP9,
        "op12_spelling": OP12,
        "op13_hard_negatives": OP13,
    }
