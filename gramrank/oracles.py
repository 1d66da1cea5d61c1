"""The registered queries once more, as plain SQL over the same tables.

The statements are put together from named parts (``with`` clauses) so that each
result is derived from the tables alone.
"""

from __future__ import annotations

from gramrank.queries import (
    DRAW_SEED,
    ELBOW_MAX_K,
    HUB,
    KMEANS_K,
    KMEANS_ROUNDS,
    PATTERN,
    RANDOM_STARTS,
)
from gramrank.tables import LISTING_SQL

ONE_LINE = "replace(replace(text, chr(10), ' '), chr(13), ' ')"

TOKENS = r"""
tokens as (
    select doc_id, regexp_replace(lower(token), '[^a-z0-9]', '', 'g') as word
    from (
        select cast(doc_id as varchar) as doc_id,
               unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) as token
        from documents
    )
    where token <> ''
)"""

TERMS = TOKENS + """,
terms as (
    select doc_id, word, count(*) as n from tokens where word <> '' group by doc_id, word
)"""

CORPUS = TOKENS + """,
corpus as (select word, count(*) as n from tokens where word <> '' group by word)"""

WEIGHTS = TERMS + """,
frequencies as (
    select doc_id, word, n, max_n, 0.5 + 0.5 * (cast(n as double) / max_n) as tf
    from (select *, max(n) over (partition by doc_id) as max_n from terms)
),
weights as (
    select doc_id, word, tf, df, tf * log10(cast(n_docs as double) / df) as tfidf
    from (select *, count(*) over (partition by word) as df from frequencies),
         (select count(distinct doc_id) as n_docs from terms)
)"""

PIECES = f"""
pieces as (
    select doc_id, unnest(split) as sentence, unnest(range(len(split))) as position
    from (
        select cast(doc_id as varchar) as doc_id,
               regexp_split_to_array(replace({ONE_LINE}, '====>', ''), '[.?!][ ]') as split
        from documents
    )
),
sentences as (
    select doc_id, sentence,
           row_number() over (partition by doc_id order by position) - 1 as sid
    from pieces
    where regexp_matches(sentence, '[^\\x00-\\x20]')
)"""

SENTENCE_WORDS = PIECES + """,
sentence_words as (
    select distinct doc_id, sid, word
    from (
        select doc_id, sid,
               unnest(string_split(regexp_replace(lower(sentence), '[^ a-z0-9]', '', 'g'), ' '))
                   as word
        from sentences
    )
    where word <> ''
)"""

SENTENCE_WEIGHTS = WEIGHTS + "," + SENTENCE_WORDS + """,
sentence_weights as (
    select s.doc_id, s.sid, s.word, w.tfidf
    from sentence_words s join weights w on s.doc_id = w.doc_id and s.word = w.word
),
placed as (
    select *, row_number() over (partition by doc_id, sid order by tfidf desc, word) as place
    from sentence_weights
)"""

SCORES = SENTENCE_WEIGHTS + """,
scores as (
    select doc_id, sid,
           max(case when place = 1 then tfidf end)
           + coalesce(max(case when place = 2 then tfidf end), 0)
           + coalesce(max(case when place = 3 then tfidf end), 0)
           + coalesce(max(case when place = 4 then tfidf end), 0)
           + coalesce(max(case when place = 5 then tfidf end), 0) as score
    from placed group by doc_id, sid
),
best as (
    select doc_id, sid, score
    from (
        select *, row_number() over (partition by doc_id order by score desc, sid desc) as place
        from scores
    )
    where place <= 3
)"""

LINKS = """
links as (
    select distinct src, dst from (
        select cast(l_partkey + 1 as varchar) as src, cast(l_suppkey + 1 as varchar) as dst
        from lineitem
        union all
        select cast(l_suppkey + 1 as varchar), cast(l_partkey + 1 as varchar) from lineitem
    )
)"""

PARSED_LINKS = """
parsed_links as (
    select distinct cast(l_partkey + 1 as varchar) as src, dst
    from (
        select l_partkey,
               unnest(case when l_linenumber = 7 then ['']
                      else [cast(l_suppkey + 1 as varchar), cast(l_linenumber as varchar)] end)
                   as dst
        from lineitem
    )
)"""

TITLES = """
titles as (select cast(p_partkey + 1 as varchar) as id, p_name as title from part)"""

SELECTED = f"""
selected as (
    select src, dst from {{links}}
    where src in (select id from titles where split_part(title, ',', 1) like '{PATTERN}')
),
hubbed as (
    select distinct src, dst from (
        select src, dst from selected where dst <> ''
        union all
        select src, '{HUB}' from selected
    )
)"""


def rank_rounds(links: str, rounds: int, taxation: bool, teleport: str = "share") -> str:
    """``with`` clauses whose last one, ``final_ranks``, holds the ranks."""
    start = "(select 1.0 / count(*) from degrees)"
    target = f"(select cast({start} as double))" if teleport == "share" else "1.0"
    passed = "sum(r.rank / d.deg)"
    value = f"0.15 * {target} + 0.85 * {passed}" if taxation else passed
    parts = [
        f"degrees as materialized (select src, count(*) as deg from {links} group by src)",
        f"rank_0 as materialized (select src as id, cast({start} as double) as rank from degrees)",
    ]
    for done in range(1, rounds + 1):
        parts.append(
            f"rank_{done} as materialized (select l.dst as id, {value} as rank "
            f"from {links} l join rank_{done - 1} r on l.src = r.id "
            f"join degrees d on l.src = d.src group by l.dst)"
        )
    parts.append(f"final_ranks as (select id, rank from rank_{rounds})")
    return ",\n".join(parts)


LISTINGS = f"""
listing_lines as (select {LISTING_SQL} as value from customer),
listing_parts as (
    select regexp_split_to_array(value, ':\\s+') as parts from listing_lines
),
listing_fields as (
    select parts, regexp_split_to_array(parts[2], '\\s+') as fields from listing_parts
),
listings as (
    select parts[1] as name, fields[1] as state, fields[2] as code, fields[3] as second,
           len(parts) as n_parts, len(fields) as n_fields,
           case when isfinite(all_stars) then all_stars end as stars,
           case when isfinite(all_reviews) then all_reviews end as reviews
    from (
        select *, try_cast(case when length(fields[2]) in (3, 4) then fields[4]
                           else fields[3] end as double) as all_stars,
               try_cast(case when length(fields[2]) in (3, 4) then fields[5]
                        else fields[4] end as double) as all_reviews
        from listing_fields
    )
)"""

VALID = LISTINGS + """,
digits as (
    select *, translate(code || second, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        '00111222333444555666777889') as number
    from listings
    where n_parts = 2 and n_fields >= 5
),
valid as (
    select name, state, stars, reviews,
           case when regexp_full_match(code, '[0-9]{5}') then cast(code as double)
                when regexp_full_match(code, '[0-9A-Z]{3,4}')
                     and regexp_full_match(second, '[0-9A-Z]{3}')
                then cast(substring(number, 1, 5) || '.' || substring(number, 6) as double)
           end as zip
    from digits
),
valid_listings as (
    select * from valid where zip is not null and stars is not null and reviews >= 1
),
points as materialized (
    select name, state, zip / 10000.0 as x, stars * ln(reviews) / ln(7968.0) as y
    from valid_listings
)"""


def random_draws(wanted: int) -> str:
    """``with`` clauses for ``wanted`` centroids drawn one after the other; ``starts`` holds
    them by number. A draw repeats a row seen before or takes the next fresh one; the x and
    the y of a centroid are drawn separately."""
    chance = f"cast('0x' || left(md5('{DRAW_SEED}|draw|' || (i + 1)), 15) as bigint)"
    return f"""
fresh as materialized (
    select x, y, row_number() over (order by md5('{DRAW_SEED}|' || name), name) - 1 as place
    from points
),
draws as (
    select 0 as i, cast(0 as bigint) as place, cast(1 as bigint) as seen
    union all
    select i + 1, least(p, seen), case when p < seen then seen else seen + 1 end
    from (select *, {chance} % (select count(*) from points) as p from draws)
    where i + 1 < {2 * wanted}
),
drawn as materialized (select i, x, y from draws join fresh using (place)),
starts as materialized (
    select a.i as number, a.x, b.y from drawn a join drawn b on b.i = a.i + {wanted}
)"""


def lloyd(k: int, rounds: int, tag: str, order: str = "name", start: int | None = None) -> str:
    """``with`` clauses for the rounds of one run; ``near_<tag>_<round>`` holds the
    assignments and ``cent_<tag>_<round>`` the centroids used in them. The first ones are
    points in ``order``, or those of ``starts`` from number ``start`` on."""
    if start is None:
        first = (
            f"select row_number() over (order by {order}) - 1 as cid, "
            f"x as cx, y as cy from points order by {order} limit {k}"
        )
    else:
        first = (
            f"select number - {start} as cid, x as cx, y as cy from starts "
            f"where number between {start} and {start + k - 1}"
        )
    parts = [f"cent_{tag}_1 as materialized ({first})"]
    for done in range(1, rounds + 1):
        parts.append(
            f"near_{tag}_{done} as materialized (select name, x, y, cid, cx, cy, d from ("
            f"select *, row_number() over (partition by name order by d, cid) as place from ("
            f"select p.name, p.x, p.y, c.cid, c.cx, c.cy, "
            f"sqrt(pow(abs(p.x - c.cx), 2) + pow(abs(p.y - c.cy), 2)) as d "
            f"from points p, cent_{tag}_{done} c)) where place = 1)"
        )
        if done < rounds:
            parts.append(
                f"cent_{tag}_{done + 1} as materialized (select cid, avg(x) as cx, "
                f"avg(y) as cy from near_{tag}_{done} group by cid)"
            )
    return ",\n".join(parts)


def build() -> dict[str, str]:
    last = f"near_a_{KMEANS_ROUNDS}"
    clusters = f"with {VALID},\n{lloyd(KMEANS_K, KMEANS_ROUNDS, 'a')}\n"
    elbow_runs = ",\n".join(
        lloyd(k, KMEANS_ROUNDS, f"k{k}") for k in range(1, ELBOW_MAX_K + 1)
    )
    elbow_rows = " union all ".join(
        f"select cast({k} as integer) as k, round(sum(pow(d, 2)) / {k}, 6) as sse "
        f"from near_k{k}_{KMEANS_ROUNDS}"
        for k in range(1, ELBOW_MAX_K + 1)
    )
    bucket = """cast(case
        when left(word, 1) between 'e' and 'k' then 1
        when left(word, 1) between 'l' and 'q' then 2
        when left(word, 1) between 'r' and 'u' then 3
        when left(word, 1) between 'v' and 'z' then 4
        else 0 end as integer)"""
    last_runs = ",\n".join(
        lloyd(k, KMEANS_ROUNDS, f"r{k}", "name desc") for k in range(1, ELBOW_MAX_K + 1)
    )
    restart_rows = " union all ".join(
        f"select cast({k} as integer) as k, round(((select sum(pow(d, 2)) "
        f"from near_k{k}_{KMEANS_ROUNDS}) + (select sum(pow(d, 2)) "
        f"from near_r{k}_{KMEANS_ROUNDS})) / {k}, 6) as sse"
        for k in range(1, ELBOW_MAX_K + 1)
    )
    ks = [k for k in range(1, ELBOW_MAX_K + 1) for _ in range(RANDOM_STARTS)]
    single = sum(range(1, ELBOW_MAX_K + 1))
    drawn_runs = ",\n".join(
        lloyd(k, KMEANS_ROUNDS, f"d{run}", start=sum(ks[:run])) for run, k in enumerate(ks)
    )
    drawn_rows = " union all ".join(
        f"select cast({k} as integer) as k, round(("
        + " + ".join(
            f"(select sum(pow(d, 2)) from near_d{run}_{KMEANS_ROUNDS})"
            for run, size in enumerate(ks)
            if size == k
        )
        + f") / {k}, 6) as sse"
        for k in range(1, ELBOW_MAX_K + 1)
    )
    selected_pages = SELECTED.format(links="links")
    selected_parsed = SELECTED.format(links="parsed_links")
    return {
        "word_count": f"with {TOKENS} select word, count(*) as n from tokens group by word",
        "distinct_words": f"with {TOKENS} select distinct word from tokens",
        "vocabulary_profile": f"with {TOKENS} select distinct word from tokens "
        "order by word limit 500",
        "doc_term_counts": f"with {TERMS} select doc_id, word, n from terms",
        "doc_term_profile": f"with {TERMS} select doc_id, word, n from terms "
        "order by doc_id desc, n desc, word desc limit 500",
        "corpus_counts": f"with {CORPUS} select word, n from corpus",
        "corpus_profile": f"with {CORPUS} select word, n from corpus "
        "order by n desc, word limit 500",
        "letter_buckets": f"with {TOKENS} select {bucket} as bucket, word, count(*) as n "
        "from tokens group by word",
        "article_fields": f"""
            select case when doc_id % 5 <> 0 then source end as title,
                   case when doc_id % 5 > 1 then cast(doc_id as varchar) end as doc_id,
                   {ONE_LINE} as body
            from documents""",
        "article_ids": "select distinct cast(doc_id as varchar) as doc_id "
        "from documents where doc_id % 5 > 1",
        "unique_articles": f"""
            select cast(doc_id // 3 as varchar) as doc_id, min({ONE_LINE}) as body
            from documents group by doc_id // 3""",
        "key_values": f"""
            select case when doc_id % 3 = 0 then split_part({ONE_LINE}, chr(9), 1)
                        else cast(doc_id as varchar) end as key,
                   case when doc_id % 3 = 0
                            then case when contains(text, chr(9))
                                 then substring({ONE_LINE}, strpos(text, chr(9)) + 1)
                                 else '' end
                        when doc_id % 3 = 1 then {ONE_LINE}
                        else source || chr(9) || {ONE_LINE} end as value
            from documents""",
        "line_fields": r"""
            select cast(len(fields) as integer) as n_fields,
                   array_to_string(fields, '|') as fields
            from (
                select regexp_split_to_array(regexp_replace(text, '\s+$', ''), '\s+') as fields
                from documents
            )""",
        "term_frequency": f"with {WEIGHTS} select doc_id, word, n, max_n, round(tf, 9) as tf "
        "from frequencies",
        "document_frequency": f"with {TERMS} select word, count(*) as df from terms group by word",
        "document_total": f"with {TERMS} select count(distinct doc_id) as n_docs from terms",
        "tf_idf": f"with {WEIGHTS} select doc_id, word, round(tf, 9) as tf, df, "
        "round(tfidf, 9) as tfidf from weights",
        "tf_idf_cut_keys": f"with {WEIGHTS} select doc_id, word, round(tf, 9) as tf, df, "
        "round(tfidf, 9) as tfidf from weights",
        "sentences": f"with {PIECES} select doc_id, cast(sid as integer) as sid, sentence "
        "from sentences",
        "sentence_words": f"with {SENTENCE_WORDS} select doc_id, cast(sid as integer) as sid, "
        "word from sentence_words",
        "sentence_weights": f"with {SENTENCE_WEIGHTS} select doc_id, "
        "cast(sid as integer) as sid, word, round(tfidf, 9) as tfidf from sentence_weights",
        "sentence_top_weights": f"with {SENTENCE_WEIGHTS} select doc_id, "
        "cast(sid as integer) as sid, cast(place as integer) as place, "
        "round(tfidf, 9) as tfidf from placed where place <= 5",
        "sentence_scores": f"with {SCORES} select doc_id, cast(sid as integer) as sid, "
        "round(score, 9) as score from scores",
        "top_sentences": f"with {SCORES} select doc_id, cast(sid as integer) as sid, "
        "round(score, 9) as score from best",
        "summaries": f"""
            with {SCORES},
            picked as (
                select b.doc_id,
                       string_agg(s.sentence || case when right(s.sentence, 1) = '.' then ' '
                                  else '. ' end, '' order by s.sid) as summary
                from best b join sentences s on b.doc_id = s.doc_id and b.sid = s.sid
                group by b.doc_id
            )
            select cast(d.doc_id as varchar) as doc_id, coalesce(p.summary, '') as summary
            from documents d left join picked p on cast(d.doc_id as varchar) = p.doc_id""",
        "link_edges": f"with {PARSED_LINKS} select src, dst from parsed_links",
        "page_titles": f"with {TITLES} select id, title from titles",
        "out_degree": f"with {LINKS} select src, count(*) as deg from links group by src",
        "graph_size": f"with {LINKS} select count(distinct src) as sources, "
        "count(*) as edges from links",
        "pagerank_ideal": f"with {LINKS},\n{rank_rounds('links', 24, False)} "
        "select id, round(rank, 9) as rank from final_ranks",
        "pagerank_taxed": f"with {LINKS},\n{rank_rounds('links', 24, True)} "
        "select id, round(rank, 9) as rank from final_ranks",
        "pagerank_cut_sources": f"with {LINKS},\n{rank_rounds('links', 24, True)} "
        "select id, round(rank, 9) as rank from final_ranks",
        "pagerank_unit": f"with {LINKS},\n{rank_rounds('links', 25, True, 'unit')} "
        "select id, round(rank, 6) as rank from final_ranks",
        "top_pages": f"with {LINKS}, {TITLES},\n{rank_rounds('links', 24, True)} "
        "select r.id, t.title, round(r.rank, 9) as rank from final_ranks r "
        "join titles t on r.id = t.id order by r.rank desc, r.id limit 10",
        "selected_links": f"with {PARSED_LINKS}, {TITLES}, {selected_parsed} "
        "select src, dst from selected",
        "hub_links": f"with {PARSED_LINKS}, {TITLES}, {selected_parsed} "
        "select src, dst from hubbed",
        "pagerank_bomb": f"with {LINKS}, {TITLES}, {selected_pages},\n"
        f"{rank_rounds('hubbed', 24, True)} "
        "select r.id, t.title, round(r.rank, 9) as rank from final_ranks r "
        "join titles t on r.id = t.id",
        "listing_rows": f"with {LISTINGS} select name, state, code, second, stars, reviews, "
        "cast(n_parts as integer) as n_parts, cast(n_fields as integer) as n_fields "
        "from listings",
        "valid_listings": f"with {VALID} select name, state, zip, stars, reviews "
        "from valid_listings",
        "business_points": f"with {VALID} select name, round(x, 9) as x, round(y, 9) as y "
        "from points",
        "state_points": f"with {VALID} select name, round(x, 9) as x, round(y, 9) as y "
        "from points where state in ('AU', 'MA')",
        "nearest_centroid": f"with {VALID},\n{lloyd(KMEANS_K, 1, 'a')} "
        "select name, cast(cid as integer) as centroid_id, round(d, 9) as d from near_a_1",
        "kmeans_clusters": clusters + "select cast(cid as integer) as centroid_id, "
        "round(cx, 6) as cx, round(cy, 6) as cy, name, round(x, 6) as x, round(y, 6) as y "
        f"from {last}",
        "kmeans_means": clusters + "select cast(cid as integer) as centroid_id, "
        "round(avg(x), 6) as cx, round(avg(y), 6) as cy, count(*) as members "
        f"from {last} group by cid",
        "kmeans_sse": clusters + "select cast(cid as integer) as centroid_id, "
        f"round(sum(pow(d, 2)), 6) as sse from {last} group by cid",
        "elbow_curve": f"with {VALID},\n{elbow_runs}\n{elbow_rows}",
        "elbow_restarts": f"with {VALID},\n{elbow_runs},\n{last_runs}\n{restart_rows}",
        "elbow_random": f"with recursive {VALID}, {random_draws(sum(ks))},\n{drawn_runs}\n"
        f"{drawn_rows}",
        "random_starts": f"with recursive {VALID}, {random_draws(single)} "
        "select cast(k as integer) as k, cast(number - k * (k - 1) // 2 as integer) as centroid_id, "
        f"round(x, 9) as x, round(y, 9) as y from starts, range(1, {ELBOW_MAX_K + 1}) as t(k) "
        "where number >= k * (k - 1) // 2 and number < k * (k + 1) // 2",
        "random_point": f"with {VALID} select name, round(x, 9) as x, round(y, 9) as y "
        "from points order by md5('5|' || name), name limit 1",
        "clusters_sink": clusters + "select cast(cid as integer) as centroid_id, "
        "round(cx, 6) as cx, round(cy, 6) as cy, name, round(x, 6) as x, round(y, 6) as y "
        f"from {last}",
        "parquet_sink": f"with {VALID} select name, round(x, 9) as x, round(y, 9) as y "
        "from points",
        "kv_sink": f"with {CORPUS} select word, n from corpus",
        "tuple_sink": f"with {VALID} select name, round(x, 9) as x, round(y, 9) as y from points",
        "letter_sink": f"with {CORPUS} select {bucket} as bucket, word, n from corpus",
        "saved_clusters": """
            select c_nationkey as centroid_id, c_acctbal as cx, cast(c_custkey as double) as cy,
                   c_name as name, cast(c_custkey as double) as x, c_acctbal as y
            from customer
            union all
            select c_nationkey, c_acctbal, cast(c_custkey as double), c_name || ', Sons, Inc.',
                   c_acctbal, cast(c_nationkey as double)
            from customer""",
        "saved_elbow": "select cast(c_custkey as integer) as k, c_acctbal as sse from customer",
    }
