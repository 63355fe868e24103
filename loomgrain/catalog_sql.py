"""DuckDB SQL with the rows of the catalogue's queries."""

from __future__ import annotations

from loomgrain.functions.text import METHODS_ANCHOR, RESULTS_ANCHOR
from loomgrain.operators.generation import TYPE_BRIEFS
from loomgrain.operators.selection import TYPE_FACETS

TOPICS = """t as (
  select l_orderkey as pmcid, substr('ABCDEFJ', l_linenumber, 1) as facet, l_returnflag || l_linestatus as subtopic, l_discount as prob, l_partkey, l_suppkey
  from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')
)"""

PROFILE = f"""{TOPICS}, p as (
  select pmcid, arg_max(subtopic, {{'p': prob, 'a': l_partkey, 'b': l_suppkey}}) filter (where facet = 'A' and prob >= 0) as a,
         arg_max(subtopic, {{'p': prob, 'a': l_partkey, 'b': l_suppkey}}) filter (where facet = 'E' and prob >= 0) as e,
         string_agg(distinct facet, '' order by facet) as facets
  from t group by pmcid
), q as (
  select pmcid, coalesce(nullif(a, ''), 'none') as a, coalesce(nullif(e, ''), 'none') as e, facets from p
)"""


def _allocation(strata: str, by: str, n: int) -> str:
    return f"""s as ({strata}), f as (
  select *, least(size, 10)::bigint as fl, size - least(size, 10) as room from s
), r as (
  select *, least({n}, sum(size) over ())::bigint - (sum(fl) over ())::bigint as rest, (sum(room) over ())::bigint as rooms from f
), b as (
  select *, case when rest > 0 and rooms > 0 then rest * room // rooms else 0 end as base, case when rest > 0 and rooms > 0 then rest * room % rooms else 0 end as frac from r
), l as (
  select *, case when rest > 0 and rooms > 0 then rest - (sum(base) over ())::bigint else 0 end as extra, row_number() over (order by frac desc, {by}) as k from b
), alloc as (
  select {by}, size, (fl + base + case when k <= extra then 1 else 0 end)::bigint as alloc from l
)"""


STRATA = "select lang, source, count(*)::bigint as size from documents group by lang, source"

#: Trim and normalise as the text functions do, for text without compatibility characters.
STRIP = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"
FOLD = r"translate({0}, '‘’‛′´`“”‟″‐‑‒–—―−', '''''''''''''""""""""-------')".replace('""""""""', '""""')


def _norm(x: str) -> str:
    return rf"trim(regexp_replace({FOLD.format(x)}, '\s+', ' ', 'g'))"


def _clean(x: str) -> str:
    return STRIP.format(rf"regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '[ \t\r\f\x0B]+', ' ', 'g')")


def _first(x: str, tag: str, boundary: str = "") -> str:
    p = rf"(?is)<{tag}{boundary}[^>]*>(.*?)</{tag}>"
    return f"case when regexp_matches({x}, '{p}') then regexp_extract({x}, '{p}', 1) end"


def _excerpt(x: str, anchor: str, n: int) -> str:
    return f"coalesce(substring({_clean(f"substring(regexp_extract({x}, '(?is)({anchor}.*)', 1), 1, {3 * n})")}, 1, {n}), '')"


#: Pages whose headings have an article's section marks before them.
ARTICLES = """(select page_id, replace(replace(html, '<h1', '<sec sec-type="materials|methods"><h1'), '<h2', '<title>Results </title><h2') as html from pages)"""

CONTEXT = f"""c as (
  select page_id, coalesce({_clean(_first("html", "title"))}, '') as title,
         substring({_clean(r"array_to_string(regexp_extract_all(html, '(?is)<p[^>]*>(.*?)</p>', 1), ' ')")}, 1, 300) as abstract,
         coalesce({_first("html", "body", chr(92) + "b")}, html) as body from {ARTICLES}
), m as (
  select *, {_excerpt("body", METHODS_ANCHOR, 400)} as mm, {_excerpt("body", RESULTS_ANCHOR, 400)} as rr from c
), x as (
  select page_id, 'TITLE: ' || title || chr(10) || chr(10) || 'ABSTRACT: ' || abstract
    || case when mm <> '' then chr(10) || chr(10) || 'METHODS: ' || mm else '' end
    || case when rr <> '' then chr(10) || chr(10) || 'RESULTS: ' || rr else '' end as context from m
)"""

NUMBER = r"-?\d+(?:\.\d+)?"

GUARD = rf"""d as (
  select doc_id, text as t, {_norm("text")} as src from documents
), v as (
  select *, list_filter(list_transform(regexp_extract_all(src, '{NUMBER}'), lambda x: try_cast(x as double)), lambda x: x is not null) as vals from d
), p as (
  select doc_id, src, vals, 'what of ' || doc_id as question, unnest([
    {{'type': 'verbatim', 'answer': 'as stated', 'span': substring(t, 11, 60)}},
    {{'type': 'stitched', 'answer': 'as stated', 'span': substring(t, 1, 40) || ' ... ' || substring(t, 60, 40)}},
    {{'type': 'foreign', 'answer': 'as stated', 'span': 'zz' || substring(t, 11, 60)}},
    {{'type': 'number', 'answer': 'about ' || (doc_id % 100), 'span': substring(t, 11, 60)}},
    {{'type': 'blank', 'answer': ' ' || chr(10) || ' ', 'span': substring(t, 11, 60)}},
    {{'type': 'short', 'answer': 'as stated', 'span': substring(t, 1, 8)}}]) as p from v
), s as (
  select doc_id, src, vals, question, p.type as type, {STRIP.format("p.answer")} as answer, {STRIP.format("p.span")} as span from p
), f as (
  select *, list_filter(list_transform(string_split_regex(span, '\s*(?:\.\.\.|…)\s*'), lambda x: {_norm("x")}), lambda x: length(x) >= 12) as frags,
         list_filter(regexp_extract_all({_norm("answer")}, '{NUMBER}'), lambda x: not contains(src, x) and not list_contains(vals, try_cast(x as double))) as bad from s
), g as (
  select doc_id, type, question, answer, span, case when question = '' or answer = '' or span = '' then 'empty'
         when len(frags) = 0 or len(list_filter(frags, lambda x: not contains(src, x))) > 0 then 'span'
         when len(bad) > 0 then 'num:' || bad[1] else '' end as reason from f
), k as (
  select *, case when reason = '' then 1 else 0 end::int as kept from g
), j as (
  select *, case when kept = 1 then (doc_id % 3)::int - 1 else -1 end::int as judged from k
)"""

CHATS = rf"""c as (
  select conv_id, arg_min(text, {{'t': turn, 'x': text}}) filter (where role = 'user' and {STRIP.format("text")} <> '') as user,
         arg_min(text, {{'t': turn, 'x': text}}) filter (where role = 'assistant' and {STRIP.format("text")} <> '') as assistant
  from conversations group by conv_id
), y as (
  select conv_id as line_id, user, assistant from c where user is not null and assistant is not null
)"""


def _tokens(x: str) -> str:
    return rf"list_filter(string_split_regex(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+'), lambda x: x <> '')"


ANSWERS = f"""a as (
  select conv_id, turn, text as prediction, lag(text) over (partition by conv_id order by turn, text) as reference from conversations where role = 'assistant'
), w as (
  select conv_id, turn, prediction, {_tokens("prediction")} as p, {_tokens("reference")} as r from a where reference is not null
), o as (
  select *, list_sum(list_transform(list_distinct(p), lambda t: least(len(list_filter(p, lambda x: x = t)), len(list_filter(r, lambda x: x = t))))) as k from w
), f as (
  select *, (case when p = r then 1 else 0 end)::int as exact, case when len(p) = 0 or len(r) = 0 then case when p = r then 1.0 else 0.0 end when coalesce(k, 0) = 0 then 0.0
    else 2 * (k / len(p)) * (k / len(r)) / (k / len(p) + k / len(r)) end::double as f1 from o
)"""

IDS = r"""i as (
  select doc_id, list_transform(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''), lambda x: ('0x' || substr(md5(x), 1, 7))::int) as ids from documents
)"""

SCHEDULE = """n as (
  select (select count(*) from documents) as a, (select count(*) from benchmark) as b
), s as (
  select i as step, case when ('0x' || substr(md5('0:' || i), 1, 7))::int / 268435456.0 < 0.15 then 1 else 0 end::int as source from (select unnest(range(0, a + b)) as i from n)
), c as (
  select *, sum(source) over (order by step)::bigint as ones, (step + 1 - sum(source) over (order by step))::bigint as zeros from s
), e as (
  select min(step) as last from c, n where ones >= b or zeros >= a
), k as (
  select step, source, (case when source = 1 then ones else zeros end - 1)::bigint as idx from c, e where step <= last
)"""

#: What the replies of the catalogue hold, as canonical JSON, by doc_id modulo 5.
ITEM = """'{"type": "t", "question": "q' || doc_id || '", "answer": "a", "supporting_span": "s", "n": 1, "supported": true}'"""
PARSED = f"""case doc_id % 5 when 0 then '{{"pairs": [' || {ITEM} || ']}}' when 1 then '[' || {ITEM} || ']'
  when 4 then '{{"verdicts": [' || {ITEM} || ', {{"n": "2", "supported": "false"}}, {{"n": 1.7, "supported": false}}]}}' end"""

STUB = """'{"pairs": [{"type": "stub", "question": "' || md5(text) || '", "answer": "' || md5(text) || '"}]}'"""
SPLIT = r"len(list_filter(string_split_regex(text, '[\s\x1c-\x1f\x85\xA0]+'), lambda x: x <> ''))"

#: Each question type's facets, and the length of its line in a prompt.
TYPES = ", ".join(
    f"case when regexp_matches(facets, '[{letters}]') then {len(f'1. {name}: {TYPE_BRIEFS[name]}')} end" for name, letters in TYPE_FACETS.items()
)
FRAME = len("Types, in order:\n") + len("\n\n--- text ---\n") + len("\n--- end ---")

SQL = {
    "select_semi_join": f"with {TOPICS} select pmcid, facet, subtopic, prob from t",
    "facet_sets": f"with {PROFILE} select pmcid, facets from p",
    "facet_argmax": f"with {PROFILE} select pmcid, a, e from q",
    "strata_counts": STRATA,
    "allocate_floor": f"with {_allocation(STRATA, 'lang, source', 400)} select lang, source, size, alloc from alloc",
    "allocate_overshoot": f"with {_allocation(STRATA, 'lang, source', 50)} select lang, source, size, alloc from alloc",
    "stratified_sample": f"""with {_allocation(STRATA, "lang, source", 400)}, z as (
  select doc_id, lang, source, row_number() over (partition by lang, source order by md5('7:' || doc_id), doc_id) as k from documents
) select doc_id, lang, source from z join alloc using (lang, source) where k <= alloc""",
    "select_papers": f"""with {PROFILE}, {_allocation("select a, e, count(*)::bigint as size from q group by a, e", "a, e", 300)}, z as (
  select *, row_number() over (partition by a, e order by md5('7:' || pmcid), pmcid) as k from q
) select pmcid, a, e, facets from z join alloc using (a, e) where k <= alloc""",
    "type_selection": f"""with {PROFILE} select pmcid, array_to_string(list_filter([
  case when regexp_matches(facets, '[BC]') then 'artifact_diagnosis' end, case when regexp_matches(facets, '[AE]') then 'modality_selection' end,
  case when regexp_matches(facets, '[EJ]') then 'result_interpretation' end, case when regexp_matches(facets, '[C]') then 'instrumentation' end,
  case when regexp_matches(facets, '[D]') then 'image_analysis' end, case when regexp_matches(facets, '[B]') then 'sample_prep' end,
  case when regexp_matches(facets, '[J]') then 'limitations' end, case when regexp_matches(facets, '[A]') then 'comparative_tradeoff' end
], lambda x: x is not null)[1:6], ',') as types from p""",
    "resume_antijoin": "select doc_id from documents where doc_id not in (select doc_id from labels)",
    "missing_path_inner": "select l.doc_id, url from (select doc_id from labels order by doc_id limit 200) l join pages on page_id = l.doc_id",
    "left_default": "select d.doc_id, coalesce(toxic, -1)::int as toxic from documents d left join labels l on d.doc_id = l.doc_id",
    "state_upsert": """select o_custkey, o_orderkey, o_totalprice from orders
qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1""",
    "state_store": "select o_orderkey::varchar as id, case when o_orderkey % 3 = 0 then 1 else 0 end::int as judged from orders",
    "markup_clean": f"select page_id, length(c)::bigint as n_chars, md5(c) as digest from (select page_id, {_clean('html')} as c from pages)",
    "title_body_extract": f"""select page_id, {_clean(_first("html", "title"))} as title, body is not null as has_body, length(coalesce(body, html))::bigint as body_chars
from (select page_id, html, {_first("html", "body", chr(92) + "b")} as body from pages)""",
    "section_excerpt": f"select page_id, {_excerpt('html', METHODS_ANCHOR, 200)} as excerpt from {ARTICLES}",
    "context_build": f"""with {CONTEXT} select page_id, length(context)::bigint as n_chars, md5(context) as digest,
  contains(context, 'METHODS:') or contains(context, 'RESULTS:') as usable from x""",
    "span_grounding": f"with {GUARD} select doc_id, type, reason <> 'span' as grounded from k where type in ('verbatim', 'foreign', 'short')",
    "ellipsis_stitch": f"with {GUARD} select doc_id, reason <> 'span' as grounded from k where type = 'stitched'",
    "number_grounding": f"""with {GUARD} select doc_id, case when reason <> '' then substr(reason, 5) end as offender from k
where type = 'number' and (reason = '' or reason like 'num:%')""",
    "pair_guard": f"with {GUARD} select doc_id, type, kept, reason from k",
    "guard_reasons": f"""with {GUARD} select case when kept = 1 then 'kept' else split_part(reason, ':', 1) end as kind, count(*)::bigint as n from k group by 1""",
    "drop_reason_topk": f"with {GUARD} select reason, count(*)::bigint as n from k where kept = 0 group by reason order by n desc, reason limit 8",
    "kept_by_type": f"with {GUARD} select type, count(*)::bigint as n from k where kept = 1 group by type",
    "status_counts": f"""with {GUARD} select count(*)::bigint as pairs, count(*) filter (where kept = 1)::bigint as kept,
  round(100.0::double * count(*) filter (where kept = 1) / count(*), 6) as kept_percent, count(*) filter (where judged = 1)::bigint as supported,
  count(*) filter (where kept = 1 and judged = -1)::bigint as unjudged from j""",
    "export_chat": f"with {GUARD} select question, answer from j where kept = 1 and judged = 1",
    "chat_export_roundtrip": f"""with {GUARD} select question as user, answer as assistant, count(*)::bigint as n from j
where kept = 1 and judged = 1 group by all""",
    "judge_verdicts": """select doc_id || ':' || i as id, case when doc_id % 5 = 4 then case when i = 2 then 1 else 0 end when doc_id % 5 = 1 and i = 1 then 1 else 0 end::int as judged
from documents, (select unnest([1, 2, 3]) as i)""",
    "chat_first_turns": f"with {CHATS} select conv_id, user, assistant, user is null or assistant is null as malformed from c",
    "sft_dedup": f"""with {CHATS}, z as (select * from y union all select line_id + 1000000000, user, assistant from y)
select min(line_id)::bigint as line_id, user, assistant from z group by user, assistant""",
    "sft_split": f"""with {CHATS}, z as (select min(line_id) as line_id from y group by user, assistant)
select line_id, case when row_number() over (order by md5('3:' || line_id), line_id) <= ceil(count(*) over () * 0.1::double) then 'validation' else 'train' end as split from z""",
    "normalize_tokens": f"""select doc_id, len(t)::bigint as n_tokens, md5(array_to_string(t, ' ')) as digest from (select doc_id, {_tokens("text")} as t from documents)""",
    "token_f1": f"with {ANSWERS} select conv_id, turn, round(f1, 6) as f1 from f",
    "exact_match": f"with {ANSWERS} select conv_id, turn, exact from f",
    "answer_metrics": f"""with {ANSWERS}, z as (select *, length(prediction) / 1000.0::double as loss, turn % 4 as n from f)
select count(*)::bigint as n, round(sum(exact) / count(*), 6)::double as exact_match, round(sum(f1) / count(*), 6)::double as f1,
  round(sum(loss * n) / greatest(1, sum(n)), 6) as loss, round(exp(sum(loss * n) / greatest(1, sum(n))), 6) as perplexity from z""",
    "weighted_perplexity": """with z as (select event_type, value / 100 as loss, (props::json ->> '$.k')::bigint as n from events), g as (
  select event_type, sum(loss * n) / greatest(1, sum(n)) as loss from z where n > 0 group by event_type
) select event_type, round(loss, 6) as loss, round(exp(loss), 6) as perplexity from g""",
    "word_tokenize": f"with {IDS} select doc_id, len(ids)::bigint as n, ids[1]::int as first_id, coalesce(list_sum(ids), 0)::bigint as total from i",
    "pack_blocks": f"""with {IDS}, u as (
  select doc_id // 256 as batch, doc_id, unnest(ids) as id, unnest(range(0, len(ids))) as k from i
), n as (
  select batch, id, row_number() over (partition by batch order by doc_id, k) - 1 as o from u
) select batch::bigint as batch, (o // 64)::bigint as block, arg_min(id, o)::int as first_id, arg_max(id, o)::int as last_id, sum(id)::bigint as total
from n group by 1, 2 having count(*) = 64""",
    "pack_dropped": f"""with {IDS}, g as (select doc_id // 256 as batch, sum(len(ids))::bigint as tokens from i group by 1)
select batch::bigint as batch, tokens, tokens // 64 as blocks, tokens % 64 as dropped from g""",
    "interleave_schedule": f"with {SCHEDULE} select step, source, idx from k",
    "interleave_rows": f"""with {SCHEDULE}, z as (select 0 as source, doc_id as idx, text from documents union all select 1, item_id, text from benchmark)
select step, k.source, k.idx as pos, md5(text) as digest from k join z on k.source = z.source and k.idx = z.idx""",
    "max_docs_prefix": "select doc_id, n_chars from documents where doc_id < 100",
    "step_budget": f"""with {IDS}, g as (select sum(n // 64) as b from (select sum(len(ids)) as n from i group by doc_id // 256))
select b::bigint as blocks, ceil(ceil(b / 32) * 2 / 0.85)::bigint as steps from g""",
    "cache_fingerprint": """select substr(sha256('1' || chr(10) || 'a model' || chr(10) || 'text' || chr(10) || '4096' || chr(10) || '0.01' || chr(10) || '0' || chr(10) || 'a.jsonl.gz:120:1700000000'), 1, 16) as fingerprint""",
    "next_stage": f"""with {GUARD}, z as (
  select count(distinct doc_id)::bigint as papers, count(*) filter (where kept = 1)::bigint as kept, count(*) filter (where judged <> -1)::bigint as judged from j
) select *, case when kept - judged > greatest(200, kept // 200) then 'judge' else 'export' end as stage from z""",
    "nfkc_normalize": f"""select doc_id, length(n)::bigint as n_chars, md5(n) as digest from (select doc_id, {_norm("text || ['  fine 12 Ab', ' x2 1⁄2 kg', ' a b Å'][doc_id % 3 + 1]")} as n from documents)""",
    "json_extract_tolerant": f"select doc_id, {PARSED} as parsed from documents",
    "json_objects_all": "select doc_id, case when doc_id % 5 = 3 then 0 else 1 end::bigint as n_objects from documents",
    "generation_parse": f"""select doc_id, case when doc_id % 5 < 2 then 1 else 0 end::int as ok, case when doc_id % 5 < 2 then '[' || {ITEM} || ']' end as pairs_json
from documents""",
    "generation_prompts": f"""with {PROFILE}, y as (
  select pmcid, list_filter([{TYPES}], lambda x: x is not null)[1:6] as y from p
) select pmcid, len(y)::bigint as n_types, ({FRAME} + list_sum(y) + len(y) - 1 + length(text))::bigint as n_chars from y join documents on doc_id = pmcid where len(y) > 0""",
    "model_stub_batch": f"select doc_id, {STUB} as reply, {SPLIT}::bigint as prompt_tokens, 8::bigint as completion_tokens from documents",
    "classify_batch": f"select item_id, {STUB} as label, null::varchar as error from benchmark",
    "usage_totals": f"""select count(*)::bigint as requests, sum({SPLIT})::bigint as prompt_tokens, 8 * count(*)::bigint as completion_tokens, 0::bigint as retries
from benchmark""",
    "stream_counts": """select date_trunc('hour', ts) as start, event_type, count(*)::bigint as n from events group by all""",
}
