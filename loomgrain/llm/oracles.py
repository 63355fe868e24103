"""DuckDB SQL that gives the same rows as the opN queries that SQL can express."""

from __future__ import annotations

OP1 = """
with l as (
  select doc_id, text, string_split(text, chr(10)) as l from documents
), w as (
  select doc_id, i - 1 as line, l[i] || chr(10) || l[i+1] || chr(10) || l[i+2] as w
  from (select doc_id, l, unnest(range(1, len(l) - 1)) as i from l where len(l) >= 3)
), f as (
  select doc_id, line, row_number() over (partition by w order by doc_id, line) as k from w
), gone as (
  select distinct doc_id, line + o as line from f, (select unnest([0, 1, 2]) as o) where k > 1
), each as (
  select doc_id, i - 1 as line, l[i] as t from (select doc_id, l, unnest(range(1, len(l) + 1)) as i from l)
), kept as (
  select e.doc_id, string_agg(e.t, chr(10) order by e.line) as t, count(*) as n
  from each e left join gone g on e.doc_id = g.doc_id and e.line = g.line where g.line is null group by e.doc_id
)
select l.doc_id, coalesce(len(l.l), 0)::bigint as n_lines, (coalesce(len(l.l), 0) - coalesce(k.n, 0))::bigint as n_removed,
       sha256(coalesce(k.t, '')) as kept_sha256
from l left join kept k on l.doc_id = k.doc_id
"""


OP2 = f"""
with own as (
  select lang from documents where lang is not null group by lang order by count(*) desc, lang limit 200
), b as (
  select doc_id, coalesce(text, '') as text, case when lang in (select lang from own) then lang else 'und' end as lang,
         list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\x0C\\r]+'), lambda x: x <> '') as w
  from documents
), wn as (
  select lang, w, count(*) as n from (select lang, unnest(list_distinct(w)) as w from b) group by lang, w
), wk as (
  select lang, w, row_number() over (partition by lang order by n desc, w) as k from wn
), wl as (
  select lang, list(w order by k) as listed from wk where k <= 16 group by lang
), lists as (
  select b.*, coalesce(listed, []) as listed, length(array_to_string(w, '')) as word_chars,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\x0C\\r]')) as lines from b left join wl on b.lang = wl.lang
), c as (
  select *, len(w)::bigint as n_words, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         length(regexp_replace(text, '[^a-z]', '', 'g')) as k1, length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g')) as k2,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) as k3, length(regexp_replace(text, '[^0-9]', '', 'g')) as k5,
         length(text) - word_chars as k6, list_transform(listed, lambda x: len(list_filter(w, lambda y: y = x))) as hits
  from lists
), h as (
  select *, [k1, k2, k3, n_symbols, k5, k6, length(text) - k1 - k2 - k3 - n_symbols - k5 - k6] as ch,
         list_concat(hits, [n_words - coalesce(list_sum(hits), 0)]) as wh from c
), x as (
  select doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] as t from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from b where len(w) >= 3)
), r as (
  select doc_id, count(distinct i + o) as n from (select doc_id, i, count(*) over (partition by doc_id, t) as n from x), (select unnest([0, 1, 2]) as o)
  where n > 1 group by doc_id
), ref as (
  select lang, [{", ".join(f"sum(ch[{i}])" for i in range(1, 8))}] as ch, list_sum(list(list_sum(ch))) as cn, list_sum(list(list_sum(wh))) as wn from h group by lang
), wr as (
  select lang, list(s order by i) as wh from (select lang, i, sum(wh[i]) as s from (select lang, wh, unnest(range(1, len(wh) + 1)) as i from h) group by lang, i) group by lang
), js as (
  select h.*, ref.ch as rc, ref.cn, ref.wn, wr.wh as rw, coalesce(r.n, 0)::bigint as n_repeat_words,
         list_sum(h.ch) as tc, list_sum(h.wh) as tw
  from h join ref on h.lang = ref.lang join wr on h.lang = wr.lang left join r on h.doc_id = r.doc_id
), pq as (
  select *, list_transform(range(1, 8), lambda i: {{'p': ch[i] / tc, 'q': rc[i] / cn}}) as pc,
         list_transform(range(1, len(wh) + 1), lambda i: {{'p': wh[i] / tw, 'q': rw[i] / wn}}) as pw from js
), d as (
  select *,
    sqrt(greatest(0, list_sum(list_transform(pc, lambda x: case when x.p > 0 then x.p * log2(2 * x.p / (x.p + x.q)) / 2 else 0 end + case when x.q > 0 then x.q * log2(2 * x.q / (x.p + x.q)) / 2 else 0 end)))) as dc,
    sqrt(greatest(0, list_sum(list_transform(pw, lambda x: case when x.p > 0 then x.p * log2(2 * x.p / (x.p + x.q)) / 2 else 0 end + case when x.q > 0 then x.q * log2(2 * x.q / (x.p + x.q)) / 2 else 0 end)))) as dw
  from pq
), v as (
  select doc_id, n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         (word_chars >= 200 and dc > 0.235) or (n_words >= 100 and dw > 0.24) as odd from d
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not coalesce(odd, false) as kept from v
"""

OP3 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 10
"""

OP6 = """
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\x0C\r]+'), lambda x: x <> '') as w
  from documents
), s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]] else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1]) end) as s from w
), n as (
  select doc_id, count(*) as n from s group by doc_id
), c as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), e as (
  select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)
), l as (
  select a, b from e union select b, a from e
), r(doc_id, q) as (
  select doc_id, doc_id from documents union select r.doc_id, l.b from r join l on l.a = r.q
), m as (
  select doc_id, min(q) as component_id from r group by doc_id
)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id, d.doc_id = m.component_id as kept
from documents d join m on m.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
"""

OP7 = """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as x, strlen(coalesce(text, ''))::bigint as n from documents
), b as (
  select doc_id, n, k * 128 as base, substr(x, 256 * k + 1, 354) as y from (select *, unnest(range(0, (n - 50) // 128 + 1)) as k from d where n >= 50)
), p as (
  select doc_id, base + i as i, substr(y, 2 * i + 1, 100) as w from (select *, unnest(range(0, least(128, n - 49 - base))) as i from b)
), f as (
  select w, min(doc_id) as first from p group by w having min(doc_id) < max(doc_id)
), g as (
  select doc_id, i, first from p join f on p.w = f.w
), s as (
  select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 50 then 0 else 1 end as new from g where first < doc_id
), r as (
  select doc_id, k, min(i) as lo, max(i) + 50 as hi from (select doc_id, i, sum(new) over (partition by doc_id order by i) as k from s) group by doc_id, k
), c as (
  select doc_id, lo, hi, lag(hi, 1, 0) over (partition by doc_id order by lo) as before from r
), k as (
  select c.doc_id, string_agg(substr(x, 2 * before + 1, 2 * (lo - before)), '' order by lo) as x, max(hi) as hi, sum(hi - lo)::bigint as gone, count(*) as spans
  from c join d on c.doc_id = d.doc_id group by c.doc_id
)
select d.doc_id, d.n as n_bytes, coalesce(k.gone, 0)::bigint as n_removed, coalesce(k.spans, 0)::bigint as n_spans,
       sha256(unhex(case when k.doc_id is null then d.x else k.x || substr(d.x, 2 * k.hi + 1) end)) as kept_sha256
from d left join k on d.doc_id = k.doc_id
"""

OP9 = """
with p as (
  select page_id, coalesce(html, '') as b from pages
), d as (
  select page_id, strlen(b)::bigint as n, sha1(b) as digest, b from p
), m as (
  select *, max(page_id) over (partition by b) as top from d
)
select page_id, n as payload_bytes, digest as payload_digest, case when n >= 1000 and top <> page_id then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and top <> page_id then top end as refers_to from m
"""

SQL = {"op1_line_dedup": OP1, "op2_quality": OP2, "op3_topk": OP3, "op6_near_dup": OP6, "op7_suffix_dedup": OP7, "op9_warc": OP9}
