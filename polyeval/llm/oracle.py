"""DuckDB SQL for the queries whose contract SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

SUBSTRING_SQL = f"""
with d as (select doc_id, {_WORDS.format("coalesce(text, '')")} as ws from documents),
win as (select doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') as k
        from (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from d where len(ws) >= 35) w),
rep as (select k from win group by k having count(*) > 1),
hit as (select doc_id, i from win where k in (select k from rep)),
cov as (select distinct doc_id, unnest(range(i, i + 35)) as p from hit),
tok as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from d),
kept as (select t.doc_id, string_agg(t.word, ' ' order by t.p) as text
         from tok t anti join cov c on c.doc_id = t.doc_id and c.p = t.p group by t.doc_id),
gone as (select doc_id, count(*) as n from cov group by doc_id)
select d.doc_id, cast(len(d.ws) as bigint) as n_words, cast(coalesce(g.n, 0) as bigint) as n_removed,
       sha256(coalesce(k.text, '')) as kept_sha256
from d left join gone g using (doc_id) left join kept k using (doc_id)
"""

NEAR_SQL = f"""
with recursive d as (select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws from documents),
sh as (select distinct doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') as s
       from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from d where len(ws) > 0) w),
n as (select doc_id, count(*) as n from sh group by doc_id),
c as (select x.doc_id as a, y.doc_id as b, count(*) as c from sh x join sh y using (s) where x.doc_id < y.doc_id group by 1, 2),
l as (select a, b from c join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 85 * (na.n + nb.n - c)),
both_ways as (select a, b from l union all select b, a from l),
reach(doc_id, other) as (select doc_id, doc_id from documents union select r.doc_id, w.b from reach r join both_ways w on w.a = r.other),
comp as (select doc_id, min(other) as component_id from reach group by doc_id)
select comp.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, component_id, comp.doc_id = component_id as kept
from comp left join n using (doc_id)
"""

SUFFIX_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as hx, cast(strlen(coalesce(text, '')) as bigint) as n from documents),
win as (select doc_id, i, substr(hx, 2 * i + 1, 100) as k from (select doc_id, hx, unnest(range(0, n - 49)) as i from d where n >= 50) w),
least as (select k, min(doc_id) as m from win group by k having min(doc_id) < max(doc_id)),
hit as (select w.doc_id, w.i from win w join least l on l.k = w.k and l.m < w.doc_id),
edge as (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as new from hit),
run as (select doc_id, a, b, lag(b) over (partition by doc_id order by a) as before from (
  select doc_id, min(i) as a, max(i) + 50 as b from (
    select doc_id, i, sum(new) over (partition by doc_id order by i) as r from edge) e group by doc_id, r) g),
total as (select doc_id, sum(b - a) as removed, count(*) as spans, max(b) as last from run group by doc_id),
piece as (select r.doc_id, r.a as pos, substr(d.hx, 2 * coalesce(r.before, 0) + 1, 2 * (r.a - coalesce(r.before, 0))) as p from run r join d using (doc_id)
          union all select d.doc_id, d.n, substr(d.hx, 2 * coalesce(t.last, 0) + 1, 2 * (d.n - coalesce(t.last, 0))) from d left join total t using (doc_id)),
kept as (select doc_id, string_agg(p, '' order by pos) as hx from piece group by doc_id)
select d.doc_id, d.n as n_bytes, cast(coalesce(t.removed, 0) as bigint) as n_removed, cast(coalesce(t.spans, 0) as bigint) as n_spans,
       sha256(unhex(k.hx)) as kept_sha256
from d left join total t using (doc_id) join kept k using (doc_id)
"""


def _base32(sha1_hex: str) -> str:
    """SQL for the base32 form of 40 hexadecimal digits: five digits make four letters."""
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((cast('0x' || substr({h}, {at}, 5) as bigint) >> {shift}) & 31 as bigint), 1)"
    return " || ".join(letter.format(h=sha1_hex, at=1 + 5 * g, shift=s) for g in range(8) for s in (15, 10, 5, 0))


WARC_SQL = f"""
with p as (select page_id, coalesce(html, '') as html, max(page_id) over (partition by coalesce(html, '')) as top from pages),
h as (select *, sha1(html) as h from p)
select page_id, cast(strlen(html) as bigint) as payload_bytes, {_base32('h')} as payload_digest,
       case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id = top then null else top end as refers_to
from h
"""

NEGATIVES_SQL = """
with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
           from embeddings
           where label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
e as (select vec_id, label, unnest(v) as c, unnest(range(0, len(v))) as i from r),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(sum(a.c * b.c) as bigint) as score
      from e a join e b on a.i = b.i and a.vec_id <> b.vec_id where a.vec_id % 100 = 0 group by all),
p as (select anchor_id, id as positive_id, score as positive_score, row_number() over (partition by anchor_id order by score desc, id) as place
      from s where same qualify place <= 5),
w as (select p.anchor_id, p.positive_id, p.positive_score, s.id as negative_id, s.score as negative_score,
             cast(row_number() over (partition by p.anchor_id, p.place order by s.score desc, s.id) as int) as rank
      from p join s on s.anchor_id = p.anchor_id and not s.same
        and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from w where rank <= 5
"""
