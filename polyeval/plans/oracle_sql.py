"""Independent SQL (DuckDB dialect) for the registered queries.

The fixture views are the same SQL text Spark runs; everything after them is
written here in plain SQL. Fixed-value tables (aliases, languages) are inlined
as VALUES lists generated from the registry text, so there is one copy.
"""

from __future__ import annotations

from .. import registry
from ..sources import fixtures


def _q(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def aliases_values() -> str:
    rows = ",".join(f"({_q(m)},{_q(r)},{_q(c)})" for m, r, c in registry._rows(registry.ALIASES_CSV))
    return f"(select * from (values {rows}) v(map_name, raw_code, lang_code))"


def languages_values() -> str:
    rows = ",".join("(" + ",".join(_q(registry._nz(x)) for x in r) + ")"
                    for r in registry._rows(registry.LANGUAGES_CSV))
    return f"(select * from (values {rows}) v(lang_code, name, flores_code, wmt_code, ntrex_code))"


def e1() -> str:
    return f"raw as ({fixtures.E1_SQL})"


def e2() -> str:
    return f"seg as ({fixtures.E2_SQL})"


def e3() -> str:
    return f"sm as ({fixtures.E3_SQL})"


# Long task rows of the E1 documents: pos = index in the document, one row per
# metric entry (the fixture writes acc_norm/acc for hellaswag, the rule metric
# for the rest).
DOC_ENTRIES = """
ent as (
 select model, run_id, task, cast(row_number() over (partition by model, run_id order by pos) - 1 as integer) as pos,
        ts, score, score2 from raw),
docs as (select model, run_id, max(ts) as mtime from raw group by model, run_id)
"""


def _rule_case(value_of) -> str:
    parts = []
    for r in registry.RULES:
        bench, pattern = r[0], r[1]
        parts.append(f"when regexp_matches(task, {_q(pattern)}) then {value_of(r)}")
    return "case " + " ".join(parts) + " end"


def extracted(where_bench: list[str] | None = None, src: str = "ent") -> str:
    """SQL CTE 'ex' with (model, run_id, pos, task, benchmark, lang_code, score)."""
    bench = _rule_case(lambda r: _q(r[0]))
    raw_code = _rule_case(lambda r: f"regexp_extract(task, {_q(r[1])}, 1)")
    script = _rule_case(lambda r: f"regexp_extract(task, {_q(r[1])}, 2)" if r[6] == "script" else "NULL")
    # hellaswag: acc_norm unless null or 0, then acc
    score = _rule_case(lambda r: "case when score is not null and score <> 0 then score else score2 end"
                       if r[3] else "score")
    amap = _rule_case(lambda r: _q(r[5]))
    policy = _rule_case(lambda r: _q(r[6]))
    excl = _rule_case(lambda r: _q(r[4]))
    filt = ""
    if where_bench:
        filt = "and benchmark in (" + ",".join(_q(b) for b in where_bench) + ")"
    return f"""
m as (
 select model, run_id, pos, task, {bench} as benchmark, {raw_code} as raw_code, {script} as script,
        {score} as score, {amap} as alias_map, {policy} as policy, {excl} as excluded
 from {src}),
f as (select * from m where benchmark is not null {filt}
      and (excluded is null or raw_code <> excluded) and score is not null),
ex0 as (
 select f.model, f.run_id, f.pos, f.task, f.benchmark,
   case when f.policy = 'drop' then a.lang_code
        when f.policy = 'script' then case when f.raw_code = 'zho' and f.script = 'Hant' then 'zho_trad' else f.raw_code end
        else coalesce(a.lang_code, f.raw_code) end as lang_code,
   f.score
 from f left join {aliases_values()} a on a.map_name = f.alias_map and a.raw_code = f.raw_code),
ex as (select * from ex0 where lang_code is not null)
"""


def merge_scores_sql(src: str = "ex") -> str:
    cols = ",\n ".join(
        f"min_by(score, pos) filter (where benchmark = {_q(b)} and score is not null and not isnan(score)) as {b}"
        for b in registry.BENCHMARKS)
    return f"select model, lang_code,\n {cols}\nfrom {src} where lang_code is not null group by model, lang_code"


LATEST = """
latest as (select model, run_id from (
  select model, run_id, row_number() over (partition by model order by mtime desc, run_id desc) as rn from docs) where rn = 1)
"""


# ----------------------------------------------------------------- E2 family
UNIT = "model, dataset, src_lang, tgt_lang"


def clean_sql(x: str) -> str:
    """P4 in SQL: drop through the last </think> (greedy), strip whitespace."""
    return rf"regexp_replace(regexp_replace({x}, '(?s)^.*</think>', ''), '^\s+|\s+$', '', 'g')"


PREP = rf"""
p as (
 select {UNIT}, seg_id, coalesce(source, 'nan') as src,
   {clean_sql("coalesce(translation, 'nan')")} as hyp,
   coalesce(target, 'nan') as ref
 from seg),
units as (select distinct {UNIT} from p)
"""


def tok13a_sql(x: str) -> str:
    s = rf"regexp_replace({x}, '\s+$', '')"
    s = f"replace(replace(replace({s}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    s = f"""replace(replace(replace(replace({s}, '&quot;', '"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"""
    s = f"(' ' || {s} || ' ')"
    s = rf"regexp_replace({s}, '([\{{-\~\[-\` -\&\(-\+\:-\@\/])', ' \1 ', 'g')"
    s = rf"regexp_replace({s}, '([^0-9])([\.,])', '\1 \2 ', 'g')"
    s = rf"regexp_replace({s}, '([\.,])([^0-9])', ' \1 \2', 'g')"
    s = rf"regexp_replace({s}, '([0-9])(-)', '\1 \2 ', 'g')"
    s = rf"regexp_replace(regexp_replace({s}, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"
    return s


def ngram_stats_sql(lists: str, orders: list[int], sep: str, clip: bool, prefix: str = "") -> str:
    """CTEs from ``lists`` (UNIT, seg_id, side, tl = list of characters or
    tokens) to per_n (UNIT, n, hyp, ref, match). n-grams are built with
    lead() over the unnested list (linear in the text length)."""
    top = max(orders)
    leads = ", ".join(f"lead(x, {k}) over w as l{k}" for k in range(1, top))
    j = f" || '{sep}' || " if sep else " || "
    grams = " union all ".join(
        f"select {UNIT}, seg_id, side, {n} as n, " + j.join(["x"] + [f"l{k}" for k in range(1, n)])
        + f" as gram from {prefix}xs where pos <= len - {n} + 1" for n in orders)
    h_eff = "case when r > 0 then h else 0 end" if clip else "h"
    P = prefix
    return f"""
{P}x1 as (select {UNIT}, seg_id, side, len(tl) as len, unnest(tl) as x, generate_subscripts(tl, 1) as pos from {lists}),
{P}xs as (select *{', ' + leads if leads else ''} from {P}x1 window w as (partition by {UNIT}, seg_id, side order by pos)),
{P}g as ({grams}),
{P}cnt as (select {UNIT}, seg_id, n, gram, sum(1 - side) as h, sum(side) as r from {P}g group by {UNIT}, seg_id, n, gram),
{P}seg_n as (select {UNIT}, seg_id, n, sum(h) as h, sum(r) as r, sum(least(h, r)) as m from {P}cnt group by {UNIT}, seg_id, n),
{P}per_n as (select {UNIT}, n, sum({h_eff}) as hyp, sum(r) as ref, sum(m) as match from {P}seg_n group by {UNIT}, n)
"""


def bleu_sql() -> str:
    orders = [1, 2, 3, 4]
    tok = f"""
tk as (select {UNIT}, seg_id, 0 as side, {tok13a_sql('hyp')} as t from p
       union all select {UNIT}, seg_id, 1, {tok13a_sql('ref')} from p),
tl as (select {UNIT}, seg_id, side, case when t = '' then []::varchar[] else string_split(t, ' ') end as tl from tk),"""
    stats = ngram_stats_sql("tl", orders, " ", clip=False)
    wide = ", ".join(f"coalesce(sum(hyp) filter (where n = {n}), 0) as t{n}, "
                     f"coalesce(sum(match) filter (where n = {n}), 0) as c{n}, "
                     f"coalesce(sum(ref) filter (where n = {n}), 0) as r{n}" for n in orders)
    ks, logs = [], []
    for n in orders:
        ks.append(" + ".join(f"(case when c{m} = 0 and t{m} > 0 then 1 else 0 end)" for m in orders[:n]))
        p = (f"(case when t{n} = 0 then 0.0 when c{n} = 0 then 100.0 / (pow(2, {ks[-1]}) * t{n}) "
             f"else 100.0 * c{n} / t{n} end)")
        logs.append(f"(case when {p} = 0 then -9999999999 else ln({p}) end)")
    bp = "(case when t1 < r1 then (case when t1 > 0 then exp(1 - r1 / t1) else 0.0 end) else 1.0 end)"
    score = f"case when c1 + c2 + c3 + c4 = 0 then 0.0 else {bp} * exp(({' + '.join(logs)}) / 4.0) end"
    return f"""
with {e2()}, {PREP}, {tok}
{stats},
w as (select {UNIT}, {wide} from per_n group by {UNIT}),
wu as (select u.model, u.dataset, u.src_lang, u.tgt_lang, coalesce(t1,0) t1, coalesce(t2,0) t2, coalesce(t3,0) t3,
              coalesce(t4,0) t4, coalesce(c1,0) c1, coalesce(c2,0) c2, coalesce(c3,0) c3, coalesce(c4,0) c4,
              coalesce(r1,0) r1
       from units u left join w using ({UNIT}))
select {UNIT}, round_even({score}, 2) as bleu, cast(t1 as bigint) as sys_len, cast(r1 as bigint) as ref_len from wu
"""


def chrf_sql() -> str:
    orders = [1, 2, 3, 4, 5, 6]
    cc = rf"""
cc as (select {UNIT}, seg_id, 0 as side, string_split(regexp_replace(hyp, '\s+', '', 'g'), '') as tl from p
       union all select {UNIT}, seg_id, 1, string_split(regexp_replace(ref, '\s+', '', 'g'), '') from p),"""
    stats = ngram_stats_sql("cc", orders, "", clip=True)
    return f"""
with {e2()}, {PREP}, {cc}
{stats},
pr as (select {UNIT},
   avg(match / hyp) filter (where hyp > 0 and ref > 0) as P,
   avg(match / ref) filter (where hyp > 0 and ref > 0) as R
 from per_n group by {UNIT})
select u.model, u.dataset, u.src_lang, u.tgt_lang,
  round_even(case when coalesce(P, 0) + coalesce(R, 0) > 0 then 100.0 * 5 * P * R / (4 * P + R) else 0.0 end, 2) as chrf
from units u left join pr using ({UNIT})
"""


def lang_corpus_sql() -> str:
    L = languages_values()
    return f"""(select lang_code, name, 'flores-200' as dataset, flores_code as corpus_code from {L} x where flores_code is not null
 union all select lang_code, name, 'wmt24', wmt_code from {L} x where wmt_code is not null
 union all select lang_code, name, 'ntrex', ntrex_code from {L} x where ntrex_code is not null)"""


def models_values() -> str:
    rows = ",".join(f"({i},{_q(r[0])},{_q(r[2])})" for i, r in enumerate(registry._rows(registry.MODELS_CSV)))
    return f"(select * from (values {rows}) v(idx, model, family))"


def sampling_values() -> str:
    def v(x):
        return "NULL" if x is None else repr(x)
    rows = ",".join(f"({_q(f)},{v(t)},{v(p)},{v(k)},{v(m)})" for f, t, p, k, m in registry.SAMPLING)
    return (f"(select family, cast(temperature as double) temperature, cast(top_p as double) top_p, "
            f"cast(top_k as integer) top_k, cast(max_tokens as integer) max_tokens "
            f"from (values {rows}) v(family, temperature, top_p, top_k, max_tokens))")


def languages_indexed() -> str:
    rows = ",".join(f"({i},{_q(r[0])},{_q(r[1])})" for i, r in enumerate(registry._rows(registry.LANGUAGES_CSV)))
    return f"(select * from (values {rows}) v(idx, lang_code, name))"


def prompt_sql(name: str, text: str) -> str:
    t = registry.PROMPT_TEMPLATES["thinking_off"]
    a, rest = t.split("{name}", 1)
    b, rest = rest.split("{text}", 1)
    c, d = rest.split("{name}", 1)
    return f"({_q(a)} || {name} || {_q(b)} || {text} || {_q(c)} || {name} || {_q(d)})".replace(
        "\n", "' || chr(10) || '")




def chrf_pp_sql() -> str:
    """chrF++: character 1-6-grams plus word 1-2-grams (one punctuation mark
    split off a word's end, else its start), eight orders averaged."""
    from ..functions.tokenize import PUNCTUATION
    punct = _q(PUNCTUATION)
    words = (r"case when regexp_replace({x}, '^\s+|\s+$', '', 'g') = '' then []::varchar[] "
             r"else flatten(list_transform(string_split_regex(regexp_replace({x}, '^\s+|\s+$', '', 'g'), '\s+'), "
             "lambda w: case when length(w) = 1 then [w] "
             f"when contains({punct}, right(w, 1)) then [left(w, length(w) - 1), right(w, 1)] "
             f"when contains({punct}, left(w, 1)) then [left(w, 1), substr(w, 2)] "
             "else [w] end)) end")
    cc = rf"""
cc as (select {UNIT}, seg_id, 0 as side, string_split(regexp_replace(hyp, '\s+', '', 'g'), '') as tl from p
       union all select {UNIT}, seg_id, 1, string_split(regexp_replace(ref, '\s+', '', 'g'), '') from p),
ww as (select {UNIT}, seg_id, 0 as side, {words.replace('{x}', 'hyp')} as tl from p
       union all select {UNIT}, seg_id, 1, {words.replace('{x}', 'ref')} from p),"""
    c_stats = ngram_stats_sql("cc", [1, 2, 3, 4, 5, 6], "", clip=True, prefix="c_")
    w_stats = ngram_stats_sql("ww", [1, 2], " ", clip=True, prefix="w_")
    return f"""
with {e2()}, {PREP}, {cc}
{c_stats},
{w_stats},
per_n as (select * from c_per_n union all select {UNIT}, n + 6, hyp, ref, match from w_per_n),
pr as (select {UNIT},
   avg(match / hyp) filter (where hyp > 0 and ref > 0) as P,
   avg(match / ref) filter (where hyp > 0 and ref > 0) as R
 from per_n group by {UNIT})
select u.model, u.dataset, u.src_lang, u.tgt_lang,
  round_even(case when coalesce(P, 0) + coalesce(R, 0) > 0 then 100.0 * 5 * P * R / (4 * P + R) else 0.0 end, 2) as chrf_pp
from units u left join pr using ({UNIT})
"""
