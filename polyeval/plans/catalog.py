"""Named queries (Spark) and their SQL oracles.

Every query reads the driver's tables through the fixture views and runs the
library operators over all of it. ``QUERIES[name](spark, sf_dir)`` returns a
DataFrame; ``ORACLE[name]`` is DuckDB SQL over the same tables with the same
column names. Floating results are rounded to 6 digits on both sides where a
different summation order could change the last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import registry
from ..operators import extract as X
from ..operators.scores import merge_scores
from ..sources import fixtures, results
from . import oracle_sql as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- E1 family
def _docs(spark, sf_dir):
    return fixtures.result_documents(spark, sf_dir)


def _tasks(spark, sf_dir):
    """Parsed task rows of every document (all runs)."""
    return results.parse_documents(_docs(spark, sf_dir), "value", ["model", "run_id"])


@query("scan_results", f"""
with {O.e1()}, {O.DOC_ENTRIES},
kv as (
 select model, run_id, pos, task, 'acc_norm,none' as metric, score as value from ent where task like 'hellaswag\\_%' escape '\\'
 union all select model, run_id, pos, task, 'acc,none', score2 from ent where task like 'hellaswag\\_%' escape '\\'
 union all select model, run_id, pos, task, 'exact_match,flexible-extract', score from ent where task like 'mgsm\\_%' escape '\\'
 union all select model, run_id, pos, task, 'f1,none', score from ent where task like 'mlqa\\_%' escape '\\'
 union all select model, run_id, pos, task, 'acc,none', score from ent
   where not (task like 'hellaswag\\_%' escape '\\' or task like 'mgsm\\_%' escape '\\' or task like 'mlqa\\_%' escape '\\'))
select * from kv
""")
def q_scan_results(spark, sf_dir):
    t = _tasks(spark, sf_dir)
    return (t.select("model", "run_id", "pos", "task", F.explode("metrics").alias("metric", "v"))
             .select("model", "run_id", "pos", "task", "metric", F.btrim(F.col("v"), F.lit('"')).try_cast("double").alias("value")))


@query("result_path_match", f"""
with {O.e1()}, {O.DOC_ENTRIES}
select model, run_id, concat('/results/raw/', model, '/org__', model, '/results_', cast(run_id as varchar), '.json') as path
from docs where run_id <> 2
""")
def q_result_path_match(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    reg = fixtures.fixture_models(spark, sf_dir)
    return (results.result_path_match(docs, reg)
            .select(F.col("reg_model").alias("model"), "run_id", "path"))


@query("latest_run", f"""
with {O.e1()}, {O.DOC_ENTRIES}, {O.LATEST}
select l.model, l.run_id, d.mtime from latest l join docs d on d.model = l.model and d.run_id = l.run_id
""")
def q_latest_run(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return results.latest_run(d.select("model", "run_id", "mtime"), "model", "run_id", "mtime")


def _extract_query(bench: str | None):
    benches = [bench] if bench else None

    def fn(spark, sf_dir):
        return X.extract_scores(_tasks(spark, sf_dir), registry.aliases_df(spark),
                                keep=["model", "run_id"], benchmarks=benches)
    return fn


for _b in registry.BENCHMARKS:
    query(f"extract_{_b}", f"""
with {O.e1()}, {O.DOC_ENTRIES}, {O.extracted([_b])}
select model, run_id, pos, task, benchmark, lang_code, score from ex
""")(_extract_query(_b))


@query("union_extracts", f"""
with {O.e1()}, {O.DOC_ENTRIES}, {O.extracted()}
select model, run_id, pos, task, benchmark, lang_code, score from ex
""")
def q_union_extracts(spark, sf_dir):
    # the rule set's one pass is the union of the nine extractions
    return X.extract_scores(_tasks(spark, sf_dir), registry.aliases_df(spark), ["model", "run_id"])


@query("normalize_lang", f"""
with {O.e1()}, {O.DOC_ENTRIES}, {O.extracted()}
select benchmark, regexp_extract(task, '^(?:afrimmlu_direct_|afrixnli_|belebele_|global_mmlu_|hellaswag_|truthfulqa_|mgsm_direct_|mlqa_en_|include_base_44_)(.*)$', 1) as task_lang,
       lang_code, count(*) as n_rows
from ex group by 1, 2, 3
""")
def q_normalize_lang(spark, sf_dir):
    ex = X.extract_scores(_tasks(spark, sf_dir), registry.aliases_df(spark), keep=["model", "run_id"])
    lang = F.regexp_extract("task", r"^(?:afrimmlu_direct_|afrixnli_|belebele_|global_mmlu_|hellaswag_|"
                                    r"truthfulqa_|mgsm_direct_|mlqa_en_|include_base_44_)(.*)$", 1)
    return ex.groupBy("benchmark", lang.alias("task_lang"), "lang_code").agg(F.count(F.lit(1)).alias("n_rows"))


@query("falsy_or", f"""
with {O.e1()}, {O.DOC_ENTRIES}
select model, run_id, pos, score as acc_norm, score2 as acc,
       case when score is not null and score <> 0 then score else score2 end as picked
from ent where task like 'hellaswag\\_%' escape '\\'
""")
def q_falsy_or(spark, sf_dir):
    t = _tasks(spark, sf_dir).filter(F.col("task").startswith("hellaswag_"))
    a = results.metric_value(F.col("metrics"), "acc_norm,none")
    b = results.metric_value(F.col("metrics"), "acc,none")
    return t.select("model", "run_id", "pos", a.alias("acc_norm"), b.alias("acc"), X.falsy_or(a, b).alias("picked"))


@query("filter_scored", f"""
with {O.e1()}, {O.DOC_ENTRIES}, {O.extracted()}
select benchmark, count(*) as kept from f group by benchmark
""")
def q_filter_scored(spark, sf_dir):
    m = X.filter_scored(X.match_rules(_tasks(spark, sf_dir)))
    return m.groupBy("benchmark").agg(F.count(F.lit(1)).alias("kept"))


@query("merge_scores", f"""
with {O.e1()}, {O.DOC_ENTRIES}, {O.LATEST},
ent_latest as (select e.* from ent e join latest l on l.model = e.model and l.run_id = e.run_id),
{O.extracted(src='ent_latest')}
{O.merge_scores_sql()}
""")
def q_merge_scores(spark, sf_dir):
    from .benchmark_scores import score_table
    docs = _docs(spark, sf_dir)
    return score_table(docs, registry.aliases_df(spark), run_col="run_id")


# ---------------------------------------------------------------- E2 family
from ..functions import text as TX  # noqa: E402
from ..operators.bleu import corpus_bleu  # noqa: E402
from ..operators.chrf import corpus_chrf  # noqa: E402
from ..schemas import UNIT_KEYS  # noqa: E402
from .translation_metrics import prepare_segments  # noqa: E402


def _prepared(spark, sf_dir):
    return prepare_segments(fixtures.segments(spark, sf_dir))


@query("clean_translation", f"""
with {O.e2()}
select {O.UNIT}, seg_id, {O.clean_sql("translation")} as translation_clean from seg
""")
def q_clean_translation(spark, sf_dir):
    s = fixtures.segments(spark, sf_dir)
    return s.select(*UNIT_KEYS, "seg_id", TX.clean_translation("translation").alias("translation_clean"))


@query("corpus_bleu", O.bleu_sql())
def q_corpus_bleu(spark, sf_dir):
    return corpus_bleu(_prepared(spark, sf_dir), UNIT_KEYS, "hyp", "ref", tokenizer="13a")


@query("corpus_chrf", O.chrf_sql())
def q_corpus_chrf(spark, sf_dir):
    return corpus_chrf(_prepared(spark, sf_dir), UNIT_KEYS, "hyp", "ref")


@query("corpus_chrf_pp", O.chrf_pp_sql())
def q_corpus_chrf_pp(spark, sf_dir):
    """chrF++ (word order 2)."""
    return corpus_chrf(_prepared(spark, sf_dir), UNIT_KEYS, "hyp", "ref", word_order=2, out_col="chrf_pp")


@query("stringify_missing", f"""
select a.doc_id as seg_id, coalesce(a.text, 'nan') as source, coalesce(b.text, 'nan') as translation
from documents a left join documents b on b.doc_id = a.doc_id + 20
""")
def q_stringify_missing(spark, sf_dir):
    fixtures.register(spark, sf_dir, ["documents"])
    a = spark.table("documents").select("doc_id", F.col("text").alias("source"))
    b = spark.table("documents").select(F.col("doc_id").alias("b_id"), "text")
    j = a.join(b, F.col("b_id") == F.col("doc_id") + 20, "left")
    return j.select(F.col("doc_id").alias("seg_id"), TX.stringify_missing("source").alias("source"),
                    TX.stringify_missing("text").alias("translation"))


@query("split_pair", f"""
with {O.e2()},
u as (select distinct model, dataset, src_lang || '-' || tgt_lang as pair from seg
      union all select distinct model, dataset, src_lang || '-' || tgt_lang || '-x' from seg)
select model, dataset, pair,
  case when len(string_split(pair, '-')) = 2 then string_split(pair, '-')[1] end as src_lang,
  case when len(string_split(pair, '-')) = 2 then string_split(pair, '-')[2] end as tgt_lang,
  len(string_split(pair, '-')) = 2 as valid
from u
""")
def q_split_pair(spark, sf_dir):
    s = fixtures.segments(spark, sf_dir)
    pair = TX.make_pair("src_lang", "tgt_lang")
    u = s.select("model", "dataset", pair.alias("pair")).distinct()
    # malformed names (two hyphens) as they appear in a folder of pair files
    bad = s.select("model", "dataset", F.concat(pair, F.lit("-x")).alias("pair")).distinct()
    both = u.unionByName(bad)
    src, tgt, valid = TX.split_pair("pair")
    return both.select("model", "dataset", "pair", src.alias("src_lang"), tgt.alias("tgt_lang"), valid.alias("valid"))


@query("to_scorer_triple", f"""
with {O.e2()}, {O.PREP}
select {O.UNIT}, seg_id, src as source, ref as reference, hyp as hypothesis from p
""")
def q_to_scorer_triple(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return p.select(*UNIT_KEYS, "seg_id",
                    *TX.to_scorer_triple("src", "hyp", "ref", names=("source", "hypothesis", "reference")))


# ------------------------------------------- plug-ins, back-fill, status
from ..operators import correlate as C  # noqa: E402
from ..operators import joins as J  # noqa: E402
from ..operators import neural as U  # noqa: E402
from ..operators import status as K  # noqa: E402
from ..operators.meteor import meteor  # noqa: E402
from ..operators import bootstrap as B  # noqa: E402
from ..operators.rouge import rouge_l, rouge_l_interval  # noqa: E402
from . import standins  # noqa: E402
from .translation_metrics import metric_row  # noqa: E402

_RATIO = "cast(least(length({a}), length({b})) as double) / greatest(length({a}), length({b}), 1)"


@query("neural_system_score", f"""
with {O.e2()}, {O.PREP}
select {O.UNIT}, round_even(avg({_RATIO.format(a='hyp', b='ref')}), 4) as xcomet from p group by {O.UNIT}
""")
def q_neural_system_score(spark, sf_dir):
    return U.system_score(_prepared(spark, sf_dir), UNIT_KEYS, standins.length_ratio_scorer, "xcomet",
                          batch_size=128)


# Longest common subsequences as chains of matching positions: hypothesis positions ascending, a
# position's matches descending, folded into the least last position of a chain of each length.
_ROUGE = f"""
tk as (select {O.UNIT}, seg_id, regexp_extract_all(lower(hyp), '[a-z0-9]+') as h, regexp_extract_all(lower(ref), '[a-z0-9]+') as r from p),
hw as (select seg_id, unnest(h) as w, unnest(range(0, len(h))) as i from tk),
rw as (select seg_id, unnest(r) as w, unnest(range(0, len(r))) as j from tk),
pr as (select seg_id, list([cast(j as int)] order by i, j desc) as js from hw join rw using (seg_id, w) group by seg_id),
lcs as (select seg_id, len(list_reduce(js, lambda a, x: list_concat(list_concat(a[1:len(list_filter(a, lambda t: t < x[1]))], x),
                                                                    a[len(list_filter(a, lambda t: t < x[1])) + 2:]))) as l from pr),
rl as (select {O.UNIT}, seg_id, case when l is null then 0.0 else 2.0 * (l / cast(len(r) as double)) * (l / cast(len(h) as double))
              / ((l / cast(len(r) as double)) + (l / cast(len(h) as double))) end as f from tk left join lcs using (seg_id))"""


@query("rouge_l", f"""
with {O.e2()}, {O.PREP}, {_ROUGE}
select {O.UNIT}, round_even(avg(f), 4) as rouge_l from rl group by {O.UNIT}
""")
def q_rouge_l(spark, sf_dir):
    return rouge_l(_prepared(spark, sf_dir), UNIT_KEYS, "hyp", "ref")


@query("rouge_l_interval", f"""
with {O.e2()}, {O.PREP}, {_ROUGE},
sd as (select *, cast(floor(f * 1e9 + 0.5) as bigint) as amount,
              cast('0x' || substr(md5(concat_ws('/', {O.UNIT}, cast(seg_id as varchar))), 1, 16) as ubigint) as seed from rl),
x0 as (select {O.UNIT}, amount, s as sample, cast((cast(seed as uhugeint) + cast(s as uhugeint) * {B.GOLDEN}) % 18446744073709551616 as ubigint) as x
       from sd cross join range(1, {B.SAMPLES + 1}) t(s)),
x1 as (select * replace (cast((cast(xor(x, x >> 30) as uhugeint) * {B.MIX_1}) % 18446744073709551616 as ubigint) as x) from x0),
x2 as (select * replace (cast((cast(xor(x, x >> 27) as uhugeint) * {B.MIX_2}) % 18446744073709551616 as ubigint) as x) from x1),
x3 as (select * replace (xor(x, x >> 31) as x) from x2),
wt as (select *, {" + ".join(f"cast(x >= {t} as bigint)" for t in B.poisson_thresholds())} as w from x3),
mn as (select {O.UNIT}, sample, sum(w * amount) / 1e9 / sum(w) as mean from wt group by {O.UNIT}, sample having sum(w) > 0)
select {O.UNIT}, round_even(quantile_cont(mean, 0.5), 4) as rouge_l, round_even(quantile_cont(mean, 0.025), 4) as rouge_l_low,
       round_even(quantile_cont(mean, 0.975), 4) as rouge_l_high
from mn group by {O.UNIT}
""")
def q_rouge_l_interval(spark, sf_dir):
    """G4 as the reference's scorer reports it: the middle of 1,000 resamples, with the interval."""
    return rouge_l_interval(_prepared(spark, sf_dir), UNIT_KEYS)


@query("meteor")
def q_meteor(spark, sf_dir):
    return meteor(_prepared(spark, sf_dir), UNIT_KEYS, "hyp", "ref")


@query("metric_row")
def q_metric_row(spark, sf_dir):
    return metric_row(_prepared(spark, sf_dir), tokenizer="13a",
                      scorers={"xcomet": (standins.length_ratio_scorer, 128),
                               "ssa_comet": (standins.source_ratio_scorer, 128)})


@query("metric_row_native", f"""
with {O.e2()}, {O.PREP},
nb as ({O.bleu_sql()}),
nc as ({O.chrf_sql()}),
nx as (select {O.UNIT}, round_even(avg({_RATIO.format(a='hyp', b='ref')}), 4) as xcomet,
              round_even(avg({_RATIO.format(a='hyp', b='src')}), 4) as ssa_comet from p group by {O.UNIT})
select {O.UNIT}, nb.bleu, nc.chrf, cast(null as double) as rouge_l, cast(null as double) as meteor,
       nx.xcomet, nx.ssa_comet, cast(null as double) as metricx
from nb join nc using ({O.UNIT}) join nx using ({O.UNIT})
""")
def q_metric_row_native(spark, sf_dir):
    """G8 without the two UDF metrics, so every column has a SQL oracle."""
    return metric_row(_prepared(spark, sf_dir), tokenizer="13a", with_rouge_meteor=False,
                      scorers={"xcomet": (standins.length_ratio_scorer, 128),
                               "ssa_comet": (standins.source_ratio_scorer, 128)})


_ERR = "25.0 * (1.0 - " + _RATIO.format(a="hyp", b="ref") + ")"


@query("error_mean", f"""
with {O.e2()}, {O.PREP}
select {O.UNIT}, round(avg({_ERR}), 6) as error_mean from p group by {O.UNIT}
""")
def q_error_mean(spark, sf_dir):
    s = U.score_segments(_prepared(spark, sf_dir), standins.length_error_scorer, "err", batch_size=1, keep=UNIT_KEYS)
    return U.error_mean(s, UNIT_KEYS, "err").select(*UNIT_KEYS, F.round("error_mean", 6).alias("error_mean"))


@query("invert_error", f"""
with {O.e2()}, {O.PREP}
select {O.UNIT}, round_even(25 - avg({_ERR}), 4) as metricx from p group by {O.UNIT}
""")
def q_invert_error(spark, sf_dir):
    s = U.score_segments(_prepared(spark, sf_dir), standins.length_error_scorer, "err", batch_size=1, keep=UNIT_KEYS)
    return U.error_mean(s, UNIT_KEYS, "err").select(*UNIT_KEYS, U.invert_error("error_mean").alias("metricx"))


def _metrics0(prep: DataFrame) -> DataFrame:
    """An existing metric table: metricx present for ntrex only."""
    return (prep.groupBy(*UNIT_KEYS).agg(F.count(F.lit(1)).alias("n_segments"))
                .withColumn("metricx", F.when(F.col("dataset") == "ntrex", F.col("n_segments").cast("double"))))


_METRICS0 = f"""m0 as (select {O.UNIT}, count(*) as n_segments,
  case when dataset = 'ntrex' then cast(count(*) as double) end as metricx from p group by {O.UNIT})"""


@query("backfill_metric", f"""
with {O.e2()}, {O.PREP}, {_METRICS0},
new as (select {O.UNIT}, round_even(25 - avg({_ERR}), 4) as metricx from p
        where dataset <> 'ntrex' group by {O.UNIT})
select m0.model, m0.dataset, m0.src_lang, m0.tgt_lang, m0.n_segments, coalesce(m0.metricx, new.metricx) as metricx
from m0 left join new using ({O.UNIT})
""")
def q_backfill_metric(spark, sf_dir):
    prep = _prepared(spark, sf_dir)
    return J.backfill_error_metric(_metrics0(prep), prep, UNIT_KEYS, standins.length_error_scorer,
                                   "metricx", batch_size=1)


def _e2_models(spark, sf_dir):
    return fixtures.segments(spark, sf_dir).select("model").distinct()


_GRID = f"""grid as (select m.model, lc.dataset, 'eng' as src_lang, lc.lang_code as tgt_lang, lc.corpus_code
  from (select distinct model from seg) m, {O.lang_corpus_sql()} lc where lc.lang_code <> 'eng')"""


@query("translation_grid", f"""
with {O.e2()}, {_GRID}
select * from grid
""")
def q_translation_grid(spark, sf_dir):
    return J.translation_grid(_e2_models(spark, sf_dir))


@query("pending_units", f"""
with {O.e2()}, {_GRID}
select g.model, g.dataset, g.src_lang, g.tgt_lang from grid g
where not exists (select 1 from seg s where s.model = g.model and s.dataset = g.dataset
                  and s.src_lang = g.src_lang and s.tgt_lang = g.tgt_lang)
""")
def q_pending_units(spark, sf_dir):
    grid = J.translation_grid(_e2_models(spark, sf_dir)).select(*UNIT_KEYS)
    done = fixtures.segments(spark, sf_dir).select(*UNIT_KEYS)
    return J.pending_units(grid, done, UNIT_KEYS)


@query("coverage_counts", f"""
with {O.e2()}, {O.PREP}, {_METRICS0}, {_GRID},
j as (select g.model, g.dataset, m0.n_segments, m0.metricx from grid g left join m0 using ({O.UNIT}))
select model, dataset, count(*) as n_expected, count(n_segments) as n_present,
       count(*) filter (where n_segments is null) as n_absent,
       count(*) filter (where n_segments is not null and (metricx is null or isnan(metricx))) as n_missing_metric
from j group by model, dataset
""")
def q_coverage_counts(spark, sf_dir):
    from ..functions.text import is_missing_numeric
    prep = _prepared(spark, sf_dir)
    grid = J.translation_grid(_e2_models(spark, sf_dir))
    produced = _metrics0(prep).withColumn("miss", is_missing_numeric("metricx"))
    return K.coverage_counts(grid, produced, ["model", "dataset"], UNIT_KEYS, missing_flag="miss")


@query("run_status", f"""
with {O.e2()}, {_GRID},
st as (
 select 'evaluate' as stage, g.model || '/' || g.dataset || '/' || g.src_lang || '/' || g.tgt_lang as unit,
   case when exists (select 1 from seg s where s.model = g.model and s.dataset = g.dataset and s.tgt_lang = g.tgt_lang)
        then 'ok' else 'missing' end as status,
   case when exists (select 1 from seg s where s.model = g.model and s.dataset = g.dataset and s.tgt_lang = g.tgt_lang)
        then NULL else 'no output for unit' end as detail
 from grid g
 union all
 select distinct 'evaluate', model || '/' || dataset || '/' || src_lang || '/' || tgt_lang || '-x', 'error',
   'pair name ' || src_lang || '-' || tgt_lang || '-x' || ' is not src-tgt'
 from seg)
select * from st
""")
def q_run_status(spark, sf_dir):
    seg = fixtures.segments(spark, sf_dir)
    grid = J.translation_grid(_e2_models(spark, sf_dir))
    pair = F.concat(TX.make_pair("src_lang", "tgt_lang"), F.lit("-x"))
    files = seg.select("model", "dataset", pair.alias("pair")).distinct()
    src, tgt, valid = TX.split_pair("pair")
    parsed = files.select("model", "dataset", "pair", src.alias("src_lang"), tgt.alias("tgt_lang"), valid.alias("ok"))
    errors = (parsed.filter(~F.col("ok"))
              .select("model", "dataset", F.lit("eng").alias("src_lang"),
                      F.regexp_extract("pair", "^[^-]*-(.*)$", 1).alias("tgt_lang"),
                      F.concat(F.lit("pair name "), F.col("pair"), F.lit(" is not src-tgt")).alias("detail")))
    return K.unit_status(grid, seg, UNIT_KEYS, "evaluate", errors=errors)


# --------------------------------------------------------- E3: correlation
def _aligned(spark, sf_dir):
    sm = fixtures.score_metric(spark, sf_dir)
    scores = sm.unpivot(["model", "lang_id"], ["score_a", "score_b"], "benchmark", "score")
    metrics = sm.unpivot(["model", "lang_id"], ["metric_x", "metric_y"], "metric", "value")
    return C.align_scores_metrics(scores, metrics, ["model", "lang_id"])


_ALIGNED = f"""{O.e3()},
sl as (select model, lang_id, 'score_a' as benchmark, score_a as score from sm
       union all select model, lang_id, 'score_b', score_b from sm),
ml as (select model, lang_id, 'metric_x' as metric, metric_x as value from sm
       union all select model, lang_id, 'metric_y', metric_y from sm),
al as (select sl.model, sl.lang_id, benchmark, score, metric, value from sl join ml using (model, lang_id))"""


@query("align_scores_metrics", f"""
with {_ALIGNED}
select model, lang_id, benchmark, round(score, 6) as score, metric, round(value, 6) as value from al
""")
def q_align_scores_metrics(spark, sf_dir):
    a = _aligned(spark, sf_dir)
    return a.select("model", "lang_id", "benchmark", F.round("score", 6).alias("score"), "metric",
                    F.round("value", 6).alias("value"))


@query("pearson_by_benchmark", f"""
with {_ALIGNED}
select model, benchmark, metric, round(corr(value, score), 6) as r, count(*) as n_langs
from al group by model, benchmark, metric
""")
def q_pearson_by_benchmark(spark, sf_dir):
    r = C.pearson_by_benchmark(_aligned(spark, sf_dir), ["model", "benchmark", "metric"])
    return r.select("model", "benchmark", "metric", F.round("r", 6).alias("r"), "n_langs")


@query("median_correlation", f"""
with {_ALIGNED},
r as (select model, benchmark, metric, corr(value, score) as r from al group by model, benchmark, metric)
select model, metric, round(median(r), 6) as median_r, count(r) as n_r from r group by model, metric
""")
def q_median_correlation(spark, sf_dir):
    r = C.pearson_by_benchmark(_aligned(spark, sf_dir), ["model", "benchmark", "metric"])
    m = C.median_correlation(r, ["model", "metric"])
    return m.select("model", "metric", F.round("median_r", 6).alias("median_r"), "n_r")


# ----------------------------------------------------- corpora and prompts
from ..sources import corpus as S  # noqa: E402


@query("scan_corpus", f"""
with c as ({fixtures.E4_SQL})
select dataset, split, seg_id, eng_Latn, fra_Latn, deu_Latn, spa_Latn, fr_FR, de_DE, es_MX from c
where split = case dataset when 'flores-200' then 'devtest' when 'wmt24' then 'train' else 'test' end
""")
def q_scan_corpus(spark, sf_dir):
    return S.scan_corpus(fixtures.corpus_wide(spark, sf_dir))


_PAIRS = f"""c as ({fixtures.E4_SQL}),
cs as (select * from c where split = case dataset when 'flores-200' then 'devtest' when 'wmt24' then 'train' else 'test' end),
lc as {O.lang_corpus_sql()},
long as (
  select dataset, seg_id, eng_Latn, 'fra_Latn' as corpus_code, fra_Latn as target from cs
  union all select dataset, seg_id, eng_Latn, 'deu_Latn', deu_Latn from cs
  union all select dataset, seg_id, eng_Latn, 'spa_Latn', spa_Latn from cs
  union all select dataset, seg_id, eng_Latn, 'fr_FR', fr_FR from cs
  union all select dataset, seg_id, eng_Latn, 'de_DE', de_DE from cs
  union all select dataset, seg_id, eng_Latn, 'es_MX', es_MX from cs),
pairs as (select l.dataset, l.seg_id, 'eng' as src_lang, lc.lang_code as tgt_lang, l.eng_Latn as source, l.target
  from long l join lc on lc.dataset = l.dataset and lc.corpus_code = l.corpus_code
  where l.target is not null and l.eng_Latn is not null)"""


def _pairs(spark, sf_dir):
    wide = S.scan_corpus(fixtures.corpus_wide(spark, sf_dir))
    return S.select_pair_columns(wide, J.lang_corpus_df(spark))


@query("select_pair_columns", f"""
with {_PAIRS}
select * from pairs
""")
def q_select_pair_columns(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query("drop_leading_row", f"""
with {_PAIRS}
select dataset, tgt_lang, count(*) as n_segments, min(seg_id) as first_seg from pairs
where not (dataset = 'wmt24' and seg_id = 0) group by dataset, tgt_lang
""")
def q_drop_leading_row(spark, sf_dir):
    d = S.drop_leading_row(_pairs(spark, sf_dir))
    return d.groupBy("dataset", "tgt_lang").agg(F.count(F.lit(1)).alias("n_segments"),
                                                F.min("seg_id").alias("first_seg"))


@query("build_prompt", f"""
with {_PAIRS},
pr as (select p.dataset, p.seg_id, p.tgt_lang, {O.prompt_sql('l.name', 'p.source')} as prompt
  from pairs p join {O.languages_values()} l on l.lang_code = p.tgt_lang
  where not (p.dataset = 'wmt24' and p.seg_id = 0))
select dataset, seg_id, tgt_lang, prompt from pr
""")
def q_build_prompt(spark, sf_dir):
    from .. import registry as R
    pairs = S.drop_leading_row(_pairs(spark, sf_dir))
    names = R.languages_df(spark).select(F.col("lang_code").alias("tgt_lang"), "name")
    j = pairs.join(F.broadcast(names), "tgt_lang")  # fixed 120-row table
    return j.select("dataset", "seg_id", "tgt_lang", S.build_prompt(j, "name", "source").alias("prompt"))


def _requests(spark, sf_dir):
    """Prompts from the turns of ``conversations``: each conversation is
    assigned a registry model and a target language by id."""
    from .. import registry as R
    fixtures.register(spark, sf_dir, ["conversations"])
    conv = spark.table("conversations")
    n_models = len(R._rows(R.MODELS_CSV))
    n_langs = len(R._rows(R.LANGUAGES_CSV))
    midx = spark.createDataFrame([(i, r[0], r[2]) for i, r in enumerate(R._rows(R.MODELS_CSV))],
                                 "midx long, model string, family string")
    lidx = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(R._rows(R.LANGUAGES_CSV))],
                                 "lidx long, tgt_lang string, name string")
    c = conv.select("conv_id", F.col("turn").alias("seg_id"), F.col("text").alias("source"),
                    (F.col("conv_id") % n_models).alias("midx"), (F.col("conv_id") % n_langs).alias("lidx"))
    c = c.join(F.broadcast(midx), "midx").join(F.broadcast(lidx), "lidx")  # fixed registry tables
    c = S.with_sampling(c, R.sampling_df(spark))
    return c.withColumn("prompt", S.build_prompt(c, "name", "source"))


_REQ = f"""req as (
 select c.conv_id, c.turn as seg_id, m.model, m.family, l.lang_code as tgt_lang,
   {O.prompt_sql('l.name', 'c.text')} as prompt,
   coalesce(s.temperature, 0.7) as temperature, s.top_p, s.top_k, coalesce(s.max_tokens, 1024) as max_tokens
 from conversations c
 join {O.models_values()} m on m.idx = c.conv_id % 15
 join {O.languages_indexed()} l on l.idx = c.conv_id % 120
 left join {O.sampling_values()} s on s.family = m.family)"""


@query("sampling_for_family", f"""
with {_REQ}
select conv_id, seg_id, model, temperature, top_p, top_k, max_tokens from req
""")
def q_sampling_for_family(spark, sf_dir):
    return _requests(spark, sf_dir).select("conv_id", "seg_id", "model", "temperature", "top_p", "top_k",
                                           "max_tokens")


@query("generate_translations", f"""
with {_REQ}
select conv_id, seg_id, model, tgt_lang, cast(length(prompt) as varchar) || ' ' || cast(temperature as varchar) as translation
from req
""")
def q_generate_translations(spark, sf_dir):
    r = _requests(spark, sf_dir)
    g = U.generate(r, standins.echo_generator, "prompt", "translation")
    return g.select("conv_id", "seg_id", "model", "tgt_lang", "translation")


from . import storage_queries  # noqa: E402,F401  (registers its queries)
