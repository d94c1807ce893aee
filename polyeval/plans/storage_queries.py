"""Registered round trips through storage: each writes the operators' own layout
under the shared checkpoint folder, reads it back and goes on from there."""

from __future__ import annotations

import sys

from pyspark.sql import functions as F

from .. import registry
from ..operators import extract as X
from ..operators import joins as J
from ..operators import neural as U
from ..operators import status as K
from ..operators.external import external_scorer
from ..operators.correlate import align_scores_metrics, median_correlation, pearson_by_benchmark
from ..schemas import METRICS, SEGMENTS, UNIT_KEYS
from ..session import scratch_path
from ..sources import fixtures, ordered, results, store, versions
from ..streaming import incremental as I
from . import oracle_sql as O
from . import standins
from .catalog import _ERR, _METRICS0, _PAIRS, _RATIO, _docs, _metrics0, _pairs, _prepared, _tasks, q_merge_scores, query
from .translation import translate_pending


@query("write_segments", f"""
with {O.e2()}
select model, dataset, src_lang, tgt_lang, seg_id, source, target, translation from seg
""")
def q_write_segments(spark, sf_dir):
    """K2 and its scan."""
    path = scratch_path(spark, "segments")
    store.write_segments(fixtures.segments(spark, sf_dir), path)
    return store.read_segments(spark, path)


def _na_sql(c: str) -> str:
    """A cell as pandas reads it (the default missing strings are NULL)."""
    known = ", ".join("'" + x + "'" for x in store.PANDAS_NA)
    return f"case when {c} in ({known}) then null else {c} end as {c}"


@query("scan_segments", f"""
with {O.e2()}
select model, dataset, src_lang, tgt_lang, {_na_sql('source')}, {_na_sql('target')}, {_na_sql('translation')} from seg
""")
def q_scan_segments(spark, sf_dir):
    """Units as CSV files of 40 columns, read back by their headers. The wanted columns
    are the first in the files of one corpus, the last in another's, and apart in the third's."""
    base = scratch_path(spark, "segment-files")
    seg = fixtures.segments(spark, sf_dir)
    more = [F.concat(F.lit(f"{i}, "), F.col("tgt_lang")).alias(f"extra_{i}") for i in range(37)]
    wide = seg.select("*", *more)
    names = [f"extra_{i}" for i in range(37)]
    store.write_segment_files(wide.where("dataset = 'flores-200'"), base, names)
    for dataset, order in (("ntrex", [*names, "translation", "target", "source"]), ("wmt24", ["target", *names, "source", "extra_x", "translation"])):
        rows = wide.where(F.col("dataset") == dataset).withColumn("extra_x", F.lit('a "quoted"\nfield'))
        store.write_segment_files(rows, base, tuple(n for n in order if n not in ("source", "target", "translation")), order)
    return store.scan_segments(spark, base).drop("seg_id")


@query("write_scores", f"""
with {O.e1()}, {O.DOC_ENTRIES}, {O.LATEST},
ent_latest as (select e.* from ent e join latest l on l.model = e.model and l.run_id = e.run_id),
{O.extracted(src='ent_latest')}
{O.merge_scores_sql()}
""")
def q_write_scores(spark, sf_dir):
    """K1 and its scan."""
    path = scratch_path(spark, "scores")
    scores = q_merge_scores(spark, sf_dir)
    store.write_scores(scores, path)
    return spark.read.option("header", True).schema(scores.schema).csv(path).select(*scores.columns)


def _stored_metrics(spark, sf_dir):
    """A metric table whose metricx is known for ntrex only, as METRICS rows."""
    m = _metrics0(_prepared(spark, sf_dir))
    cols = [F.col("n_segments").cast("double").alias("bleu") if f.name == "bleu" else F.col(f.name) if f.name in (*UNIT_KEYS, "metricx")
            else F.lit(None).cast("double").alias(f.name) for f in METRICS.fields]
    return m.select(*cols)


@query("upsert_metrics", f"""
with {O.e2()}, {O.PREP}, {_METRICS0}
select {O.UNIT}, cast(n_segments as double) as bleu,
       case when dataset = 'wmt24' and tgt_lang <> 'fra' then 7.5 else metricx end as metricx
from m0
""")
def q_upsert_metrics(spark, sf_dir):
    """A part of some partitions' rows is replaced, all others stay."""
    path = scratch_path(spark, "metrics")
    store.append_metrics(_stored_metrics(spark, sf_dir), path)
    changed = store.scan_metrics(spark, path).where("dataset = 'wmt24' and tgt_lang <> 'fra'")
    store.upsert_metrics(spark, changed.withColumn("metricx", F.lit(7.5)), path)
    return store.scan_metrics(spark, path).select(*UNIT_KEYS, "bleu", "metricx")


@query("external_scorer", f"""
with {O.e2()}, {O.PREP}, {_METRICS0},
new as (select {O.UNIT}, round_even(25 - avg({_ERR}), 4) as metricx from p
        where dataset <> 'ntrex' group by {O.UNIT})
select m0.model, m0.dataset, m0.src_lang, m0.tgt_lang, coalesce(m0.metricx, new.metricx) as metricx
from m0 left join new using ({O.UNIT})
""")
def q_external_scorer(spark, sf_dir):
    """The missing units' segments go to a scorer outside as files, by
    unit, and its predictions come back into the metric table. (The scorer's part
    is played by an expression.)"""
    sent, answered, table = (scratch_path(spark, x) for x in ("scorer-in", "scorer-out", "metrics"))
    store.append_metrics(_stored_metrics(spark, sf_dir), table)
    metrics = store.scan_metrics(spark, table)
    todo = J.semi_join_units(_prepared(spark, sf_dir), J.missing_metric(metrics, "metricx"), UNIT_KEYS)
    store.export_scorer_jsonl(todo, sent, by_unit=True)
    size = lambda c: F.length(F.coalesce(c, F.lit("")))
    ratio = F.least(size("hypothesis"), size("reference")) / F.greatest(size("hypothesis"), size("reference"), F.lit(1))
    given = store.scan_predictions(spark, sent, by_unit=True).withColumn("prediction", 25.0 * (1.0 - ratio))
    given.write.partitionBy(*UNIT_KEYS).json(answered)
    back = store.scan_predictions(spark, answered, by_unit=True)
    new = U.error_mean(back, UNIT_KEYS, "prediction").select(*UNIT_KEYS, U.invert_error("error_mean").alias("metricx"))
    return J.backfill_metric(metrics, new, UNIT_KEYS, "metricx").select(*UNIT_KEYS, "metricx")


#: The spellings that the stages use for one model.
_SPELT = """case doc_id % 4 when 0 then 'phi-4' when 1 then 'PHI-4' when 2 then 'Phi-4' else 'Qwen3-4B' end"""
_NAME = """case when doc_id % 4 < 3 then 'Phi-4' else 'Qwen3-4B' end"""


@query("pending_canonical", f"""
with u as (select distinct {_NAME} as model, case doc_id % 3 when 0 then 'flores-200' when 1 then 'ntrex' else 'wmt24' end as dataset,
  case lang when 'fr' then 'fra' when 'de' then 'deu' when 'es' then 'spa' else 'swh' end as tgt_lang from documents)
select m.model, lc.dataset, 'eng' as src_lang, lc.lang_code as tgt_lang
from (values ('Phi-4'), ('Qwen3-4B')) m(model), {O.lang_corpus_sql()} lc
where lc.lang_code <> 'eng' and not exists (
  select 1 from u where u.model = m.model and u.dataset = lc.dataset and u.tgt_lang = lc.lang_code)
""")
def q_pending_canonical(spark, sf_dir):
    """J3 where translations lie under another spelling of the model."""
    fixtures.register(spark, sf_dir, ["documents"])
    done = spark.sql(f"""select {_SPELT} as spelt, case doc_id % 3 when 0 then 'flores-200' when 1 then 'ntrex' else 'wmt24' end as dataset,
        'eng' as src_lang, case lang when 'fr' then 'fra' when 'de' then 'deu' when 'es' then 'spa' else 'swh' end as tgt_lang from documents""")
    done = done.withColumn("model", registry.canonical_model("spelt"))
    grid = J.translation_grid(registry.models_df(spark).where("model in ('Phi-4', 'Qwen3-4B')")).select(*UNIT_KEYS)
    return J.pending_units(grid, done, UNIT_KEYS)


@query("correlation_from_tables", f"""
with {O.e2()}, {O.PREP}, {_METRICS0},
sc as (select {_NAME} as model, case lang when 'fr' then 'fra' when 'de' then 'deu' when 'es' then 'spa' else 'swh' end as lang_code,
  avg(n_chars) / 10000 as belebele, max(n_chars) / 50000.0 as mgsm from documents group by 1, 2),
sl as (select model, lang_code, 'belebele' as benchmark, belebele as score from sc
       union all select model, lang_code, 'mgsm', mgsm from sc),
ml as (select {_NAME} as model, dataset, tgt_lang as lang_code, avg(seg_id % 97) as value
       from (select *, seg_id as doc_id from p) p group by 1, 2, 3),
r as (select model, dataset, benchmark, corr(value, score) as r from sl join ml using (model, lang_code) group by 1, 2, 3)
select model, round(median(r), 6) as median_r, count(r) as n_r from r group by model
""")
def q_correlation_from_tables(spark, sf_dir):
    """E4 from the stored tables: wide scores and metric rows, whose model names
    differ in spelling, to the median correlation (J6, G9, G10)."""
    fixtures.register(spark, sf_dir, ["documents"])
    lang = "case lang when 'fr' then 'fra' when 'de' then 'deu' when 'es' then 'spa' else 'swh' end"
    scores = spark.sql(f"""select {_NAME} as model, {lang} as lang_code, avg(n_chars) / 10000 as belebele,
        cast(max(n_chars) / 50000.0 as double) as mgsm from documents group by 1, 2""")
    path = scratch_path(spark, "scores")
    store.write_scores(scores, path, fmt="parquet")
    wide = spark.read.schema(scores.schema).parquet(path)
    long = wide.unpivot(["model", "lang_code"], ["belebele", "mgsm"], "benchmark", "score")
    spelt = _prepared(spark, sf_dir).withColumn("doc_id", F.col("seg_id")).withColumn("model", F.expr(_SPELT))
    metrics = spelt.withColumn("model", registry.canonical_model("model")).groupBy(
        "model", "dataset", F.col("tgt_lang").alias("lang_code")).agg(F.avg(F.col("seg_id") % 97).alias("value"))
    r = pearson_by_benchmark(align_scores_metrics(long, metrics, ["model", "lang_code"]), ["model", "dataset", "benchmark"])
    m = median_correlation(r, ["model"])
    return m.select("model", F.round("median_r", 6).alias("median_r"), "n_r")


@query("translate_pending", f"""
with {_PAIRS}, pr as (select * from pairs where not (dataset = 'wmt24' and seg_id = 0)),
m as (select model, family from {O.models_values()} m where model in ('Phi-4', 'Qwen3-4B')),
req as (select m.model, pr.dataset, pr.src_lang, pr.tgt_lang, pr.seg_id, pr.source, pr.target,
   {O.prompt_sql('l.name', 'pr.source')} as prompt, coalesce(s.temperature, 0.7) as temperature
  from pr cross join m join {O.languages_values()} l on l.lang_code = pr.tgt_lang
  left join {O.sampling_values()} s on s.family = m.family
  where not (m.model = 'Phi-4' and pr.dataset = 'ntrex'))
select model, dataset, src_lang, tgt_lang, seg_id, source, target,
  cast(length(prompt) as varchar) || ' ' || cast(temperature as varchar) as translation from req
""")
def q_translate_pending(spark, sf_dir):
    """E2 from the work grid to written segments; one model has one corpus done,
    under another spelling."""
    models = registry.models_df(spark).where("model in ('Phi-4', 'Qwen3-4B')")
    pairs = _pairs(spark, sf_dir)
    done = pairs.where("dataset = 'ntrex'").select(F.lit("phi-4").alias("model"), "dataset", "src_lang", "tgt_lang")
    path = scratch_path(spark, "translations")
    store.write_segments(translate_pending(models, pairs, done, standins.echo_generator), path)
    return store.read_segments(spark, path)


@query("unmapped_codes", f"""
with {O.e1()}, {O.DOC_ENTRIES}, {O.extracted()},
known as (select lang_code from {O.languages_values()} l)
select 'extract' as stage, benchmark || '/' || lang_code as unit, 'warning' as status,
       cast(count(*) as varchar) || ' scores of an unmapped language code' as detail
from ex where lang_code not in (select lang_code from known) group by benchmark, lang_code
""")
def q_unmapped_codes(spark, sf_dir):
    """K6: codes that leak through an extractor."""
    ex = X.extract_scores(_tasks(spark, sf_dir), registry.aliases_df(spark), keep=["model", "run_id"])
    return K.unmapped_codes(ex, registry.languages_df(spark))


@query("task_coverage", f"""
with {O.e1()}, {O.DOC_ENTRIES},
asked as (select m.model, t.task from (select distinct model from ent) m, (select distinct task from ent) t),
found as (select distinct model, task from ent)
select a.model, count(*) as n_requested, count(f.task) as n_found, count(*) filter (where f.task is null) as n_lacking
from asked a left join found f on f.model = a.model and f.task = a.task group by a.model
""")
def q_task_coverage(spark, sf_dir):
    """Every task that any model has is asked of every model."""
    found = _tasks(spark, sf_dir).select("model", "task").distinct()
    tasks = found.select("task").distinct()
    asked = found.select("model").distinct().join(F.broadcast(tasks), F.lit(True))  # names of tasks: rules times languages
    return K.task_coverage(asked, found, ["model"])


# ------------------------------------------------------- streams
@query("incremental_metrics", f"""
with {O.e2()}, {O.PREP},
nb as ({O.bleu_sql()}),
nc as ({O.chrf_sql()}),
nx as (select {O.UNIT}, count(*) as n_segments, round_even(avg({_RATIO.format(a='hyp', b='ref')}), 4) as xcomet from p group by {O.UNIT})
select {O.UNIT}, nx.n_segments, nb.bleu, nc.chrf, nx.xcomet from nb join nc using ({O.UNIT}) join nx using ({O.UNIT})
""")
def q_incremental_metrics(spark, sf_dir):
    """Segments arrive in parts that cut through units; a stream adds each part's statistics, and the
    metrics are those of all. Midway the statistics are compacted, and at the end the last batch is
    replayed, which changes nothing."""
    arriving, table, checkpoint = (scratch_path(spark, x) for x in ("arriving", "statistics", "stream"))
    kw = {"tokenizer": "13a", "with_rouge_meteor": False, "scorers": {"xcomet": (standins.length_ratio_scorer, 128)}}
    seg = fixtures.segments(spark, sf_dir).withColumn("half", F.xxhash64("seg_id") % 2 == 0)
    seg.repartition(4, "seg_id").write.partitionBy("half").parquet(f"{arriving}-dealt")
    for half in ("true", "false"):
        part = spark.read.schema(SEGMENTS).parquet(f"{arriving}-dealt/half={half}")
        part.write.mode("append").parquet(arriving)
        I.incremental_statistics(spark, arriving, table, checkpoint, max_files=2, **kw).awaitTermination()
        if half == "true":
            I.compact_statistics(spark, table)
    epochs = versions.current(spark, table)["epochs"]
    (stream, last), = epochs.items()
    I.add_statistics(I.read_statistics(spark, table), table, stream, last)  # a replay
    return I.metrics_so_far(spark, table, with_count=True).select(*UNIT_KEYS, "n_segments", "bleu", "chrf", "xcomet")


@query("incremental_scores", f"""
with {O.e1()}, {O.DOC_ENTRIES},
kept as (select * from docs where run_id <> 2),
lastp as (select model, max(struct_pack(m := mtime, p := '/results/raw/' || model || '/org__' || model || '/results_' || cast(run_id as varchar) || '.json', r := run_id)) as b
          from kept group by model),
ent_latest as (select e.* from ent e join lastp l on l.model = e.model and l.b.r = e.run_id),
{O.extracted(src='ent_latest')}
{O.merge_scores_sql()}
""")
def q_incremental_scores(spark, sf_dir):
    """Result documents arrive in parts; of each model the newest so far has its scores in the
    ledger, and in the plain table that is made from it."""
    arriving, ledger, plain, checkpoint = (scratch_path(spark, x) for x in ("documents", "ledger", "plain", "stream"))
    docs = _docs(spark, sf_dir).select("value", "path", F.col("mtime").cast("timestamp").alias("mtime"))
    docs.repartition(4, "path").write.parquet(arriving)
    stream = spark.readStream.schema("value string, path string, mtime timestamp").option("maxFilesPerTrigger", 2).parquet(arriving)
    I.incremental_scores(spark, stream, plain, ledger, checkpoint, fixtures.fixture_models(spark, sf_dir)).awaitTermination()
    scores = I.committed_scores(spark, ledger)
    return scores.select("model", *[c for c in scores.columns if c != "model"])


# ------------------------------------------------------- order
@query("ordered_scores", f"""
with {O.e1()}, {O.DOC_ENTRIES}, {O.LATEST},
ent_latest as (select e.* from ent e join latest l on l.model = e.model and l.run_id = e.run_id),
{O.extracted(src='ent_latest')},
w as ({O.merge_scores_sql()})
select model, lang_code, row_number() over (order by model, lang_code) as position, cast(0 as bigint) as n_faults from w
""")
def q_ordered_scores(spark, sf_dir):
    """O1: the score table in one total order, proved by where each row lies in its files."""
    path = scratch_path(spark, "ordered-scores")
    ordered.write_ordered(q_merge_scores(spark, sf_dir), path, ["model", "lang_code"], max_records_per_file=1000)
    faults = ordered.order_faults(spark, path, ["model", "lang_code"]).count()
    return ordered.positions(spark, path).select("model", "lang_code", "position", F.lit(faults).cast("long").alias("n_faults"))


@query("ordered_pairs", f"""
with {O.e2()}, {O.PREP}, {_METRICS0}
select {O.UNIT}, row_number() over (order by model, dataset, src_lang, tgt_lang) as position, cast(0 as bigint) as n_faults from m0
""")
def q_ordered_pairs(spark, sf_dir):
    """O2: metric rows in the order of their pairs, proved likewise."""
    path = scratch_path(spark, "ordered-pairs")
    ordered.write_ordered(_stored_metrics(spark, sf_dir), path, UNIT_KEYS, max_records_per_file=50)
    faults = ordered.order_faults(spark, path, UNIT_KEYS).count()
    return ordered.positions(spark, path).select(*UNIT_KEYS, "position", F.lit(faults).cast("long").alias("n_faults"))


# ------------------------------------------------------- a scorer process, outcomes
@query("scorer_process", f"""
with {O.e2()}, {O.PREP}
select {O.UNIT}, round_even(25 - avg({_ERR}), 4) as metricx from p group by {O.UNIT}
""")
def q_scorer_process(spark, sf_dir):
    """U1 with a scorer that is a program: a child process of each worker, asked over pipes (its part is
    played by a few lines of Python). G7 and P11 follow."""
    factory = external_scorer([sys.executable, "-c", standins.SCORER_PROGRAM], timeout=120)
    scored = U.score_segments(_prepared(spark, sf_dir).select(*UNIT_KEYS, "src", "hyp", "ref"), factory, "prediction", batch_size=64, keep=UNIT_KEYS)
    return U.error_mean(scored, UNIT_KEYS, "prediction").select(*UNIT_KEYS, U.invert_error("error_mean").alias("metricx"))


@query("observed_outcomes", f"""
with {O.e1()}, {O.DOC_ENTRIES},
st as (select case when run_id % 5 = 3 then 'error' when run_id % 5 = 4 then 'skipped' else 'ok' end as status from docs)
select 'scan_results' as stage, status, count(*) as n from st group by status
""")
def q_observed_outcomes(spark, sf_dir):
    """K6 by observation: the documents' outcomes are counted while they are parsed and written; some are cut
    short (corrupt) and some lack ``results``."""
    docs = _docs(spark, sf_dir)
    kind = F.col("run_id") % 5
    broken = F.when(kind == 3, F.expr("left(value, length(value) - 2)")).when(kind == 4, F.lit('{"config": {}}')).otherwise(F.col("value"))
    docs = docs.withColumn("value", broken)
    status = results.document_status("value")
    watched, seen = K.observe_outcomes(docs.withColumn("_status", status), F.col("_status"), "scan_results")
    results.parse_documents(watched, "value", ["model", "run_id"]).write.parquet(scratch_path(spark, "task-rows"))
    return K.outcome_counts(spark, seen, "scan_results")
