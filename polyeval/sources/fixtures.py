"""Tables of the pipeline's shapes derived from the driver's test tables.

Each view is one SQL text that runs unchanged on Spark SQL and DuckDB, so a
query's oracle can start from the same input. All views read whole tables and
whole texts; derived keys (model, dataset, target language) are computed from
ids, nothing is filtered out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def register(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    for n in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet").createOrReplaceTempView(n)


# E1 raw_scores: benchmark results in long form. model = one per user,
# run_id = run number, pos = order in the document, ts = time stand-in. A JSON
# object has unique keys, so a task's later events in one of the three series of
# runs go to later runs of that series: every event is one entry.
# For hellaswag, score is acc_norm and score2 is acc.
E1_SQL = """
select model, cast(series + 3 * (rn - 1) as bigint) as run_id, task, event_id as pos, ts, score, score2 from (
 select t.*, row_number() over (partition by model, series, task order by event_id) as rn from (
 select concat('m', cast(user_id as string)) as model, k % 3 as series, event_id, ts,
  case when event_id % 7 = 0 then null when event_id % 5 = 0 then 0.0 else value / 1000 end as score, value / 2000 as score2,
  case event_id % 9
   when 0 then concat('afrimmlu_direct_', substr('swaormhauengyor', 1+3*cast(k % 5 as int), 3), '_prompt_1')
   when 1 then concat('afrixnli_', substr('swaormhauengyor', 1+3*cast(k % 5 as int), 3), '_prompt_2')
   when 2 then concat('belebele_', substr('zhobenhineng', 1+3*cast(k % 4 as int), 3), case when k % 3 = 0 then '_Hant' else '_Latn' end)
   when 3 then concat('global_mmlu_', substr('arbnsweszzen', 1+2*cast(k % 6 as int), 2))
   when 4 then concat('hellaswag_', substr('arbnjaeszzen', 1+2*cast(k % 6 as int), 2))
   when 5 then concat('truthfulqa_', substr('arbnjaeszzen', 1+2*cast(k % 6 as int), 2), '_mc2')
   when 6 then concat('mgsm_direct_', substr('jaswtheszzen', 1+2*cast(k % 6 as int), 2))
   when 7 then concat('mlqa_en_', substr('ardeeshivien', 1+2*cast(k % 6 as int), 2))
   else concat('include_base_44_', case k % 4 when 0 then 'arabic' when 1 then 'north macedonian' when 2 then 'klingon' else 'hebrew' end) end as task
 from (select *, cast(floor(event_id / 9.0) as bigint) as k from events) e) t) u
"""

# E2 segments: translation segments over whole documents. Reference = a
# document, hypothesis = the document 20 ids later, the last ids going on with
# the first (with reasoning traces on some rows), source = a benchmark item chosen by id. The hint (a comment to
# DuckDB) keeps the self-join of the growing document text a sort-merge
# join: the planner sizes a Parquet side by its compressed bytes and would
# broadcast tens of MB of text at sf0.1.
E2_SQL = """
select /*+ MERGE(b) */ a.source as model,
 case a.doc_id % 3 when 0 then 'flores-200' when 1 then 'ntrex' else 'wmt24' end as dataset,
 'eng' as src_lang,
 case a.lang when 'fr' then 'fra' when 'de' then 'deu' when 'es' then 'spa' else 'swh' end as tgt_lang,
 a.doc_id as seg_id, i.text as source, a.text as target,
 case when a.doc_id % 4 = 0 then concat('<think>x</think> y</think>  ', b.text)
      when a.doc_id % 4 = 1 then concat('<think> ', b.text)
      else b.text end as translation
from (select *, doc_id % (select count(*) from benchmark) as item_key,
        (doc_id + 20) % (select max(doc_id) + 1 from documents) as hyp_key from documents) a
join documents b on b.doc_id = a.hyp_key
join benchmark i on i.item_id = a.item_key
"""

# E3 score_metric: per (model, language) two benchmark scores and two
# translation metrics, aggregated from all of lineitem.
E3_SQL = """
select concat('m', cast(l_suppkey % 14 as string)) as model, l_partkey % 56 as lang_id,
 avg(l_discount) as score_a, avg(l_tax) as score_b,
 avg(l_quantity) as metric_x, avg(l_extendedprice) as metric_y
from lineitem group by concat('m', cast(l_suppkey % 14 as string)), l_partkey % 56
"""


# E4 corpus: a wide parallel corpus (one text column per corpus code) built
# from documents: 12 consecutive ids share four row positions, and the documents
# of one language among them fill that language's column one after the other, so
# each text has a cell of its own; rows of every fifth twelve belong to another
# split.
E4_SQL = """
select dataset, split, seg_id,
  min_by(text, doc_id) filter (where corpus_code = 'eng_Latn') as eng_Latn,
  min_by(text, doc_id) filter (where corpus_code = 'fra_Latn') as fra_Latn,
  min_by(text, doc_id) filter (where corpus_code = 'deu_Latn') as deu_Latn,
  min_by(text, doc_id) filter (where corpus_code = 'spa_Latn') as spa_Latn,
  min_by(text, doc_id) filter (where corpus_code = 'fr_FR') as fr_FR,
  min_by(text, doc_id) filter (where corpus_code = 'de_DE') as de_DE,
  min_by(text, doc_id) filter (where corpus_code = 'es_MX') as es_MX
from (
 select dataset, split, doc_id, text, corpus_code,
   cast(twelve * 4 + row_number() over (partition by dataset, corpus_code, twelve order by doc_id) - 1 as bigint) as seg_id
 from (
  select case doc_id % 3 when 0 then 'flores-200' when 1 then 'ntrex' else 'wmt24' end as dataset,
   cast(floor(doc_id / 12.0) as bigint) as twelve, doc_id, text,
   case when cast(floor(doc_id / 12.0) as bigint) % 5 = 4 then 'dev'
        else case doc_id % 3 when 0 then 'devtest' when 1 then 'test' else 'train' end end as split,
   case when lang = 'en' then 'eng_Latn'
        when doc_id % 3 = 2 then case lang when 'fr' then 'fr_FR' when 'de' then 'de_DE' else 'es_MX' end
        else case lang when 'fr' then 'fra_Latn' when 'de' then 'deu_Latn' else 'spa_Latn' end end as corpus_code
  from documents) e) d
group by dataset, split, seg_id
"""


def raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ["events"])
    return spark.sql(E1_SQL)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ["documents", "benchmark"])
    return spark.sql(E2_SQL)


def score_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ["lineitem"])
    return spark.sql(E3_SQL)


def corpus_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, ["documents"])
    return spark.sql(E4_SQL)


def _metrics_map(task: Column, score: Column, score2: Column) -> Column:
    return (F.when(task.startswith("hellaswag_"),
                   F.create_map(F.lit("acc_norm,none"), score, F.lit("acc,none"), score2))
             .when(task.startswith("mgsm_"), F.create_map(F.lit("exact_match,flexible-extract"), score))
             .when(task.startswith("mlqa_"), F.create_map(F.lit("f1,none"), score))
             .otherwise(F.create_map(F.lit("acc,none"), score)))


def hub_path(model: Column) -> Column:
    """Fixture hub path of a model: org/<model>."""
    return F.concat(F.lit("org/"), model)


def result_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 as result documents: one JSON text per (model, run_id), tasks in
    ``pos`` order, mtime = newest event of the run, path in the on-disk
    layout. Documents of run 2 sit under a folder no registry entry names."""
    e1 = raw_scores(spark, sf_dir)
    entry = F.struct("pos", "task", _metrics_map(F.col("task"), F.col("score"), F.col("score2")).alias("metrics"))
    docs = (e1.groupBy("model", "run_id")
              .agg(F.max("ts").alias("mtime"),
                   F.array_sort(F.collect_list(entry),
                                lambda a, b: F.when(a["pos"] < b["pos"], -1)
                                              .when(a["pos"] > b["pos"], 1).otherwise(0)).alias("entries")))
    results = F.map_from_entries(F.transform("entries", lambda e: F.struct(e["task"], e["metrics"])))
    folder = F.when(F.col("run_id") == 2, F.concat(F.lit("other__"), F.col("model"))) \
              .otherwise(F.replace(hub_path(F.col("model")), F.lit("/"), F.lit("__")))
    path = F.concat(F.lit("/results/raw/"), F.col("model"), F.lit("/"), folder,
                    F.lit("/results_"), F.col("run_id").cast("string"), F.lit(".json"))
    return docs.select("model", "run_id", "mtime", path.alias("path"),
                       F.to_json(F.struct(results.alias("results"))).alias("value"))


def fixture_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of the E1 models (one per user in ``events``)."""
    register(spark, sf_dir, ["events"])
    m = spark.table("events").select(F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("model")).distinct()
    return m.select("model", hub_path(F.col("model")).alias("hub_path"))
