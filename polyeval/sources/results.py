"""Benchmark-result documents.

Layout on storage: ``<base>/<model>/<hub path with '/' as '__'>/results_*.json``,
one JSON document per file. Everything is read in one scan for all models;
the newest run per model is chosen with an aggregate, not a per-model loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

_PATH_RE = r"([^/]+)/([^/]+)/(results_[^/]*\.json)$"


def scan_results(spark: SparkSession, path_glob: str) -> DataFrame:
    """Read whole files as documents -> one row per (file, task).

    Columns: path, mtime, pos (key order inside ``results``), task,
    metrics (map<string,string>). A file without ``results`` or with corrupt
    JSON yields no task rows (see ``documents_status`` for the reason).
    """
    raw = (spark.read.text(path_glob, wholetext=True)
           .select(F.col("value"),
                   F.col("_metadata.file_path").alias("path"),
                   F.col("_metadata.file_modification_time").alias("mtime")))
    return parse_documents(raw, "value", ["path", "mtime"])


def parse_documents(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Parse JSON documents in ``text_col`` into long task rows."""
    doc = F.from_json(F.col(text_col), schemas.RESULT_DOC)
    results = F.coalesce(doc["results"],
                         F.create_map().cast("map<string,map<string,string>>"))
    return (df.select(*keep, F.posexplode(F.map_entries(results)).alias("pos", "e"))
              .select(*keep, "pos",
                      F.col("e.key").alias("task"),
                      F.col("e.value").alias("metrics")))


def _parsed_status(text_col: str) -> tuple[Column, Column, Column]:
    from pyspark.sql import types as T
    schema = T.StructType(schemas.RESULT_DOC.fields + [T.StructField("_corrupt", T.StringType())])
    doc = F.from_json(F.col(text_col), schema, {"columnNameOfCorruptRecord": "_corrupt"})
    bad = doc.isNull() | doc["_corrupt"].isNotNull()
    status = (F.when(bad, F.lit("error"))
               .when(doc["results"].isNull(), F.lit("skipped"))
               .otherwise(F.lit("ok")))
    return status, bad, doc


def document_status(text_col: str) -> Column:
    """K6 for S1: a document's outcome (ok, skipped: no results, error: corrupt)."""
    return _parsed_status(text_col)[0]


def documents_status(df: DataFrame, text_col: str, unit_col: str) -> DataFrame:
    """K6 for S1: one status row per document (ok / no results / corrupt)."""
    status, bad, doc = _parsed_status(text_col)
    detail = (F.when(bad, F.lit("corrupt JSON"))
               .when(doc["results"].isNull(), F.lit("no results key"))
               .otherwise(F.concat(F.size(doc["results"]).cast("string"), F.lit(" tasks"))))
    return df.select(F.lit("scan_results").alias("stage"), F.col(unit_col).cast("string").alias("unit"),
                     status.alias("status"), detail.alias("detail"))


def result_path_match(df: DataFrame, models: DataFrame, path_col: str = "path") -> DataFrame:
    """Keep rows whose file sits under a registered model's folder.

    The model folder must equal the registry key and the next folder the hub
    path with '/' replaced by '__'. Model keys are matched without regard to
    case (one registry spelling differs only in case between stages).
    The registry side is left to the planner: AQE broadcasts it once its
    measured size is small, which the fixed registry always is.
    """
    p = F.col(path_col)
    m = models.select(F.col("model").alias("reg_model"),
                      F.lower("model").alias("_mkey"),
                      F.replace(F.col("hub_path"), F.lit("/"), F.lit("__")).alias("_hkey"))
    parsed = df.withColumns({
        "_mkey": F.lower(F.regexp_extract(p, _PATH_RE, 1)),
        "_hkey": F.regexp_extract(p, _PATH_RE, 2),
    })
    return (parsed.join(m, ["_mkey", "_hkey"], "inner")
                  .drop("_mkey", "_hkey"))


def latest_run(df: DataFrame, model_col: str, run_col: str, time_col: str) -> DataFrame:
    """S3: per model, the run with the newest time (ties: greatest run key).

    One row per model: (model, run, time). Partial aggregation happens
    map-side, so a model holding most of the rows costs no hot task.
    """
    best = F.max_by(F.struct(F.col(time_col).alias("t"), F.col(run_col).alias("r")),
                    F.struct(F.col(time_col), F.col(run_col)))
    return (df.groupBy(model_col).agg(best.alias("_b"))
              .select(model_col, F.col("_b.r").alias(run_col), F.col("_b.t").alias(time_col)))


def newest_document(docs: DataFrame, model_col: str, run_col: str, time_col: str) -> DataFrame:
    """S3 on a document table (one row per result file): the newest document
    per model, whole, in one aggregate. ``max_by`` keeps one candidate per
    model per task before the shuffle (partial aggregation), so only
    tasks x models documents move, whatever the skew; no second pass over
    the documents and no join back."""
    others = [c for c in docs.columns if c != model_col]
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(F.col(time_col), F.col(run_col)))
    return docs.groupBy(model_col).agg(best.alias("_d")).select(model_col, *[F.col(f"_d.{c}").alias(c) for c in others])


def file_list(spark: SparkSession, path_glob: str) -> DataFrame:
    """path, mtime, length, file of files; none is opened (their content isn't among the columns
    read). ``path`` is the URI that other scans report, ``file`` the name to read it by."""
    return spark.read.format("binaryFile").load(path_glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("mtime"), "length", F.col("path").alias("file"))


def newest_files(spark: SparkSession, path_glob: str, models: DataFrame) -> DataFrame:
    """S2 and S3 on paths and times: model, path, file, mtime of each registered model's newest
    file (ties: the greatest path)."""
    matched = result_path_match(file_list(spark, path_glob), models).drop("model").withColumnRenamed("reg_model", "model")
    best = latest_run(matched.withColumn("run", F.struct("path", "file")), "model", "run", "mtime")
    return best.select("model", "run.path", "run.file", "mtime")


def read_chosen(spark: SparkSession, chosen: DataFrame) -> DataFrame:
    """model, path, value of the chosen files, at most one a model: their names, bounded by
    the registry, go to the driver, which names just these files to the scan. The model is
    found again by the path, a literal map's lookup in the scan's own projection."""
    rows = list(chosen.select("path", "file", "model").toLocalIterator())
    if not rows:
        return spark.createDataFrame([], "model string, path string, value string")
    model = F.create_map(*[F.lit(x) for r in rows for x in (r.path, r.model)])
    docs = spark.read.text([r.file for r in rows], wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return docs.select(model[F.col("path")].alias("model"), "path", "value")


def metric_value(metrics: Column, key: str) -> Column:
    """Metric lookup with numeric coercion: non-numeric text -> NULL."""
    return F.btrim(metrics[key], F.lit('"')).try_cast("double")
