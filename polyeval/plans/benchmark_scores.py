"""Benchmark-result documents -> wide score table, one job for all models.

documents --S2 registry match--> --S3 newest run per model--> --S1 parse-->
task rows --X1-X9/P1-P3 single pass--> long scores --G1--> scores_wide
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import registry
from ..operators.extract import extract_scores
from ..operators.scores import merge_scores
from ..sources import results


def documents_to_scores_long(docs: DataFrame, aliases: DataFrame, model_col: str = "model",
                             run_col: str = "path", time_col: str = "mtime",
                             text_col: str = "value") -> DataFrame:
    """Newest document per model -> long score rows (model, run, pos, task,
    benchmark, lang_code, score). The newest run is picked on the document
    table (one row per file), before any parsing."""
    latest = results.newest_document(docs.select(model_col, run_col, time_col, text_col),
                                     model_col, run_col, time_col)
    tasks = results.parse_documents(latest, text_col, [model_col, run_col])
    return extract_scores(tasks, aliases, keep=[model_col, run_col])


def score_table(docs: DataFrame, aliases: DataFrame, model_col: str = "model", **kw) -> DataFrame:
    long = documents_to_scores_long(docs, aliases, model_col=model_col, **kw)
    return merge_scores(long, [model_col])


def score_table_from_files(spark: SparkSession, base_dir: str) -> DataFrame:
    """E1 over files ``<base>/<model>/<hub__path>/results_*.json``. Which files are
    read follows from their paths and times alone (``results.newest_files``): no document
    passes a join or an aggregate, and older runs aren't opened."""
    models = registry.models_df(spark).filter("in_benchmark")
    newest = results.newest_files(spark, f"{base_dir.rstrip('/')}/*/*/results_*.json", models)
    tasks = results.parse_documents(results.read_chosen(spark, newest), "value", ["model", "path"])
    return merge_scores(extract_scores(tasks, registry.aliases_df(spark), keep=["model", "path"]), ["model"])
