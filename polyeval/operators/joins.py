"""Work grid, pending units, metric back-fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import registry
from ..functions.text import is_missing_numeric, numeric_or_null
from .neural import error_mean, invert_error, score_segments


def lang_corpus_rows(include_source: bool = False) -> list[tuple[str, str, str, str]]:
    """(lang_code, name, dataset, corpus_code) for every language with a code
    in a dataset: the 257 translation units per model (fixed, from the
    language table)."""
    idx = {"flores_code": 2, "wmt_code": 3, "ntrex_code": 4}
    out = []
    for r in registry._rows(registry.LANGUAGES_CSV):
        if r[0] == registry.SOURCE_LANG and not include_source:
            continue
        for ds, _split, _drop, col in registry.DATASETS:
            code = r[idx[col]]
            if code:
                out.append((r[0], r[1], ds, code))
    return out


def lang_corpus_df(spark: SparkSession, include_source: bool = True) -> DataFrame:
    return spark.createDataFrame(lang_corpus_rows(include_source),
                                 "lang_code string, name string, dataset string, corpus_code string")


def translation_grid(models: DataFrame, model_col: str = "model") -> DataFrame:
    """Every model x (target language, dataset) that has a corpus code.
    The unit list is a fixed literal (257 entries), so each model row emits
    its units through a generator -- no join."""
    units = F.array(*[F.struct(F.lit(lc).alias("tgt_lang"), F.lit(ds).alias("dataset"),
                               F.lit(code).alias("corpus_code"))
                      for lc, _name, ds, code in lang_corpus_rows()])
    return (models.select(model_col, F.explode(units).alias("u"))
                  .select(model_col, "u.dataset", F.lit(registry.SOURCE_LANG).alias("src_lang"),
                          "u.tgt_lang", "u.corpus_code"))


def pending_units(grid: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Units of ``grid`` not yet in ``done`` (re-running is a no-op once
    the results are written)."""
    return grid.join(done.select(*keys).distinct(), keys, "left_anti")


def missing_metric(metrics: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is empty, non-numeric, NaN or absent."""
    if col not in metrics.columns:
        metrics = metrics.withColumn(col, F.lit(None).cast("double"))
    return metrics.filter(is_missing_numeric(col))


def backfill_metric(metrics: DataFrame, new_values: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Take ``new_values.col`` only where ``metrics.col`` is missing;
    present values never change; units without a new value stay as they are."""
    if col not in metrics.columns:
        metrics = metrics.withColumn(col, F.lit(None).cast("double"))
    new = new_values.select(*keys, F.col(col).alias("_new"))
    out = metrics.join(new, keys, "left")
    return out.withColumn(col, F.coalesce(numeric_or_null(col), F.col("_new"))).drop("_new")


def semi_join_units(big: DataFrame, units: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``big`` whose unit is (``left_semi``) / is not (``left_anti``)
    in ``units``: a join with the distinct unit keys, one row per unit. Adaptive
    execution broadcasts them when their measured bytes are under Spark's
    threshold, and splits skewed units otherwise."""
    return big.join(units.select(*keys).distinct(), keys, how)


def backfill_error_metric(metrics: DataFrame, prepared: DataFrame, keys: list[str],
                          factory: Callable, col: str = "metricx", batch_size: int = 1,
                          offset: float = registry.METRICX_OFFSET) -> DataFrame:
    """J4 + U1 + G7 + P11: score only the segments of units whose ``col`` is
    missing (semi join on the missing units, before any text is cleaned or
    moved), mean error per unit, invert to ``offset - mean``, fill in."""
    missing = missing_metric(metrics, col).select(*keys)
    seg = semi_join_units(prepared, missing, keys)
    scored = score_segments(seg.select(*keys, "seg_id", "src", "hyp", "ref"), factory, "_err", batch_size, keep=keys)
    new = error_mean(scored, keys, "_err").select(*keys, invert_error("error_mean", offset).alias(col))
    return backfill_metric(metrics, new, keys, col)
