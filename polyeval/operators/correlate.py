"""Translation quality vs. benchmark scores across languages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_scores_metrics(scores_long: DataFrame, metrics_long: DataFrame,
                         on: list[str]) -> DataFrame:
    """(model, language, benchmark, score) x (model, language, metric,
    value) on the shared keys. Both sides have one row per (model, language,
    name), so the output is bounded by their product per key (9 x 7)."""
    return scores_long.join(metrics_long, on, "inner")


def pearson_by_benchmark(aligned: DataFrame, group: list[str], x: str = "value", y: str = "score",
                         min_langs: int = 0) -> DataFrame:
    """Pearson r over languages per group, with the language count; a
    group of one language (or constant values) gives NULL."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    out = aligned.groupBy(*group).agg(F.corr(F.when(both, F.col(x)), F.when(both, F.col(y))).alias("r"),
                                      F.count_if(both).alias("n_langs"))
    return out.filter(F.col("n_langs") >= min_langs) if min_langs else out


def median_correlation(r: DataFrame, group: list[str]) -> DataFrame:
    """Exact median of r per group (NULL r ignored)."""
    return r.groupBy(*group).agg(F.median("r").alias("median_r"), F.count("r").alias("n_r"))
