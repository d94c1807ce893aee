"""G1: merge long score rows into the wide score table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import registry


def merge_scores(long: DataFrame, group: list[str], order: list[str] | None = None,
                 benchmarks: list[str] | None = None) -> DataFrame:
    """Per (group..., lang_code), for each benchmark the first non-null score
    in extraction order (``order`` columns, default ``pos``); NaN counts as
    null. A language whose scores are all null/NaN still gets its row.

    One hash aggregate with nine filtered ``min_by`` -- no pivot pass, and no
    dependence on row order after the shuffle (unlike ``first``).
    """
    order = order or ["pos"]
    benchmarks = benchmarks or registry.BENCHMARKS
    s = F.when(~F.isnan("score"), F.col("score"))
    key = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    aggs = [F.min_by(s, F.when((F.col("benchmark") == b) & s.isNotNull(), key)).alias(b)
            for b in benchmarks]
    return long.groupBy(*group, "lang_code").agg(*aggs)
