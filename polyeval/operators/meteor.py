"""METEOR per segment (exact + Porter stem stages, optional synonym
table), averaged per unit. Alignment is an Arrow UDF per segment; the mean
is native."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.align import meteor_segment
from ..functions.text import round_half_even
from ..session import bounded_batches


def meteor_udf(alpha: float = 0.9, beta: float = 3.0, gamma: float = 0.5, synonyms=None):
    """``synonyms``: optional {word: frozenset(synonyms)}; it is shipped to the
    workers with the function, so it must be a bounded table."""
    @F.pandas_udf(T.DoubleType())
    def _m(hyp: pd.Series, ref: pd.Series) -> pd.Series:
        return pd.Series([meteor_segment(h or "", r or "", alpha, beta, gamma, synonyms)
                          for h, r in zip(hyp, ref)], dtype="float64")
    return _m


def segment_meteor(seg: DataFrame, keys: list[str], hyp: str = "hyp", ref: str = "ref", **kw) -> DataFrame:
    bounded_batches(seg.sparkSession)
    return seg.select(*keys, "seg_id", meteor_udf(**kw)(F.col(hyp), F.col(ref)).alias("meteor"))


def meteor(seg: DataFrame, keys: list[str], hyp: str = "hyp", ref: str = "ref",
           digits: int | None = 4, **kw) -> DataFrame:
    s = segment_meteor(seg, keys, hyp, ref, **kw)
    m = F.avg("meteor")
    return s.groupBy(*keys).agg((round_half_even(m, digits) if digits is not None else m).alias("meteor"))
