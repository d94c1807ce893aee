"""ROUGE-L F-measure per segment, averaged per unit.

Tokenization (lowercase, every run outside [a-z0-9] separates) and the LCS
(bit-parallel) run per segment in an Arrow UDF; the mean is a native
aggregate. ``rouge_l`` is the plain mean; ``rouge_l_interval`` reports what the
reference's scorer does, the middle of a bootstrap over segments, with its interval
(see ``bootstrap``; resamples are seeded, so it gives the same numbers each time)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.align import rouge_l_f
from ..functions.text import round_half_even
from ..session import bounded_batches
from .bootstrap import SAMPLES, bootstrap_mean


_ALNUM_RUN = re.compile(r"[a-z0-9]+")


def py_rouge_tokens(text: str) -> list[str]:
    """Lowercase; every run outside [a-z0-9] separates tokens (i.e. the tokens
    are the maximal [a-z0-9] runs)."""
    return _ALNUM_RUN.findall(text.lower())


def rouge_tokens(c) -> "F.Column":
    """The same tokenization as a column expression (array of tokens)."""
    col = F.col(c) if isinstance(c, str) else c
    s = F.trim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " "))


@F.pandas_udf(T.DoubleType())
def rouge_l_udf(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    return pd.Series([rouge_l_f(py_rouge_tokens(h or ""), py_rouge_tokens(r or ""))
                      for h, r in zip(hyp, ref)], dtype="float64")


def segment_rouge_l(seg: DataFrame, keys: list[str], hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    bounded_batches(seg.sparkSession)
    return seg.select(*keys, "seg_id", rouge_l_udf(F.col(hyp), F.col(ref)).alias("rouge_l"))


def rouge_l(seg: DataFrame, keys: list[str], hyp: str = "hyp", ref: str = "ref",
            digits: int | None = 4) -> DataFrame:
    s = segment_rouge_l(seg, keys, hyp, ref)
    m = F.avg("rouge_l")
    return s.groupBy(*keys).agg((round_half_even(m, digits) if digits is not None else m).alias("rouge_l"))


def rouge_l_interval(seg: DataFrame, keys: list[str], hyp: str = "hyp", ref: str = "ref", samples: int = SAMPLES,
                     confidence: float = 0.95, digits: int | None = 4) -> DataFrame:
    """keys, rouge_l (the bootstrap's middle), rouge_l_low, rouge_l_high."""
    return bootstrap_mean(segment_rouge_l(seg, keys, hyp, ref), keys, "rouge_l", ["seg_id"], "rouge_l", samples, confidence, digits)
