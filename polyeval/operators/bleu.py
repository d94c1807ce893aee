"""Corpus BLEU per unit (4-gram, exponential smoothing, one reference).

Statistics come from ``ngram.unit_stats``; the score is column arithmetic
on one row per unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import round_half_even
from ..functions.tokenize import py_bleu_tokenizer
from . import ngram

_LOG_ZERO = -9999999999.0


def bleu_from_stats(match: list[Column], total: list[Column], sys_len: Column, ref_len: Column) -> Column:
    """BLEU = BP * exp(mean log p_n). p_n = 100*match/total; an order with no
    match gets 100/(2^k * total), k counting such orders so far; an order with
    total 0 contributes log 0 (score ~ 0); no match at any order -> 0."""
    bp = (F.when(sys_len < ref_len,
                 F.when(sys_len > 0, F.exp(F.lit(1.0) - ref_len / sys_len)).otherwise(F.lit(0.0)))
           .otherwise(F.lit(1.0)))
    logs = []
    k = F.lit(0)
    for c, t in zip(match, total):
        k = k + F.when((c == 0) & (t > 0), 1).otherwise(0)
        p = (F.when(t == 0, F.lit(0.0))
              .when(c == 0, F.lit(100.0) / (F.pow(F.lit(2.0), k) * t))
              .otherwise(F.lit(100.0) * c / t))
        logs.append(F.when(p == 0, F.lit(_LOG_ZERO)).otherwise(F.log(p)))
    mean_log = sum(logs[1:], logs[0]) / F.lit(float(len(logs)))
    any_match = sum(match[1:], match[0]) > 0
    return F.when(any_match, bp * F.exp(mean_log)).otherwise(F.lit(0.0))


def corpus_bleu(seg: DataFrame, keys: list[str], hyp: str = "hyp", ref: str = "ref",
                tokenizer: str = "13a", spm_model: str | None = None, max_order: int = 4,
                digits: int | None = 2) -> DataFrame:
    """(keys, seg_id, hyp, ref) -> (keys, bleu, sys_len, ref_len).
    Texts are right-stripped and tokenized inside the statistics task."""
    orders = list(range(1, max_order + 1))
    specs = [(n, "tok", n) for n in orders]
    w = ngram.unit_stats(seg, keys, specs, hyp, ref, {"tok": py_bleu_tokenizer(tokenizer, spm_model)},
                         clip_hyp_when_no_ref=False)
    score = bleu_from_stats([F.col(f"match_{n}") for n in orders], [F.col(f"hyp_{n}") for n in orders],
                            F.col("hyp_1"), F.col("ref_1"))
    score = round_half_even(score, digits) if digits is not None else score
    return w.select(*keys, score.alias("bleu"), F.col("hyp_1").alias("sys_len"), F.col("ref_1").alias("ref_len"))
