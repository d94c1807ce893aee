"""Corpus chrF per unit (character 6-grams, beta 2; ``word_order=2`` gives
chrF++). Statistics are summed over the corpus per order; precision and
recall are averaged over orders where both sides have n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import round_half_even
from ..functions.tokenize import py_chrf_chars, py_chrf_words
from . import ngram


def chrf_from_stats(hyp: list[Column], ref: list[Column], match: list[Column], beta: float = 2.0) -> Column:
    factor = beta ** 2
    eff = F.lit(0)
    sum_p = F.lit(0.0)
    sum_r = F.lit(0.0)
    for h, r, m in zip(hyp, ref, match):
        both = (h > 0) & (r > 0)
        eff = eff + F.when(both, 1).otherwise(0)
        sum_p = sum_p + F.when(both, m / h).otherwise(F.lit(0.0))
        sum_r = sum_r + F.when(both, m / r).otherwise(F.lit(0.0))
    p = F.when(eff > 0, sum_p / eff).otherwise(F.lit(0.0))
    r = F.when(eff > 0, sum_r / eff).otherwise(F.lit(0.0))
    return (F.when((p + r) > 0, F.lit(100.0) * (1 + factor) * p * r / (F.lit(factor) * p + r))
             .otherwise(F.lit(0.0)))


def corpus_chrf(seg: DataFrame, keys: list[str], hyp: str = "hyp", ref: str = "ref",
                char_order: int = 6, word_order: int = 0, beta: float = 2.0,
                digits: int | None = 2, out_col: str = "chrf") -> DataFrame:
    """(keys, seg_id, hyp, ref) -> (keys, chrf). Characters: the text without
    whitespace; words (chrF++): whitespace split, one punctuation mark split
    off a word's end (else its start)."""
    specs = [(n, "char", n) for n in range(1, char_order + 1)] + \
            [(char_order + n, "word", n) for n in range(1, word_order + 1)]
    labels = [o for (o, _, _) in specs]
    w = ngram.unit_stats(seg, keys, specs, hyp, ref, {"char": py_chrf_chars, "word": py_chrf_words},
                         clip_hyp_when_no_ref=True)
    score = chrf_from_stats([F.col(f"hyp_{o}") for o in labels], [F.col(f"ref_{o}") for o in labels],
                            [F.col(f"match_{o}") for o in labels], beta)
    score = round_half_even(score, digits) if digits is not None else score
    return w.select(*keys, score.alias(out_col))
