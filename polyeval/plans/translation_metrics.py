"""Translation segments -> one metric row per unit.

segments --P5 stringify--P4 clean--> {BLEU, chrF native stats; ROUGE-L, METEOR
per-segment Arrow UDFs; learned scorers through the U1 plug-in} --G8 one
row per (model, dataset, src_lang, tgt_lang).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_translation, round_half_even, stringify_missing
from ..schemas import UNIT_KEYS
from ..session import bounded_batches


def spread(df: DataFrame) -> DataFrame:
    """Deal segments out evenly by (unit, seg_id), for input that comes in a few
    large pieces (one multi-line CSV file per unit, or a stream's few files a batch). The number
    of partitions is given: a segment's metrics take long for its bytes, by which adaptive
    execution would join partitions. Tables of many Parquet files are split by the scan and need
    no shuffle."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *UNIT_KEYS, "seg_id")


def prepare_segments(seg: DataFrame, na_compat: bool = True, spread_rows: bool = False) -> DataFrame:
    """P5 + P4: (unit keys, seg_id, src, hyp, ref) with hyp the cleaned
    translation. Missing cells become 'nan' (reference behaviour) unless
    ``na_compat=False``. ``spread_rows``: deal the cleaned rows out, see ``spread``."""
    out = seg.select(*UNIT_KEYS, "seg_id",
                     stringify_missing("source", na_compat).alias("src"),
                     clean_translation(stringify_missing("translation", na_compat)).alias("hyp"),
                     stringify_missing("target", na_compat).alias("ref"))
    return spread(out) if spread_rows else out


def unit_statistics(prepared: DataFrame, tokenizer: str = "13a", spm_model: str | None = None,
                    with_rouge_meteor: bool = True, scorers: dict | None = None,
                    chrf_word_order: int = 0, meteor_kw: dict | None = None) -> DataFrame:
    """What a unit's metrics are made of, in one pass over the segments: the keys,
    n_segments, the BLEU and chrF counts (``b_`` and ``c_``, for each order), and for each
    segment score its sum and number (``s_`` and ``n_``). Statistics of parts of a unit add up
    (``merge_statistics``); scores don't.

    One Arrow task per partition computes, for each segment, the BLEU and chrF
    statistics, ROUGE-L F, METEOR and the plug-in scorers' segment scores; one
    hash aggregate per unit sums them (partial aggregation before the
    only small shuffle). No join between metric families and no cached copy of the
    segment table.
    ``scorers``: out column -> (factory, batch_size) for U1 plug-ins (xcomet,
    ssa_comet); absent ones stay NULL, as does metricx until the back-fill."""
    from ..functions.align import meteor_segment, rouge_l_f
    from ..functions.tokenize import py_bleu_tokenizer, py_chrf_chars, py_chrf_words
    from ..operators import ngram
    from ..operators.neural import plugin_key, resident, scored
    from ..operators.rouge import py_rouge_tokens
    import pandas as pd
    from pyspark.sql import types as T

    keys = UNIT_KEYS
    scorers = scorers or {}
    meteor_kw = meteor_kw or {}
    tok = py_bleu_tokenizer(tokenizer, spm_model)
    b_specs = [(n, "tok", n) for n in range(1, 5)]
    c_specs = [(n, "char", n) for n in range(1, 7)] + [(6 + n, "word", n) for n in range(1, chrf_word_order + 1)]
    b_cols = [f"b_{x}_{o}" for (o, _, _) in b_specs for x in ("hyp", "ref", "match")]
    c_cols = [f"c_{x}_{o}" for (o, _, _) in c_specs for x in ("hyp", "ref", "match")]
    f_cols = (["rouge_l", "meteor"] if with_rouge_meteor else []) + list(scorers)
    schema = T.StructType([prepared.schema[k] for k in keys]
                          + [T.StructField(c, T.LongType()) for c in b_cols + c_cols]
                          + [T.StructField(c, T.DoubleType()) for c in f_cols])
    scorer_items = [(col, plugin_key(factory), factory, size) for col, (factory, size) in scorers.items()]

    def fn(batches):
        built = resident({key: factory for _, key, factory, _ in scorer_items})
        for pdf in batches:
            srcs, hyps, refs = pdf["src"].tolist(), pdf["hyp"].tolist(), pdf["ref"].tolist()
            stats, extra = [], []
            for h, r in zip(hyps, refs):
                h, r = h or "", r or ""
                row = ngram._seg_stats({"tok": tok(h)}, {"tok": tok(r)}, b_specs, False)
                row += ngram._seg_stats({"char": py_chrf_chars(h), "word": py_chrf_words(h) if chrf_word_order else []},
                                        {"char": py_chrf_chars(r), "word": py_chrf_words(r) if chrf_word_order else []},
                                        c_specs, True)
                stats.append(row)
                if with_rouge_meteor:
                    extra.append((rouge_l_f(py_rouge_tokens(h), py_rouge_tokens(r)), meteor_segment(h, r, **meteor_kw)))
            out = pd.concat([pdf[keys].reset_index(drop=True),
                             pd.DataFrame(stats, columns=b_cols + c_cols, dtype="int64")], axis=1) if stats else \
                pd.DataFrame({c: pd.Series([], dtype="int64") for c in b_cols + c_cols}).assign(
                    **{k: pd.Series([], dtype=object) for k in keys})[keys + b_cols + c_cols]
            if with_rouge_meteor:
                out["rouge_l"] = pd.Series([e[0] for e in extra], dtype="float64")
                out["meteor"] = pd.Series([e[1] for e in extra], dtype="float64")
            triples = [{"src": a, "mt": b, "ref": c} for a, b, c in zip(srcs, hyps, refs)]
            for col, key, _, batch_size in scorer_items:
                out[col] = pd.Series(scored(built[key], triples, batch_size, col), dtype="float64")
            yield out

    bounded_batches(prepared.sparkSession)
    per_seg = prepared.select(*keys, "src", "hyp", "ref").mapInPandas(fn, schema)
    return per_seg.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_segments"), *[F.sum(c).alias(c) for c in b_cols + c_cols],
                                      *[x for c in f_cols for x in (F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}"))])


def merge_statistics(stats: DataFrame) -> DataFrame:
    """Statistics of parts of units (any number of rows a unit) as one row a unit. Columns that
    only some parts have are null in the others and don't count."""
    return stats.groupBy(*UNIT_KEYS).agg(*[F.sum(c).alias(c) for c in stats.columns if c not in UNIT_KEYS])


def row_from_statistics(stats: DataFrame, with_count: bool = False) -> DataFrame:
    """Metric rows (D11) of one row of statistics a unit: the corpus formulas."""
    from ..operators.bleu import bleu_from_stats
    from ..operators.chrf import chrf_from_stats
    bo, co = (sorted(int(c.rsplit("_", 1)[1]) for c in stats.columns if c.startswith(f"{x}_match_")) for x in "bc")
    bleu = bleu_from_stats([F.col(f"b_match_{n}") for n in bo], [F.col(f"b_hyp_{n}") for n in bo],
                           F.col("b_hyp_1"), F.col("b_ref_1"))
    chrf = chrf_from_stats([F.col(f"c_hyp_{o}") for o in co], [F.col(f"c_ref_{o}") for o in co],
                           [F.col(f"c_match_{o}") for o in co])
    cols = {"bleu": round_half_even(bleu, 2), "chrf": round_half_even(chrf, 2)}
    for c in ["rouge_l", "meteor", "xcomet", "ssa_comet", "metricx"]:
        known = f"s_{c}" in stats.columns
        cols[c] = round_half_even(F.when(F.col(f"n_{c}") > 0, F.col(f"s_{c}") / F.col(f"n_{c}")), 4) if known else F.lit(None).cast("double")
    return stats.select(*UNIT_KEYS, *(["n_segments"] if with_count else []), *[v.alias(k) for k, v in cols.items()])


def metric_row(prepared: DataFrame, **kw) -> DataFrame:
    """All metrics of a unit in one row (``unit_statistics`` says which)."""
    return row_from_statistics(unit_statistics(prepared, **kw))
