"""User-supplied learned scorers and generators.

A plug-in is a *factory* (picklable, no arguments) that builds the heavy
object once per Python worker; the object is then called on batches. Factories
are told apart by their pickled form, closures' contents included, so two
scorers from one maker stay two:

* scorer:    ``scorer(list[{"src", "mt", "ref"}]) -> list[float]``
* generator: ``generator(list[str], sampling: dict) -> list[str]``

Batches stream through ``mapInPandas`` (Arrow), never through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import round_half_even, strip_output
from ..session import bounded_batches

_RESIDENT: dict = {}  # of a Python worker: plug-in key -> built object


def plugin_key(factory: Callable) -> str:
    """Identity of a factory, taken on the driver."""
    return hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def resident(wanted: dict) -> dict:
    """The built objects of ``wanted`` (key -> factory). What an earlier task of this
    worker built is used again; what this one doesn't need is let go."""
    for k in [k for k in _RESIDENT if k not in wanted]:
        del _RESIDENT[k]
    for k, factory in wanted.items():
        if k not in _RESIDENT:
            _RESIDENT[k] = factory()
    return {k: _RESIDENT[k] for k in wanted}


def scored(scorer: Callable, triples: list[dict], batch_size: int, name: str) -> list[float]:
    """Segment scores, as many as there are segments."""
    out: list[float] = []
    for i in range(0, len(triples), batch_size):
        part = triples[i:i + batch_size]
        got = list(scorer(part))
        if len(got) != len(part):
            raise ValueError(f"scorer of {name!r} returned {len(got)} scores for {len(part)} segments")
        out += got
    return out


def score_segments(df: DataFrame, factory: Callable, out_col: str, batch_size: int = 128,
                   src: str = "src", mt: str = "hyp", ref: str = "ref", keep: list[str] | None = None) -> DataFrame:
    """Append ``out_col`` (double) = the scorer's segment score. ``keep``: columns that
    come back with it (all); texts that nobody reads further on need not leave the worker again."""
    keep = df.columns if keep is None else list(keep)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out_col, T.DoubleType())])
    key = plugin_key(factory)
    bounded_batches(df.sparkSession)
    df = df.select(*dict.fromkeys([*keep, src, mt, ref]))

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = resident({key: factory})[key]
        for pdf in batches:
            triples = [{"src": s, "mt": m, "ref": r} for s, m, r in zip(pdf[src], pdf[mt], pdf[ref])]
            out = pdf[keep].copy()
            out[out_col] = pd.Series(scored(scorer, triples, batch_size, out_col), dtype="float64", index=pdf.index)
            yield out
    return df.mapInPandas(fn, schema)


def system_score(df: DataFrame, keys: list[str], factory: Callable, out_col: str,
                 batch_size: int = 128, digits: int | None = 4, **cols) -> DataFrame:
    """The system score of a unit = mean segment score."""
    s = score_segments(df, factory, out_col, batch_size, keep=keys, **cols)
    m = F.avg(out_col)
    return s.groupBy(*keys).agg((round_half_even(m, digits) if digits is not None else m).alias(out_col))


def error_mean(seg_scores: DataFrame, keys: list[str], err_col: str) -> DataFrame:
    """Mean of segment errors; a unit without segments has none (NULL)."""
    return seg_scores.groupBy(*keys).agg(F.avg(err_col).alias("error_mean"))


def invert_error(mean_err, offset: float = 25.0, digits: int = 4):
    """Higher-is-better score ``round(offset - mean_error, 4)``."""
    c = F.col(mean_err) if isinstance(mean_err, str) else mean_err
    return round_half_even(F.lit(offset) - c, digits)


def generate(df: DataFrame, factory: Callable, prompt_col: str = "prompt", out_col: str = "translation",
             sampling_cols: tuple[str, ...] = ("temperature", "top_p", "top_k", "max_tokens"),
             model_col: str = "model", spread_cols: tuple[str, ...] | None = None) -> DataFrame:
    """U2 + P6: one generation per prompt, first candidate, stripped.

    Rows are dealt by model and the request's own keys (``spread_cols``: by
    default every unit, conversation and segment key that the table has), so a
    model with many prompts spans many tasks, and a task's rows are sorted by
    model, so it holds one engine at a time. Prompts of one model with different
    sampling parameters go to the engine in separate calls. ``factory(model)``
    builds the engine."""
    schema = T.StructType(df.schema.fields + [T.StructField("_raw", T.StringType())])
    factory_key = plugin_key(factory)
    bounded_batches(df.sparkSession)
    by = [model_col, *sampling_cols]

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            outs = pd.Series([None] * len(pdf), dtype=object, index=pdf.index)
            for _, part in pdf.groupby(by, sort=False, dropna=False):
                model = part[model_col].iloc[0]
                key = (factory_key, model)
                gen = resident({key: lambda m=model: factory(m)})[key]
                params = {k: (None if pd.isna(v) else v) for k, v in part.iloc[0][list(sampling_cols)].to_dict().items()}
                got = list(gen(part[prompt_col].tolist(), params))
                if len(got) != len(part):
                    raise ValueError(f"generator of {model!r} returned {len(got)} texts for {len(part)} prompts")
                outs.loc[part.index] = got
            out = pdf.copy()
            out["_raw"] = outs
            yield out
    if spread_cols is None:
        spread_cols = tuple(c for c in ("dataset", "src_lang", "tgt_lang", "conv_id", "seg_id") if c in df.columns)
    g = df.repartition(model_col, *spread_cols).sortWithinPartitions(*by).mapInPandas(fn, schema)
    return g.withColumn(out_col, strip_output("_raw")).drop("_raw")
