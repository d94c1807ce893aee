"""Bootstrap intervals of a unit's mean, resampled where the rows lie.

Each row draws, for each of the resamples, how often it is in: a Poisson(1) number, the limit of
drawing as many rows as there are with replacement. The numbers come from a mixed 64-bit hash of
the row's seed and the resample's number, so they don't hang on partitions, order or
repeated tasks. A task adds weight x value and weight up for each unit and resample (values as whole
numbers of 1e-9, so sums are exact in any order), Spark adds the tasks' sums, and a unit's
interval is read off its resampled means: no row is moved, and nothing but these sums is shuffled.

Percentiles interpolate linearly. A resample that draws no row (it happens in units of a few rows) has
no mean and isn't counted; a unit without values has no row. Null values take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import round_half_even

SAMPLES = 1000
UNIT_VALUE = 1e9  # values are counted in units of 1 / UNIT_VALUE
HELD_UNITS = 256  # units whose sums a task holds before it hands them on
ROWS_AT_ONCE = 512

# FIXED VALUES: the constants of splitmix64.
GOLDEN, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def poisson_thresholds() -> list[int]:
    """A 64-bit number draws k where it is at least k of these: 2^64 * P(Poisson(1) <= k)."""
    out, total = [], 0.0
    for k in range(16):
        total += float(np.exp(-1.0)) / factorial(k)
        out.append(min(int(total * 2.0 ** 64), 2 ** 64 - 1))
    return out


def seed_of(*cols) -> Column:
    """Sixteen hexadecimal digits that tell a row from others: its key columns' hash."""
    return F.substring(F.md5(F.concat_ws("/", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols]).cast("binary")), 1, 16)


def weights(seeds: np.ndarray, samples: int) -> np.ndarray:
    """How often each row (a line) is in each resample."""
    with np.errstate(over="ignore"):
        x = seeds[:, None] + np.arange(1, samples + 1, dtype=np.uint64)[None, :] * np.uint64(GOLDEN)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
        x ^= x >> np.uint64(31)
    return np.searchsorted(np.array(poisson_thresholds(), dtype=np.uint64), x.ravel(), side="right").reshape(x.shape)


def resampled_means(df: DataFrame, keys: list[str], value: str, seed: str, samples: int = SAMPLES) -> DataFrame:
    """keys, sample, mean: one row a unit and resample."""
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("_top", "_weight")])

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list[np.ndarray]] = {}

        def out():
            rows = [(*k, top.tolist(), weight.tolist()) for k, (top, weight) in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=[*keys, "_top", "_weight"])

        for pdf in batches:
            pdf = pdf[pdf[value].notna()]
            for key, part in pdf.groupby(keys, sort=False, dropna=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                top, weight = held.setdefault(key, [np.zeros(samples, dtype=np.int64), np.zeros(samples, dtype=np.int64)])
                amounts = np.floor(part[value].to_numpy(dtype=np.float64) * UNIT_VALUE + 0.5).astype(np.int64)
                seeds = np.array([int(s, 16) for s in part[seed]], dtype=np.uint64)
                for at in range(0, len(part), ROWS_AT_ONCE):
                    w = weights(seeds[at:at + ROWS_AT_ONCE], samples)
                    top += (w * amounts[at:at + ROWS_AT_ONCE, None]).sum(axis=0)
                    weight += w.sum(axis=0)
            if len(held) > HELD_UNITS:
                yield out()
        if held:
            yield out()

    sums = df.select(*keys, value, seed).mapInPandas(fn, schema)
    each = sums.select(*keys, F.posexplode(F.arrays_zip("_top", "_weight")).alias("sample", "_s"))
    each = each.groupBy(*keys, "sample").agg(F.sum("_s._top").alias("_top"), F.sum("_s._weight").alias("_weight"))
    return each.where("_weight > 0").select(*keys, "sample", (F.col("_top") / F.lit(UNIT_VALUE) / F.col("_weight")).alias("mean"))


def bootstrap_mean(df: DataFrame, keys: list[str], value: str, row_keys: list[str], out: str, samples: int = SAMPLES,
                   confidence: float = 0.95, digits: int | None = 4) -> DataFrame:
    """keys, ``out`` (the middle), ``out``_low and ``out``_high of the unit's resampled means. ``row_keys``
    tell the rows apart (rows alike in all of them are drawn together)."""
    seeded = df.withColumn("_seed", seed_of(*keys, *row_keys))
    tail = (1 - confidence) / 2
    p = F.percentile("mean", F.array(F.lit(tail), F.lit(0.5), F.lit(1 - tail)))
    found = resampled_means(seeded, keys, value, "_seed", samples).groupBy(*keys).agg(p.alias("_p"))
    held = (lambda c: round_half_even(c, digits)) if digits is not None else (lambda c: c)
    return found.select(*keys, *[held(F.col("_p")[i]).alias(n) for i, n in ((1, out), (0, f"{out}_low"), (2, f"{out}_high"))])
