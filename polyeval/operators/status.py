"""Per-unit outcome and coverage counts as DataFrames."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def unit_key(keys: list[str]):
    return F.concat_ws("/", *[F.col(k) for k in keys])


def unit_status(expected: DataFrame, produced: DataFrame, keys: list[str], stage: str,
                errors: DataFrame | None = None, skipped: DataFrame | None = None,
                no_metrics: DataFrame | None = None) -> DataFrame:
    """K6: one row per expected unit: ok, or missing; ``skipped`` where the unit was
    done before this run, ``no metrics`` where it had output but nothing could be
    scored (both given by their keys, the first taking precedence); plus error rows
    (e.g. malformed pair names) given as (keys..., detail)."""
    def flag(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys).distinct().withColumn(name, F.lit(True))

    j = expected.select(*keys).join(flag(produced, "_present"), keys, "left")
    outcomes = []
    for df, name, status, detail in ((skipped, "_skipped", "skipped", "done before"),
                                     (no_metrics, "_empty", "no metrics", "no segment could be scored")):
        if df is not None:
            j = j.join(flag(df, name), keys, "left")
            outcomes.append((F.col(name), status, detail))
    status = F.when(F.col("_present"), F.lit("ok")).otherwise(F.lit("missing"))
    detail = F.when(F.col("_present"), F.lit(None)).otherwise(F.lit("no output for unit"))
    for present, name, text in reversed(outcomes):
        status, detail = F.when(present, F.lit(name)).otherwise(status), F.when(present, F.lit(text)).otherwise(detail)
    out = j.select(F.lit(stage).alias("stage"), unit_key(keys).alias("unit"),
                   status.alias("status"), detail.cast("string").alias("detail"))
    if errors is not None:
        out = out.unionByName(errors.select(F.lit(stage).alias("stage"), unit_key(keys).alias("unit"),
                                            F.lit("error").alias("status"), F.col("detail")))
    return out


OUTCOMES = ("ok", "skipped", "no metrics", "missing", "error")


def observe_outcomes(df: DataFrame, status: Column, stage: str, details: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """K6 while the job runs: ``df`` as it is, and an observation that counts its rows by outcome
    (``status``, one of ``OUTCOMES``) when an action goes over it: no second pass, nothing but the
    counts on the driver. ``details``: name -> condition, counted too. Rows count where they pass, so
    observe a table with one row a unit (or document) to count units."""
    seen = Observation(f"{stage}-{uuid.uuid4().hex[:8]}")
    counts = [F.count(F.lit(1)).alias("all")] + [F.count_if(status == o).alias(o) for o in OUTCOMES]
    counts += [F.count_if(F.coalesce(c, F.lit(False))).alias(f"detail {n}") for n, c in (details or {}).items()]
    return df.observe(seen, *counts), seen


def outcome_counts(spark: SparkSession, seen: Observation, stage: str) -> DataFrame:
    """stage, status, n of what was observed; waits for the action. An outcome outside
    ``OUTCOMES`` is an error of the caller and raises."""
    got = seen.get
    if got["all"] != sum(got[o] for o in OUTCOMES):
        raise ValueError(f"{stage}: {got['all'] - sum(got[o] for o in OUTCOMES)} rows have no known outcome")
    rows = [(stage, o, got[o]) for o in OUTCOMES if got[o]] + [(stage, k, v) for k, v in got.items() if k.startswith("detail ") and v]
    return spark.createDataFrame(rows, "stage string, status string, n long")


def unmapped_codes(extracted: DataFrame, languages: DataFrame) -> DataFrame:
    """K6: a warning for each benchmark and language code that passed an extractor
    unmapped and is no key of the language table."""
    odd = extracted.join(F.broadcast(languages.select("lang_code")), "lang_code", "left_anti")  # fixed 120 rows
    return odd.groupBy("benchmark", "lang_code").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("extract").alias("stage"), F.concat_ws("/", "benchmark", "lang_code").alias("unit"),
        F.lit("warning").alias("status"), F.concat(F.col("n").cast("string"), F.lit(" scores of an unmapped language code")).alias("detail"))


def task_coverage(requested: DataFrame, found: DataFrame, group: list[str], task_col: str = "task") -> DataFrame:
    """Per group, tasks requested, and those of them that the results have or
    lack. ``requested``: (group..., task); ``found``: any rows with these columns."""
    f = found.select(*group, task_col).distinct().withColumn("_found", F.lit(1))
    return requested.select(*group, task_col).distinct().join(f, [*group, task_col], "left").groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_requested"), F.count("_found").alias("n_found"),
        F.count_if(F.col("_found").isNull()).alias("n_lacking"))


def coverage_counts(expected: DataFrame, produced: DataFrame, group: list[str], keys: list[str],
                    missing_flag: str | None = None) -> DataFrame:
    """Per group, units expected / present / absent, and (optionally)
    present units whose ``missing_flag`` column is true."""
    p = produced.select(*keys, *( [F.col(missing_flag).alias("_miss")] if missing_flag else [])) \
                .withColumn("_present", F.lit(1))
    j = expected.select(*keys).join(p, keys, "left")
    aggs = [F.count(F.lit(1)).alias("n_expected"),
            F.count("_present").alias("n_present"),
            F.count_if(F.col("_present").isNull()).alias("n_absent")]
    if missing_flag:
        aggs.append(F.count_if(F.coalesce(F.col("_miss"), F.lit(False))).alias("n_missing_metric"))
    return j.groupBy(*group).agg(*aggs)
