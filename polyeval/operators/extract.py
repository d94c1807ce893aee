"""Benchmark task rows -> long score rows.

The nine extractors are one rule table applied in a single projection: every
rule's pattern is a literal (compiled once per task), the task-name prefixes
are mutually exclusive, so each task row matches at most one rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import registry

RULE_FIELDS = ("benchmark", "pattern", "metric", "fallback_metric", "excluded", "alias_map", "policy")


def rules(names: list[str] | None = None) -> list[dict]:
    out = [dict(zip(RULE_FIELDS, r)) for r in registry.RULES]
    return [r for r in out if names is None or r["benchmark"] in names]


def falsy_or(a: Column, b: Column) -> Column:
    """``a or b`` as Python reads it: a unless a is null or zero."""
    return F.when(a.isNotNull() & (a != 0), a).otherwise(b)


def _metric(metrics: Column, key: str) -> Column:
    """Metric value as double. The JSON reader hands non-finite numbers over
    as quoted text ("NaN", "Infinity"), so quotes are trimmed before the cast;
    any other non-numeric text becomes NULL."""
    return F.btrim(metrics[key], F.lit('"')).try_cast("double")


def _case(rs: list[dict], value) -> Column:
    """CASE benchmark WHEN r THEN value(r) ... END over the rule list."""
    bench = F.col("benchmark")
    expr = None
    for r in rs:
        v = value(r)
        v = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(bench == r["benchmark"], v) if expr is None else expr.when(bench == r["benchmark"], v)
    return expr


def match_rules(tasks: DataFrame, rs: list[dict] | None = None, task_col: str = "task",
                metrics_col: str = "metrics") -> DataFrame:
    """Classify each task by rule, capture raw language (+ script) and pick the
    rule's metric. Tasks matching no rule are dropped."""
    rs = rs or rules()
    task = F.col(task_col)
    bench = reduce(lambda acc, r: acc.when(task.rlike(r["pattern"]), F.lit(r["benchmark"])),
                   rs[1:], F.when(task.rlike(rs[0]["pattern"]), F.lit(rs[0]["benchmark"])))
    m = F.col(metrics_col)
    out = tasks.withColumn("benchmark", bench).filter(F.col("benchmark").isNotNull())

    def score(r):
        first = _metric(m, r["metric"])
        return falsy_or(first, _metric(m, r["fallback_metric"])) if r["fallback_metric"] else first

    script_rules = [r for r in rs if r["policy"] == "script"]
    cols = {
        "raw_code": _case(rs, lambda r: F.regexp_extract(task, r["pattern"], 1)),
        "script": (_case(script_rules, lambda r: F.regexp_extract(task, r["pattern"], 2))
                   if script_rules else F.lit(None).cast("string")),
        "score": _case(rs, score),
        "alias_map": _case(rs, lambda r: F.lit(r["alias_map"]).cast("string")),
        "policy": _case(rs, lambda r: r["policy"]),
        "excluded": _case(rs, lambda r: F.lit(r["excluded"]).cast("string")),
    }
    return out.withColumns(cols)


def filter_scored(df: DataFrame) -> DataFrame:
    """Drop the benchmark's English rows and rows without a score."""
    excluded = F.coalesce(F.col("raw_code") == F.col("excluded"), F.lit(False))
    return df.filter(~excluded & F.col("score").isNotNull())


def normalize_lang(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """P1 + J1: map raw codes through the rule's alias map.

    override/pass: mapped when the map knows the code, else unchanged;
    drop: rows whose code the map does not know go; script: (zho, Hant) ->
    zho_trad, otherwise the language part unchanged. ``aliases`` is the fixed
    128-row table, broadcast (its size does not grow with the data).
    """
    a = aliases.select(F.col("map_name").alias("alias_map"), F.col("raw_code"),
                       F.col("lang_code").alias("_alias"))
    joined = df.join(F.broadcast(a), ["alias_map", "raw_code"], "left")
    script_expr = F.col("raw_code")
    for lang, script, code in registry.SCRIPT_OVERRIDES:
        script_expr = F.when((F.col("raw_code") == lang) & (F.col("script") == script),
                             F.lit(code)).otherwise(script_expr)
    policy = F.col("policy")
    lang = (F.when(policy == "drop", F.col("_alias"))
             .when(policy == "script", script_expr)
             .otherwise(F.coalesce(F.col("_alias"), F.col("raw_code"))))
    return joined.withColumn("lang_code", lang).filter(F.col("lang_code").isNotNull()).drop("_alias")


def extract_scores(tasks: DataFrame, aliases: DataFrame, keep: list[str],
                   benchmarks: list[str] | None = None) -> DataFrame:
    """Task rows (keep..., pos, task, metrics) -> long score rows
    (keep..., pos, task, benchmark, lang_code, score)."""
    rs = rules(benchmarks)
    matched = filter_scored(match_rules(tasks, rs))
    return normalize_lang(matched, aliases).select(
        *keep, "pos", "task", "benchmark", "lang_code", "score")


def union_extracts(frames: list[DataFrame]) -> DataFrame:
    """Bag union of separately extracted frames (sparse columns allowed)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
