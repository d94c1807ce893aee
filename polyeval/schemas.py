"""Declared schemas of the tables the stages exchange."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw benchmark-result document. Metric values are kept as their JSON text
# (numbers, NaN, strings alike) and converted with try_cast later.
RESULT_DOC = T.StructType([
    T.StructField("results", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))),
])

# D2 (long form): one extracted score per (model, run file, task).
SCORES_LONG = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("run_file", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("task", T.StringType()),
    T.StructField("benchmark", T.StringType()),
    T.StructField("lang_code", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

# Translation segments; dataset / model / pair come from the path.
SEGMENT_FILE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("translation", T.StringType()),
])

SEGMENTS = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("src_lang", T.StringType()),
    T.StructField("tgt_lang", T.StringType()),
    T.StructField("seg_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("translation", T.StringType()),
])

UNIT_KEYS = ["model", "dataset", "src_lang", "tgt_lang"]

# Metric table. All metric columns are nullable doubles (an empty or
# non-numeric cell reads as NULL).
METRICS = T.StructType(
    [T.StructField(k, T.StringType()) for k in UNIT_KEYS]
    + [T.StructField(c, T.DoubleType()) for c in
       ["bleu", "chrf", "rouge_l", "meteor", "xcomet", "ssa_comet", "metricx"]]
)

# Metric file as the reference lays it out (one file per model and dataset).
METRIC_FILE = T.StructType([
    T.StructField("translation-pair", T.StringType()),
    T.StructField("bleu", T.StringType()),
    T.StructField("chrf++", T.StringType()),
    T.StructField("rouge-l", T.StringType()),
    T.StructField("meteor", T.StringType()),
    T.StructField("xcomet", T.StringType()),
    T.StructField("ssa-comet", T.StringType()),
    T.StructField("metricx", T.StringType()),
])

# Scorer exchange.
SCORER_IN = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("reference", T.StringType()),
    T.StructField("hypothesis", T.StringType()),
])
SCORER_OUT = T.StructType(SCORER_IN.fields + [T.StructField("prediction", T.DoubleType())])

# Run status.
RUN_STATUS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("detail", T.StringType()),
])
