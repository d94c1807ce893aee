"""Scorer and generator plug-ins: identity, builds per worker, counts."""

import os

import pytest

from polyeval.operators import neural as U
from polyeval.plans.translation_metrics import metric_row, prepare_segments

COLS = "model string, dataset string, src_lang string, tgt_lang string, seg_id long, source string, target string, translation string"


def segments(spark, n=400):
    return spark.createDataFrame([("m", "ntrex", "eng", "fra", i, f"s{i}", f"t{i}", f"h{i}") for i in range(n)], COLS).repartition(2)


def constant(value, log=None):
    """A maker: every factory has the same module and name."""
    def factory():
        if log:
            with open(log, "a") as f:
                f.write(f"{os.getpid()} {value}\n")
        return lambda triples: [value] * len(triples)
    return factory


def test_two_scorers_of_one_maker_and_one_build_each(spark, tmp_path):
    log = str(tmp_path / "builds")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")  # many batches a task
    try:
        r = metric_row(prepare_segments(segments(spark)), with_rouge_meteor=False,
                       scorers={"xcomet": (constant(0.9, log), 8), "ssa_comet": (constant(0.1, log), 8)}).first()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert (r.xcomet, r.ssa_comet) == (0.9, 0.1)
    builds = open(log).read().split("\n")[:-1]
    assert len(builds) == len(set(builds))  # once per worker process and scorer


def test_resident_objects_of_other_factories_are_let_go():
    a, b = (lambda: object()), (lambda: object())
    one = U.resident({"a": a, "b": b})
    assert U.resident({"a": a, "b": b}) == one
    U.resident({"b": b})
    assert U.resident({"a": a})["a"] is not one["a"]
    assert U.plugin_key(constant(1)) != U.plugin_key(constant(2))


def test_short_output_raises(spark):
    short = lambda: (lambda triples: [0.5])
    with pytest.raises(Exception, match="returned 1 scores for"):
        U.system_score(prepare_segments(segments(spark, 6)), ["model"], short, "xcomet").collect()


def test_generator_calls_by_model_and_parameters(spark):
    rows = [("a", i, f"p{i}", 0.1 * (i % 2), None, None, 16) for i in range(20)] + [("b", i, f"p{i}", 0.7, 0.9, 5, 16) for i in range(20)]
    df = spark.createDataFrame(rows, "model string, seg_id long, prompt string, temperature double, top_p double, top_k int, max_tokens int")

    def factory(model):
        return lambda prompts, sampling: [f" {model} {p} {sampling['temperature']} {sampling['top_p']} " for p in prompts]
    got = {(r.model, r.seg_id): r.translation for r in U.generate(df, factory).collect()}
    assert got == {(m, i): f"{m} {p} {t} {q}" for m, i, p, t, q, _, _ in rows}


def test_a_batch_is_bounded_by_bytes(spark):
    """However long the texts: 400 of 50 KB would be one batch of 20 MB by the number of rows."""
    long = spark.range(400).coalesce(1).selectExpr("id as seg_id", "'u' as model", "'s' as src", "repeat('ab ', 8000) as hyp", "repeat('ab ', 8000) as ref")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, "64m")
    sizes = lambda: (lambda part: [float(len(part))] * len(part))
    scored = U.score_segments(long, sizes, "n", batch_size=1 << 20, keep=["model"])
    assert scored.columns == ["model", "n"] and scored.agg({"n": "max"}).first()[0] < 200
    spark.conf.set(key, "64m")
    asked = long.selectExpr("model", "seg_id", "hyp as prompt", "0.5D as temperature", "1D as top_p", "1 as top_k", "1 as max_tokens")
    got = U.generate(asked, lambda model: lambda prompts, sampling: [str(len(prompts))] * len(prompts), spread_cols=())
    assert got.selectExpr("max(int(translation))").first()[0] < 200
    assert int(spark.conf.get(key).removesuffix("b")) <= 4 << 20
