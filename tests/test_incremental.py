import json
import os

import pandas as pd

from polyeval import registry
from polyeval.plans.translation_metrics import metric_row, prepare_segments
from polyeval.sources import store
from polyeval.streaming.incremental import incremental_metrics, incremental_scores


def _unit(base, dataset, model, pair, n, seed):
    d = base / dataset / model
    d.mkdir(parents=True, exist_ok=True)
    rows = [(f"src {seed} {i}", f"the cat {i} sat {seed}", f"the cat {i} sits {seed % 3}") for i in range(n)]
    pd.DataFrame(rows, columns=["source", "target", "translation"]).to_csv(d / f"{pair}.csv", index=False)


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def test_two_arrivals_equal_one_batch(spark, tmp_path):
    base, metrics, ckpt = tmp_path / "tr", str(tmp_path / "metrics"), str(tmp_path / "ckpt")
    _unit(base, "ntrex", "Phi-4", "eng-fra", 5, 1)
    _unit(base, "ntrex", "Phi-4", "eng-deu", 4, 2)
    _run(incremental_metrics(spark, str(base), metrics, ckpt, with_rouge_meteor=False))
    _unit(base, "wmt24", "Phi-4", "eng-fra", 6, 3)
    _run(incremental_metrics(spark, str(base), metrics, ckpt, with_rouge_meteor=False))
    # re-running with nothing new changes nothing
    _run(incremental_metrics(spark, str(base), metrics, ckpt, with_rouge_meteor=False))
    inc = {(r["dataset"], r["tgt_lang"]): (r["bleu"], r["chrf"]) for r in store.scan_metrics(spark, metrics).collect()}
    batch = metric_row(prepare_segments(store.scan_segments(spark, str(base))), with_rouge_meteor=False)
    exp = {(r["dataset"], r["tgt_lang"]): (r["bleu"], r["chrf"]) for r in batch.collect()}
    assert inc == exp and len(inc) == 3


def test_default_checkpoint_resumes(spark, tmp_path):
    base, metrics = tmp_path / "tr", str(tmp_path / "metrics")
    _unit(base, "ntrex", "m", "eng-fra", 3, 1)
    _run(incremental_metrics(spark, str(base), metrics, with_rouge_meteor=False))
    _unit(base, "ntrex", "m", "eng-deu", 3, 2)
    _run(incremental_metrics(spark, str(base), metrics, with_rouge_meteor=False))
    assert store.scan_metrics(spark, metrics).count() == 2


def test_replay_with_fresh_checkpoint_is_idempotent(spark, tmp_path):
    base, metrics = tmp_path / "tr", str(tmp_path / "metrics")
    _unit(base, "ntrex", "m", "eng-fra", 3, 1)
    _run(incremental_metrics(spark, str(base), metrics, str(tmp_path / "c1"), with_rouge_meteor=False))
    _run(incremental_metrics(spark, str(base), metrics, str(tmp_path / "c2"), with_rouge_meteor=False))
    assert store.scan_metrics(spark, metrics).count() == 1


def _doc(base, model, hub, name, mtime, value):
    d = base / model / hub.replace("/", "__")
    d.mkdir(parents=True, exist_ok=True)
    f = d / name
    f.write_text(json.dumps({"results": {"belebele_fra_Latn": {"acc,none": value}}}))
    os.utime(f, (mtime, mtime))


def test_newer_documents_replace_scores(spark, tmp_path):
    base = tmp_path / "raw"
    scores, runs, ckpt = str(tmp_path / "scores"), str(tmp_path / "runs"), str(tmp_path / "ckpt")
    models = registry.models_df(spark).filter("in_benchmark")
    _doc(base, "Phi-4", "microsoft/phi-4", "results_a.json", 100, 0.1)
    _run(incremental_scores(spark, str(base), scores, runs, ckpt, models))
    _doc(base, "Phi-4", "microsoft/phi-4", "results_old.json", 50, 0.9)   # arrives later, but older
    _run(incremental_scores(spark, str(base), scores, runs, ckpt, models))
    got = [(r["lang_code"], r["belebele"]) for r in spark.read.parquet(scores).collect()]
    assert got == [("fra", 0.1)]
    _doc(base, "Phi-4", "microsoft/phi-4", "results_b.json", 200, 0.2)
    _run(incremental_scores(spark, str(base), scores, runs, ckpt, models))
    got = [(r["lang_code"], r["belebele"]) for r in spark.read.parquet(scores).collect()]
    assert got == [("fra", 0.2)]
