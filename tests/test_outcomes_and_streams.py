import json
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_incremental import _doc, _run

from polyeval import registry, schemas
from polyeval.operators import bootstrap, neural, status
from polyeval.operators.external import ChildScorer, ScorerFailed, external_scorer
from polyeval.plans import standins
from polyeval.plans.benchmark_scores import score_table_from_files
from polyeval.plans.translation_metrics import metric_row, prepare_segments
from polyeval.sources import results, store, versions
from polyeval.streaming import incremental as I


# ------------------------------------------------------- scorer processes
def triples(n):
    return [{"src": "s", "mt": "a" * (i % 7) + "\n\"é", "ref": "b" * 9} for i in range(n)]


def errors(rows):
    return [25.0 * (1 - min(len(t["mt"]), 9) / max(len(t["mt"]), 9)) for t in rows]


DIES_ONCE = """
import json, os, sys
flag = sys.argv[1]
for line in sys.stdin:
    n = json.loads(line)["n"]
    for i in range(n):
        row = json.loads(sys.stdin.readline())
        if i == 3 and not os.path.exists(flag):
            open(flag, "w").close()
            sys.stderr.write("out of memory, say")
            os._exit(9)
        a, b = len(row["hypothesis"]), len(row["reference"])
        print(json.dumps({"prediction": 25.0 * (1.0 - min(a, b) / max(a, b, 1))}), flush=True)
"""


def test_a_scorer_that_dies_once_is_started_again(tmp_path):
    scorer = ChildScorer([sys.executable, "-c", DIES_ONCE, str(tmp_path / "flag")], timeout=30, restarts=1)
    rows = triples(10)
    assert scorer(rows) == errors(rows) and scorer.started == 2
    assert scorer(rows[:4]) == errors(rows[:4]) and scorer.started == 2  # the child lives on
    scorer.close()


def test_scorers_that_fail_for_good():
    for program, said in (("import sys; sys.stderr.write('no model'); sys.exit(3)", "no model"),
                          ("import time; time.sleep(60)", "within"), ("print('hello')", "isn't a prediction")):
        scorer = ChildScorer([sys.executable, "-c", program], timeout=1.0, restarts=1)
        with pytest.raises(ScorerFailed, match=said):
            scorer(triples(3))
        assert scorer.started == 2 and scorer.child is None
    talks = "import sys, json\nfor line in sys.stdin:\n  print(json.dumps({'prediction': 1}), flush=True)"
    with pytest.raises(ScorerFailed, match="more answers"):
        many = ChildScorer([sys.executable, "-c", talks + "\n  import time; print(json.dumps({'prediction': 1}) * 1, flush=True); print('x', flush=True)"], timeout=5, restarts=0)
        many(triples(1))


def test_every_segment_is_scored_once_though_children_die(spark, tmp_path):
    rows = triples(400)
    df = spark.createDataFrame([(i, t["src"], t["mt"], t["ref"]) for i, t in enumerate(rows)], "seg_id long, src string, hyp string, ref string").repartition(3)
    factory = external_scorer([sys.executable, "-c", DIES_ONCE, str(tmp_path / "flag")], timeout=30)
    got = neural.score_segments(df, factory, "prediction", batch_size=16).collect()
    assert [r.prediction for r in sorted(got, key=lambda r: r.seg_id)] == errors(rows)


# ------------------------------------------------------- bootstrap
def test_bootstrap_is_near_the_resampling_of_the_definition(spark):
    r = np.random.default_rng(3)
    values = {"a": r.beta(2, 5, 700), "b": r.beta(5, 1, 150), "c": np.array([0.5])}
    rows = [(u, i, float(x)) for u, xs in values.items() for i, x in enumerate(xs)] + [("a", 10_000, None)]
    df = spark.createDataFrame(rows, "unit string, seg_id long, f double")
    runs = [bootstrap.bootstrap_mean(df.repartition(n, *by), ["unit"], "f", ["seg_id"], "m", digits=None).orderBy("unit").collect()
            for n, by in ((1, []), (7, ["seg_id"]))]
    assert runs[0] == runs[1]  # the same numbers however the rows are dealt
    for row in runs[0]:
        x = values[row.unit]
        means = x[r.integers(0, len(x), (1000, len(x)))].mean(axis=1)  # as many rows, with replacement
        low, mid, high = np.percentile(means, [2.5, 50, 97.5])
        error = max(x.std() / np.sqrt(len(x)), 1e-9)
        assert abs(row.m - mid) < 0.2 * error and abs(row.m_low - low) < 0.35 * error and abs(row.m_high - high) < 0.35 * error
    seeds = np.array([12345, 2**63 + 1], dtype=np.uint64)
    w = bootstrap.weights(seeds, 100_000)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02


# ------------------------------------------------------- statistics that add up
def segments(spark, n):
    return spark.createDataFrame([("Phi-4", "ntrex", "eng", ("fra", "deu")[i % 2], i, f"s {i}", f"the cat {i} sat on mat {i % 5}", f"the cat {i} sits on a mat")
                                  for i in range(n)], schemas.SEGMENTS)


def test_parts_add_up_to_the_whole(spark, tmp_path):
    path, base, ckpt = (str(tmp_path / x) for x in ("stats", "segments", "ckpt"))
    seg = segments(spark, 60)
    kw = {"scorers": {"xcomet": (standins.length_ratio_scorer, 16)}}
    for k in range(3):  # every part holds segments of each unit
        seg.where(F.col("seg_id") % 3 == k).coalesce(1).write.mode("append").parquet(base)
        _run(I.incremental_statistics(spark, base, path, ckpt, max_files=1, **kw))
        if k == 1:
            I.compact_statistics(spark, path)
    want = metric_row(prepare_segments(seg), **kw)
    key = ["model", "dataset", "tgt_lang"]
    assert I.metrics_so_far(spark, path).orderBy(key).collect() == want.orderBy(key).collect()


def test_a_stream_batch_of_few_files_is_dealt_to_many_tasks(spark, tmp_path, monkeypatch):
    from polyeval.plans import translation_metrics as M
    base, tasks, plain = str(tmp_path / "segments"), [], M.unit_statistics
    segments(spark, 200).coalesce(1).write.parquet(base)
    monkeypatch.setattr(M, "unit_statistics", lambda prepared, **kw: (tasks.append(prepared.rdd.getNumPartitions()), plain(prepared, **kw))[1])
    _run(I.incremental_statistics(spark, base, str(tmp_path / "stats"), str(tmp_path / "ckpt"), with_rouge_meteor=False))
    assert len(tasks) == 1 and tasks[0] >= 3 * spark.sparkContext.defaultParallelism


def test_a_batch_that_failed_or_is_replayed_counts_once(spark, tmp_path, monkeypatch):
    path, base, ckpt = (str(tmp_path / x) for x in ("stats", "segments", "ckpt"))
    segments(spark, 20).coalesce(1).write.parquet(base)
    publish = versions.publish
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(OSError("before the switch")))
        q = I.incremental_statistics(spark, base, path, ckpt, with_rouge_meteor=False)
        with pytest.raises(Exception, match="before the switch"):
            q.awaitTermination()
    assert I.metrics_so_far(spark, path) is None

    def after(*a):
        publish(*a)
        raise OSError("after the switch")
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", after)
        q = I.incremental_statistics(spark, base, path, ckpt, with_rouge_meteor=False)
        with pytest.raises(Exception, match="after the switch"):
            q.awaitTermination()
    _run(I.incremental_statistics(spark, base, path, ckpt, with_rouge_meteor=False))  # the stream asks for the batch again
    assert sorted(r.n_segments for r in I.metrics_so_far(spark, path, with_count=True).collect()) == [10, 10]


# ------------------------------------------------------- scores and their runs
def test_a_crash_between_ledger_and_table_is_made_good(spark, tmp_path, monkeypatch):
    base = tmp_path / "raw"
    scores, runs, ckpt = (str(tmp_path / x) for x in ("scores", "runs", "ckpt"))
    models = registry.models_df(spark).filter("in_benchmark")
    _doc(base, "Phi-4", "microsoft/phi-4", "results_a.json", 100, 0.1)
    _run(I.incremental_scores(spark, str(base), scores, runs, ckpt, models))
    _doc(base, "Phi-4", "microsoft/phi-4", "results_b.json", 200, 0.2)
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(OSError("no switch")))
        q = I.incremental_scores(spark, str(base), scores, runs, ckpt, models)
        with pytest.raises(Exception, match="no switch"):
            q.awaitTermination()
    held = lambda: ([r.belebele for r in I.committed_scores(spark, runs).collect()], [r.path[-14:] for r in I.committed_runs(spark, runs).collect()])
    assert held() == ([0.1], ["results_a.json"])  # scores and run row of the old version, both
    write = store.write_scores
    with monkeypatch.context() as m:
        calls = []

        def crashes(*a, **k):
            calls.append(1)
            if len(calls) > 1:  # the start's copy goes through, the one after the commit doesn't
                raise OSError("died between")
            return write(*a, **k)
        m.setattr(store, "write_scores", crashes)
        q = I.incremental_scores(spark, str(base), scores, runs, ckpt, models)
        with pytest.raises(Exception, match="died between"):
            q.awaitTermination()
    assert held() == ([0.2], ["results_b.json"])
    _run(I.incremental_scores(spark, str(base), scores, runs, ckpt, models))
    assert [r.belebele for r in spark.read.parquet(scores).collect()] == [0.2] and held()[0] == [0.2]


def _documents(spark, rows):
    return spark.createDataFrame([(json.dumps({"results": {task: {"acc,none": v}}}), f"/raw/{m}/org__{m}/results_{k}.json", k) for m, k, task, v in rows],
                                 "value string, path string, k int").select("value", "path", F.timestamp_seconds("k").alias("mtime"))


def test_a_ledger_has_no_folder_for_each_model(spark, tmp_path):
    root, names = str(tmp_path / "ledger"), [f"m{i}" for i in range(40)]
    models = spark.createDataFrame([(m, f"org/{m}") for m in names], "model string, hub_path string")
    I.commit_scores(spark, _documents(spark, [(m, 1, "belebele_fra_Latn", 0.1) for m in names]), models, root)
    I.commit_scores(spark, _documents(spark, [("m1", 0, "belebele_fra_Latn", 0.9), ("m2", 2, "belebele_fra_Latn", 0.2), ("m3", 2, "no_such_task", 0.3)]), models, root)
    now = versions.current(spark, root)
    assert set(now["parts"]) == {I.SCORES, I.RUNS} and len(versions.folders(now)) == 2
    assert not [n for f in versions.folders(now) for n in versions.listed(spark, f"{versions.data_path(root, f)}/{I.SCORES}") if "=" in n]
    want = {m: 0.1 for m in names if m != "m3"} | {"m2": 0.2}  # m3's newest run has no score
    held = lambda: {r.model: r.belebele for r in I.committed_scores(spark, root).collect()}
    runs = lambda: sorted((r.model, r.path, r.mtime) for r in I.committed_runs(spark, root).collect())
    assert held() == want and len(before := runs()) == 40
    assert not I.commit_scores(spark, _documents(spark, [("m2", 2, "belebele_fra_Latn", 0.2)]), models, root)  # replayed
    I.compact_scores(spark, root)
    assert len(versions.folders(versions.current(spark, root))) == 1 and held() == want and runs() == before
    I.commit_scores(spark, _documents(spark, [("m4", 3, "belebele_fra_Latn", 0.4)]), models, root)
    assert held() == want | {"m4": 0.4}


# ------------------------------------------------------- newest files, outcomes
def test_only_the_newest_files_are_read(spark, tmp_path):
    base = tmp_path / "raw files"
    _doc(base, "Phi-4", "microsoft/phi-4", "results_a.json", 100, 0.1)
    _doc(base, "Phi-4", "microsoft/phi-4", "results_b.json", 300, 0.3)
    _doc(base, "Phi-4", "other/phi-4", "results_c.json", 900, 0.9)  # no registered model's folder
    (base / "Phi-4" / "microsoft__phi-4" / "results_a.json").write_text("{ not read")
    import os
    os.utime(base / "Phi-4" / "microsoft__phi-4" / "results_a.json", (100, 100))
    out = score_table_from_files(spark, str(base))
    assert [(r.model, r.belebele) for r in out.collect()] == [("Phi-4", 0.3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "results_b.json" in plan and "results_a.json" not in plan
    listed = results.newest_files(spark, f"{base}/*/*/results_*.json", registry.models_df(spark))
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_outcomes_are_observed_while_the_job_runs(spark, tmp_path):
    values = [json.dumps({"results": {"belebele_fra_Latn": {"acc,none": 0.5}}}), "{ broken", '{"config": 1}', '{"results": {}}']
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values * 5)], "run long, value string")
    want = {r.status: r["count"] for r in results.documents_status(docs, "value", "run").groupBy("status").count().collect()}
    st = results.document_status("value")
    watched, seen = status.observe_outcomes(docs.withColumn("s", st), F.col("s"), "scan", {"second half": F.col("run") >= 10})
    watched.write.format("noop").mode("overwrite").save()
    got = {r.status: r.n for r in status.outcome_counts(spark, seen, "scan").collect()}
    assert got == want | {"detail second half": 10}
    odd, seen = status.observe_outcomes(docs, F.lit("odd"), "scan")
    odd.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="no known outcome"):
        status.outcome_counts(spark, seen, "scan")
