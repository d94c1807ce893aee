import json
import os

import pandas as pd

from polyeval import schemas
from polyeval.plans.translation_metrics import prepare_segments
from polyeval.sources import store


def _write_unit(base, dataset, model, pair, rows):
    d = base / dataset / model
    d.mkdir(parents=True, exist_ok=True)
    pd.DataFrame(rows, columns=["source", "target", "translation"]).to_csv(d / f"{pair}.csv", index=False)


def test_scan_segments_pandas_dialect(spark, tmp_path):
    base = tmp_path / "translations"
    _write_unit(base, "ntrex", "Phi-4", "eng-fra", [
        ("Hello, \"world\"", "Bonjour\nle monde", "<think>hm</think> Bonjour le monde"),
        ("Empty", "Vide", None),
        ("Literal", "NA", "None"),
    ])
    _write_unit(base, "wmt24", "Phi-4", "eng-fra-x", [("a", "b", "c")])
    segs, bad = store.scan_segments(spark, str(base), with_status=True)
    rows = sorted(segs.collect(), key=lambda r: r["source"])
    assert len(rows) == 3
    rows = [r for r in rows if r["source"] != "Literal"]
    assert rows[1]["source"] == 'Hello, "world"' and rows[1]["target"] == "Bonjour\nle monde"
    assert (rows[0]["dataset"], rows[0]["model"], rows[0]["src_lang"], rows[0]["tgt_lang"]) == \
        ("ntrex", "Phi-4", "eng", "fra")
    prep = {r["src"]: r["hyp"] for r in prepare_segments(segs).collect()}
    assert prep["Empty"] == "nan"          # missing cell -> 'nan', as pandas astype(str)
    assert prep["Literal"] == "nan"        # pandas reads 'None' / 'NA' as missing too
    assert prep['Hello, "world"'] == "Bonjour le monde"
    assert [r["status"] for r in bad.collect()] == ["error"]
    assert store.scan_segments(spark, str(tmp_path / "nothing")).count() == 0


def test_metrics_reference_layout_and_missing_column(spark, tmp_path):
    root = tmp_path / "metrics"
    (root / "Phi-4").mkdir(parents=True)
    (root / "Phi-4" / "ntrex.csv").write_text(
        "translation-pair,bleu,chrf++,rouge-l,meteor,xcomet,ssa-comet,metricx\n"
        "eng-fra,10.5,40.1,0.3,0.4,0.8,0.7,\n"
        "eng-deu,11.5,41.1,0.3,0.4,0.8,0.7,oops\n"
        "eng-spa,12.5,42.1,0.3,0.4,0.8,0.7,21.5\n")
    (root / "Phi-4" / "flores-200.csv").write_text(
        "translation-pair,bleu,chrf++,rouge-l,meteor,xcomet,ssa-comet\n"
        "eng-fra,1.0,2.0,0.1,0.2,0.3,0.4\n")
    m = {(r["dataset"], r["tgt_lang"]): r for r in store.scan_metrics(spark, str(root), "reference").collect()}
    assert m[("ntrex", "fra")]["metricx"] is None
    assert m[("ntrex", "deu")]["metricx"] is None
    assert m[("ntrex", "spa")]["metricx"] == 21.5
    assert m[("flores-200", "fra")]["metricx"] is None and m[("flores-200", "fra")]["chrf"] == 2.0
    assert store.scan_metrics(spark, str(tmp_path / "none")).count() == 0


def test_scorer_jsonl_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("eng", "ü ß 猫", "hyp ü")], "src string, ref string, hyp string")
    out = str(tmp_path / "in.jsonl")
    store.export_scorer_jsonl(df, out)
    line = "".join(open(os.path.join(out, f), encoding="utf-8").read()
                   for f in sorted(os.listdir(out)) if f.endswith(".json"))
    assert "猫" in line and "\\u" not in line
    assert json.loads(line) == {"source": "eng", "reference": "ü ß 猫", "hypothesis": "hyp ü"}
    pred = tmp_path / "pred.jsonl"
    pred.write_text('{"source": "a", "prediction": 3.5}\n{"prediction": 1.5}\n')
    assert sorted(r["prediction"] for r in store.scan_predictions(spark, str(pred)).collect()) == [1.5, 3.5]
    empty = tmp_path / "empty.jsonl"
    empty.write_text("")
    assert store.scan_predictions(spark, str(empty)).count() == 0


def test_write_scores_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "scores")
    a = spark.createDataFrame([("m1", "fra", 0.5), ("m1", "deu", 0.4), ("m2", "spa", 0.3)],
                              "model string, lang_code string, belebele double")
    store.write_scores(a, path)
    b = spark.createDataFrame([("m1", "ita", 0.9)], "model string, lang_code string, belebele double")
    store.write_scores(b, path)
    back = spark.read.option("header", True).csv(path)
    got = sorted((r["model"], r["lang_code"]) for r in back.collect())
    assert got == [("m1", "ita"), ("m2", "spa")]
    files = [f for f in os.listdir(os.path.join(path, "model=m2")) if f.endswith(".csv")]
    assert len(files) == 1
    # rows ascending by lang_code inside the model's file
    store.write_scores(a.unionByName(b), path)
    f = [x for x in os.listdir(os.path.join(path, "model=m1")) if x.endswith(".csv")][0]
    lines = open(os.path.join(path, "model=m1", f)).read().splitlines()
    assert lines[0] == "lang_code,belebele" and [x.split(",")[0] for x in lines[1:]] == ["deu", "fra", "ita"]


def test_write_segments_partitioned(spark, tmp_path):
    path = str(tmp_path / "segs")
    rows = [("m", ds, "eng", t, i, f"s{i}", f"t{i}", f"h{i}") for ds in ("ntrex", "wmt24")
            for t in ("fra", "deu") for i in range(3)]
    df = spark.createDataFrame(rows, schemas.SEGMENTS)
    store.write_segments(df, path)
    assert sorted(os.listdir(path + "/dataset=ntrex/model=m")) == ["tgt_lang=deu", "tgt_lang=fra"]
    back = store.read_segments(spark, path)
    assert back.count() == 12
    assert back.filter("dataset = 'wmt24' and tgt_lang = 'fra'").count() == 3


def test_append_and_upsert_metrics(spark, tmp_path):
    path = str(tmp_path / "metrics")
    row = lambda tgt, mx: ("m", "ntrex", "eng", tgt, 1.0, 2.0, 0.1, 0.2, 0.3, 0.4, mx)
    store.append_metrics(spark.createDataFrame([row("fra", None)], schemas.METRICS), path)
    store.append_metrics(spark.createDataFrame([row("deu", None)], schemas.METRICS), path)
    assert store.scan_metrics(spark, path).count() == 2
    cur = spark.createDataFrame([row("fra", 20.0), row("deu", 21.0)], schemas.METRICS)
    store.upsert_metrics(spark, cur, path)
    got = sorted((r["tgt_lang"], r["metricx"]) for r in store.scan_metrics(spark, path).collect())
    assert got == [("deu", 21.0), ("fra", 20.0)]


def test_read_corpus_keeps_each_datasets_split(spark, tmp_path):
    from polyeval.sources.corpus import read_corpus
    rows = [("flores-200", "devtest", 0, "a"), ("flores-200", "dev", 1, "b"),
            ("wmt24", "train", 0, "c"), ("ntrex", "test", 0, "d"), ("ntrex", "train", 1, "e")]
    path = str(tmp_path / "corpus")
    spark.createDataFrame(rows, "dataset string, split string, seg_id long, eng_Latn string") \
         .write.parquet(path)
    got = sorted(r["eng_Latn"] for r in read_corpus(spark, path).collect())
    assert got == ["a", "c", "d"]


def test_csv_columns_go_by_name(spark, tmp_path):
    base = tmp_path / "translations"
    for pair, cols, rows in [("eng-fra", ["translation", "source", "extra", "target"], [("hyp", "src", "x", "ref"), ("h2", "s2", "", "r\n2")]),
                             ("eng-deu", ["source", "target", "translation"], [("a", "b", "c")]), ("eng-spa", ["source", "target"], [("a", "b")])]:
        d = base / "ntrex" / "phi-4"
        d.mkdir(parents=True, exist_ok=True)
        pd.DataFrame(rows, columns=cols).to_csv(d / f"{pair}.csv", index=False)
    segs, bad = store.scan_segments(spark, str(base), with_status=True)
    got = {(r.tgt_lang, r.source): (r.target, r.translation, r.model) for r in segs.collect()}
    assert got == {("fra", "src"): ("ref", "hyp", "Phi-4"), ("fra", "s2"): ("r\n2", "h2", "Phi-4"), ("deu", "a"): ("b", "c", "Phi-4")}
    assert [r.detail for r in bad.collect()] == ["header lacks source, target or translation"]


def test_upsert_keeps_other_rows(spark, tmp_path):
    path = str(tmp_path / "metrics")
    row = lambda ds, tgt, mx: ("m", ds, "eng", tgt, 1.0, 2.0, 0.1, 0.2, 0.3, 0.4, mx)
    store.append_metrics(spark.createDataFrame([row("ntrex", t, None) for t in ("fra", "deu", "spa")] + [row("wmt24", "fra", 1.0)], schemas.METRICS), path)
    store.upsert_metrics(spark, spark.createDataFrame([row("ntrex", "deu", 20.0), row("flores-200", "ita", 3.0)], schemas.METRICS), path)
    got = sorted((r.dataset, r.tgt_lang, r.metricx) for r in store.scan_metrics(spark, path).collect())
    assert got == [("flores-200", "ita", 3.0), ("ntrex", "deu", 20.0), ("ntrex", "fra", None), ("ntrex", "spa", None), ("wmt24", "fra", 1.0)]


def test_malformed_metric_rows_are_reported(spark, tmp_path):
    d = tmp_path / "metrics" / "phi-4"
    d.mkdir(parents=True)
    (d / "ntrex.csv").write_text("bleu,translation-pair,metricx\n10,eng-fra,2\n11,eng-fra-x,3\n")
    rows, bad = store.scan_metrics(spark, str(tmp_path / "metrics"), "reference", with_status=True)
    assert [(r.model, r.tgt_lang, r.bleu, r.metricx) for r in rows.collect()] == [("Phi-4", "fra", 10.0, 2.0)]
    assert [r.detail for r in bad.collect()] == ["pair name eng-fra-x is not src-tgt"]


def test_scorer_files_by_unit_come_back_with_their_unit(spark, tmp_path):
    rows = [("m", "ntrex", "eng", t, "s", "r", "h" * i) for i, t in enumerate(("fra", "deu", "deu"))]
    df = spark.createDataFrame(rows, "model string, dataset string, src_lang string, tgt_lang string, src string, ref string, hyp string")
    path = str(tmp_path / "in")
    store.export_scorer_jsonl(df, path, by_unit=True)
    back = store.scan_predictions(spark, path, by_unit=True).collect()
    assert sorted((r.tgt_lang, r.hypothesis) for r in back) == [("deu", "h"), ("deu", "hh"), ("fra", "")]


def test_many_models_are_written_by_many_tasks(spark, tmp_path):
    """A folder a model costs a file's making, whatever its bytes."""
    rows = [(f"m{i % 60}", f"l{i // 60}", float(i)) for i in range(180)]
    path = str(tmp_path / "scores")
    store.write_scores(spark.createDataFrame(rows, "model string, lang_code string, belebele double"), path)
    files = [f for d in (tmp_path / "scores").glob("model=*") for f in d.glob("part-*")]
    assert len(files) == 60 and len({f.name.split("-")[1] for f in files}) > 1
    got = spark.read.option("header", True).schema("model string, lang_code string, belebele double").csv(path)
    assert sorted(map(tuple, got.select("model", "lang_code", "belebele").collect())) == sorted(rows)


def test_files_are_read_in_batches_bounded_by_bytes(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    unit = tmp_path / "ntrex" / "Phi-4"
    unit.mkdir(parents=True)
    pd.DataFrame([("s" * 50_000, f"t {i}", "x")[:3] for i in range(300)], columns=["source", "target", "translation"]).to_csv(unit / "eng-fra.csv", index=False)
    got = store.scan_segments(spark, str(tmp_path))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")) <= 4 << 20
    assert got.selectExpr("count(*)", "sum(length(source))", "count(distinct target)").first() == (300, 15_000_000, 300)
