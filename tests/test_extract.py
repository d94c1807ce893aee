import json
import math
import os

from pyspark.sql import functions as F

from polyeval import registry
from polyeval.plans.benchmark_scores import score_table, score_table_from_files
from polyeval.sources import results


def _doc_df(spark, docs):
    rows = [(m, run, mt, json.dumps(d)) for m, run, mt, d in docs]
    return spark.createDataFrame(rows, "model string, path string, mtime long, value string") \
                .withColumn("mtime", F.col("mtime").cast("timestamp"))


DOC = {"results": {
    "afrimmlu_direct_swa_prompt_1": {"acc,none": 0.5, "alias": "x"},
    "afrimmlu_direct_eng_prompt_1": {"acc,none": 0.9},          # English: dropped
    "afrimmlu_direct_hau_prompt_1": {"acc,none": None},         # null: dropped
    "afrixnli_orm_prompt_2": {"acc,none": 0.4},                  # orm -> gaz
    "belebele_zho_Hant": {"acc,none": 0.7},                      # zho_trad
    "belebele_zho_Hans": {"acc,none": 0.6},                      # zho
    "belebele_hin_Deva": {"acc,none": 0.3},
    "belebele_hin_Latn": {"acc,none": 0.2},                      # second script: loses (first wins)
    "global_mmlu_sw": {"acc,none": 0.55},
    "global_mmlu_zz": {"acc,none": 0.1},                         # unmapped: dropped
    "global_mmlu_en": {"acc,none": 0.99},
    "hellaswag_ar": {"acc_norm,none": 0, "acc,none": 0.25},      # zero acc_norm -> acc
    "hellaswag_ja": {"acc_norm,none": 0.45, "acc,none": 0.1},    # not in okapi: passes through as 'ja'
    "truthfulqa_de_mc2": {"acc,none": "n/a"},                    # non-numeric -> not scored
    "mgsm_direct_sw": {"exact_match,flexible-extract": 0.12},
    "mlqa_en_hi": {"f1,none": 0.33},
    "include_base_44_north macedonian": {"acc,none": 0.66},
    "include_base_44_klingon": {"acc,none": 0.77},               # unmapped: dropped
    "some_other_task": {"acc,none": 0.5},
    "hellaswag_fr": {"acc_norm,none": float("nan"), "acc,none": 0.2},  # NaN kept, counts as null
}}


def test_rules_golden(spark):
    docs = _doc_df(spark, [("m", "r1", 1, DOC)])
    wide = {r["lang_code"]: r.asDict() for r in score_table(docs, registry.aliases_df(spark)).collect()}
    assert wide["swh"]["afrimmlu"] == 0.5
    assert "eng" not in wide and "en" not in wide
    assert "hau" not in wide
    assert wide["gaz"]["afrixnli"] == 0.4
    assert wide["zho_trad"]["belebele"] == 0.7
    assert wide["zho"]["belebele"] == 0.6
    assert wide["hin"]["belebele"] == 0.3 and wide["hin"]["mlqa"] == 0.33
    assert wide["swh"]["global_mmlu"] == 0.55 and wide["swh"]["mgsm"] == 0.12
    assert "zz" not in wide and "klingon" not in wide
    assert wide["arb"]["hellaswag"] == 0.25
    assert wide["ja"]["hellaswag"] == 0.45
    assert wide["deu"]["truthfulqa"] is None if "deu" in wide else True
    assert wide["mkd"]["include"] == 0.66
    assert wide["fra"]["hellaswag"] is None       # NaN -> null, row kept
    assert set(wide["swh"]) >= set(registry.BENCHMARKS)


def test_no_results_key_and_newest_run(spark):
    old = {"results": {"belebele_fra_Latn": {"acc,none": 0.1}}}
    new = {"results": {"belebele_fra_Latn": {"acc,none": 0.2}}}
    docs = _doc_df(spark, [("m", "a", 10, old), ("m", "b", 20, new), ("n", "c", 5, {"config": {}})])
    out = score_table(docs, registry.aliases_df(spark)).collect()
    assert [(r["model"], r["lang_code"], r["belebele"]) for r in out] == [("m", "fra", 0.2)]


def test_latest_run_tie_breaks_by_run(spark):
    df = spark.createDataFrame([("m", "a", 5), ("m", "b", 5), ("m", "c", 4)], "model string, run string, t long")
    r = results.latest_run(df, "model", "run", "t").collect()
    assert r[0]["run"] == "b"


def test_files_end_to_end(spark, tmp_path):
    base = tmp_path / "raw"
    for model, hub, runs in [("Phi-4", "microsoft/phi-4", [(100, 0.3), (200, 0.4)]),
                             ("Unknown", "x/y", [(100, 0.9)])]:
        d = base / model / hub.replace("/", "__")
        d.mkdir(parents=True)
        for i, (mt, v) in enumerate(runs):
            f = d / f"results_{i}.json"
            f.write_text(json.dumps({"results": {"mgsm_direct_ja": {"exact_match,flexible-extract": v}}}))
            os.utime(f, (mt, mt))
    (base / "Phi-4" / "microsoft__phi-4" / "results_bad.json").write_text("{not json")
    os.utime(base / "Phi-4" / "microsoft__phi-4" / "results_bad.json", (50, 50))
    out = score_table_from_files(spark, str(base)).collect()
    assert [(r["model"], r["lang_code"], r["mgsm"]) for r in out] == [("Phi-4", "jpn", 0.4)]


def test_corrupt_document_status(spark):
    df = spark.createDataFrame([("a", '{"results": {}}'), ("b", "{oops"), ("c", '{"x": 1}')], "u string, value string")
    st = {r["unit"]: r["status"] for r in results.documents_status(df, "value", "u").collect()}
    assert st == {"a": "ok", "b": "error", "c": "skipped"}


def test_nan_only_language_keeps_row(spark):
    d = {"results": {"hellaswag_it": {"acc_norm,none": float("nan")}}}
    out = score_table(_doc_df(spark, [("m", "r", 1, d)]), registry.aliases_df(spark)).collect()
    assert len(out) == 1 and out[0]["lang_code"] == "ita" and out[0]["hellaswag"] is None
    assert not math.isnan(0.0)


def test_model_folder_matched_without_case(spark):
    from polyeval.sources.results import result_path_match
    reg = registry.models_df(spark)
    df = spark.createDataFrame([("/raw/phi-4/microsoft__phi-4/results_1.json",),
                                ("/raw/Phi-4/microsoft__phi-3/results_1.json",),
                                ("/raw/Unknown/x__y/results_1.json",)], "path string")
    out = result_path_match(df, reg).select("reg_model", "path").collect()
    assert [(r["reg_model"], r["path"]) for r in out] == [("Phi-4", "/raw/phi-4/microsoft__phi-4/results_1.json")]


def test_score_table_independent_of_partitioning(spark):
    from conftest import SF
    from polyeval.sources import fixtures
    docs = fixtures.result_documents(spark, SF)
    runs = []
    for parts in (1, 4, 17):
        t = score_table(docs.repartition(parts), registry.aliases_df(spark), run_col="run_id")
        runs.append(sorted(tuple(r) for r in t.collect()))
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) > 0
