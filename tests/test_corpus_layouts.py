from polyeval.operators.joins import lang_corpus_df
from polyeval.sources import corpus


def _write(spark, path, rows, cols):
    import pandas as pd
    path.parent.mkdir(parents=True, exist_ok=True)
    pd.DataFrame(rows, columns=cols).to_parquet(path, index=False)


def test_sentence_columns_by_configuration(spark, tmp_path):
    for code in ("fra_Latn", "deu_Latn"):
        cols = ["id", "sentence_eng_Latn", f"sentence_{code}"]
        _write(spark, tmp_path / f"eng_Latn-{code}" / "devtest-00000.parquet", [(1, "one", f"1 {code}"), (2, "two", f"2 {code}")], cols)
        _write(spark, tmp_path / f"eng_Latn-{code}" / "dev-00000.parquet", [(1, "no", "no")], cols)
    got = corpus.read_pair_configs(spark, str(tmp_path), lang_corpus_df(spark), "flores-200").collect()
    assert sorted((r.tgt_lang, r.seg_id, r.source, r.target) for r in got) == [
        ("deu", 0, "one", "1 deu_Latn"), ("deu", 1, "two", "2 deu_Latn"), ("fra", 0, "one", "1 fra_Latn"), ("fra", 1, "two", "2 fra_Latn")]
    assert {r.dataset for r in got} == {"flores-200"}


def test_source_target_columns_by_configuration(spark, tmp_path):
    for code in ("fr_FR", "de_DE"):
        _write(spark, tmp_path / f"en-{code}" / "train-00000.parquet", [("head", "x"), ("one", f"1 {code}")], ["source", "target"])
    pairs = corpus.read_pair_configs(spark, str(tmp_path), lang_corpus_df(spark), "wmt24")
    got = corpus.drop_leading_row(pairs).collect()
    assert sorted((r.tgt_lang, r.seg_id, r.source, r.target) for r in got) == [("deu", 1, "one", "1 de_DE"), ("fra", 1, "one", "1 fr_FR")]
