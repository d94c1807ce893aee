from polyeval import registry as R
from polyeval.operators.joins import lang_corpus_rows


def test_language_table_counts():
    rows = R._rows(R.LANGUAGES_CSV)
    assert len(rows) == 120
    assert sum(1 for r in rows if r[2]) == 120
    assert sum(1 for r in rows if r[3]) == 51
    assert sum(1 for r in rows if r[4]) == 88
    assert len({r[0] for r in rows}) == 120


def test_alias_table():
    rows = R._rows(R.ALIASES_CSV)
    assert len(rows) == 128
    per_map = {}
    for m, _, _ in rows:
        per_map[m] = per_map.get(m, 0) + 1
    assert per_map == {"irokobench": 2, "global_mmlu": 14, "okapi": 31, "include": 44, "iso": 37}
    keys = {r[0] for r in R._rows(R.LANGUAGES_CSV)}
    assert {c for _, _, c in rows} <= keys  # every mapped code joins the language table


def test_units_per_model():
    units = lang_corpus_rows()
    assert len(units) == 257
    by_ds = {}
    for _, _, ds, _ in units:
        by_ds[ds] = by_ds.get(ds, 0) + 1
    assert by_ds == {"flores-200": 119, "wmt24": 51, "ntrex": 87}


def test_models_and_rules():
    models = R._rows(R.MODELS_CSV)
    assert len(models) == 15
    assert sum(1 for m in models if m[4] == "1") == 14
    assert len(R.RULES) == 9
