from pyspark.sql import functions as F

from polyeval import schemas
from polyeval.operators import joins as J
from polyeval.plans import standins

KEYS = schemas.UNIT_KEYS


def _prep(spark):
    rows = []
    for tgt, n in [("fra", 3), ("deu", 2), ("spa", 4)]:
        for i in range(n):
            rows.append(("m", "ntrex", "eng", tgt, i, f"s{i}", "abcd" * (i + 1), "abcd"))
    return spark.createDataFrame(rows, "model string, dataset string, src_lang string, tgt_lang string, "
                                       "seg_id long, src string, hyp string, ref string")


def test_backfill_fills_only_missing(spark):
    prep = _prep(spark)
    metrics = spark.createDataFrame([("m", "ntrex", "eng", "fra", 3.0), ("m", "ntrex", "eng", "deu", None),
                                     ("m", "ntrex", "eng", "ita", None)],
                                    "model string, dataset string, src_lang string, tgt_lang string, metricx double")
    out = {r["tgt_lang"]: r["metricx"] for r in
           J.backfill_error_metric(metrics, prep, KEYS, standins.length_error_scorer).collect()}
    assert out["fra"] == 3.0                      # present value never changes
    # deu: errors 0 and 25*(1-1/2): mean 6.25 -> 25 - 6.25
    assert out["deu"] == 18.75
    assert out["ita"] is None                     # no segments -> unchanged
    assert set(out) == {"fra", "deu", "ita"}


def test_backfill_missing_column(spark):
    metrics = spark.createDataFrame([("m", "ntrex", "eng", "spa")], "model string, dataset string, "
                                    "src_lang string, tgt_lang string")
    out = J.backfill_error_metric(metrics, _prep(spark), KEYS, standins.length_error_scorer).collect()
    assert out[0]["metricx"] is not None


def test_pending_units_rerun_is_noop(spark):
    models = spark.createDataFrame([("m",)], "model string")
    grid = J.translation_grid(models).select(*KEYS)
    assert grid.count() == 257
    done = grid.filter(F.col("dataset") == "ntrex")
    pending = J.pending_units(grid, done, KEYS)
    assert pending.count() == 257 - 87
    # after the pending units are done, nothing is left
    assert J.pending_units(grid, done.unionByName(pending), KEYS).count() == 0
