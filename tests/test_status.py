from polyeval.operators import status as K

KEYS = ["model", "pair"]
SCHEMA = "model string, pair string"


def test_every_outcome_of_a_unit(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    errors = spark.createDataFrame([("m", "x-y-z", "pair name")], SCHEMA + ", detail string")
    out = K.unit_status(frame(*[("m", p) for p in "abcd"]), frame(("m", "a"), ("m", "a"), ("m", "c")), KEYS, "evaluate",
                        errors=errors, skipped=frame(("m", "d")), no_metrics=frame(("m", "c"), ("m", "d")))
    assert {r.unit: r.status for r in out.collect()} == {
        "m/a": "ok", "m/b": "missing", "m/c": "no metrics", "m/d": "skipped", "m/x-y-z": "error"}


def test_requested_tasks(spark):
    asked = spark.createDataFrame([("m", "t1"), ("m", "t2"), ("n", "t1")], "model string, task string")
    found = spark.createDataFrame([("m", "t1"), ("m", "t1"), ("m", "t9")], "model string, task string")
    got = {r.model: (r.n_requested, r.n_found, r.n_lacking) for r in K.task_coverage(asked, found, ["model"]).collect()}
    assert got == {"m": (2, 1, 1), "n": (1, 0, 1)}
