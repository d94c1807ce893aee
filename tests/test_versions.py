import pandas as pd
import pytest
from pyspark.sql import functions as F

from polyeval import schemas
from polyeval.sources import ordered, store, versions


def rows(spark, values):
    """(model, dataset, tgt, bleu) rows of a metric table."""
    return spark.createDataFrame([(m, d, "eng", t, b, *[None] * 6) for m, d, t, b in values], schemas.METRICS)


def stored(spark, path):
    return sorted((r.model, r.dataset, r.tgt_lang, r.bleu) for r in store.scan_metrics(spark, path).collect())


FIRST = [("m1", "ntrex", "fra", 1.0), ("m1", "ntrex", "deu", 2.0), ("m2", "wmt24", "fra", 3.0)]


def test_a_failed_upsert_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "metrics")
    store.append_metrics(rows(spark, FIRST), path)
    store.upsert_metrics(spark, rows(spark, [("m1", "ntrex", "fra", 9.0)]), path)
    want = sorted([("m1", "ntrex", "fra", 9.0), *FIRST[1:]])
    assert stored(spark, path) == want and versions.current(spark, path)["version"] == 1

    def fails(*a, **k):
        raise OSError("the store went away")
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", fails)  # all files are written, the switch isn't
        with pytest.raises(OSError):
            store.upsert_metrics(spark, rows(spark, [("m1", "ntrex", "deu", 7.0), ("m3", "ntrex", "fra", 5.0)]), path)
    assert stored(spark, path) == want
    with monkeypatch.context() as m:
        m.setattr(store, "_write_metrics", fails)  # not even the files are
        with pytest.raises(OSError):
            store.upsert_metrics(spark, rows(spark, [("m1", "ntrex", "deu", 7.0)]), path)
    assert stored(spark, path) == want


def test_a_reader_under_way_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "metrics")
    store.append_metrics(rows(spark, FIRST), path)
    store.upsert_metrics(spark, rows(spark, [("m2", "wmt24", "fra", 4.0)]), path)
    before = store.scan_metrics(spark, path)
    store.upsert_metrics(spark, store.scan_metrics(spark, path).withColumn("bleu", F.col("bleu") + 10), path)
    assert sorted(r.bleu for r in before.collect()) == [1.0, 2.0, 4.0]
    assert sorted(b for *_, b in stored(spark, path)) == [11.0, 12.0, 14.0]
    store.append_metrics(rows(spark, [("m2", "wmt24", "deu", 6.0), ("m4", "ntrex", "fra", 8.0)]), path)  # K3 on a table with versions
    assert sorted(b for *_, b in stored(spark, path)) == [6.0, 8.0, 11.0, 12.0, 14.0]
    assert versions.vacuum(spark, path) >= 1
    assert sorted(b for *_, b in stored(spark, path)) == [6.0, 8.0, 11.0, 12.0, 14.0]


def test_an_overtaken_commit_merges_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "metrics")
    store.append_metrics(rows(spark, FIRST), path)
    publish, calls = versions.publish, []

    def overtaken(spark_, root, manifest, after):
        if not calls:  # another commit gets in first
            calls.append(1)
            store.upsert_metrics(spark, rows(spark, [("m1", "ntrex", "deu", 20.0)]), path)
        return publish(spark_, root, manifest, after)
    monkeypatch.setattr(versions, "publish", overtaken)
    store.upsert_metrics(spark, rows(spark, [("m1", "ntrex", "fra", 30.0)]), path)
    assert stored(spark, path) == sorted([("m1", "ntrex", "fra", 30.0), ("m1", "ntrex", "deu", 20.0), FIRST[2]])
    with pytest.raises(versions.CommitConflict):
        publish(spark, path, {"parts": {}}, 0)


def test_files_of_forty_columns(spark, tmp_path):
    base = tmp_path / "tr" / "ntrex" / "Phi-4"
    base.mkdir(parents=True)
    names = [f"c{i}" for i in range(37)]
    text = ["one, \"two\"\nthree", " x ", "ü\r\ny"]
    for pair, at in (("eng-fra", 0), ("eng-deu", 37), ("eng-spa", 17)):
        cols = [*names[:at], "source", "target", "translation", *names[at:]]
        values = {"source": text[0], "target": text[1], "translation": text[2]}
        pd.DataFrame([[values.get(c, f"{c},\n\"q\"") for c in cols]] * 3, columns=cols).to_csv(base / f"{pair}.csv", index=False)
    (base / "eng-ita.csv").write_text("source,target\nonly,two\n")
    seg, status = store.scan_segments(spark, str(tmp_path / "tr"), with_status=True)
    got = seg.collect()
    assert len(got) == 9 and {(r.source, r.target, r.translation) for r in got} == {tuple(text)}
    assert [r.detail for r in status.collect()] == ["header lacks source, target or translation"]
    table = tmp_path / "m" / "Phi-4"
    table.mkdir(parents=True)
    cols = [*names, "metricx", "bleu", "translation-pair"]
    pd.DataFrame([[*names, 1.5, 2.5, "eng-fra"]], columns=cols).to_csv(table / "ntrex.csv", index=False)
    r = store.scan_metrics(spark, str(tmp_path / "m"), layout="reference").collect()
    assert [(x.model, x.dataset, x.tgt_lang, x.bleu, x.metricx, x.meteor) for x in r] == [("Phi-4", "ntrex", "fra", 2.5, 1.5, None)]


def test_segment_files_round_trip(spark, tmp_path):
    seg = spark.createDataFrame([("Phi-4", "ntrex", "eng", t, i, f" s{i}\n\"", "t,\r\n", "x\\\"y " * i) for t in ("fra", "deu") for i in range(1, 4)], schemas.SEGMENTS)
    store.write_segment_files(seg, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out" / "ntrex" / "Phi-4").glob("*.csv")) == ["eng-deu.csv", "eng-fra.csv"]
    by_pandas = pd.read_csv(tmp_path / "out" / "ntrex" / "Phi-4" / "eng-fra.csv")
    assert by_pandas["translation"].tolist() == ["x\\\"y " * i for i in range(1, 4)]  # in order of seg_id
    key = ["tgt_lang", "source", "target", "translation"]
    assert sorted(store.scan_segments(spark, str(tmp_path / "out")).select(*key).collect()) == sorted(seg.select(*key).collect())


def test_ordered_tables(spark, tmp_path):
    path = str(tmp_path / "o")
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("a"), F.lit("x").alias("b")).repartition(7)
    df = df.unionByName(spark.createDataFrame([(None, "y")], "a long, b string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered.write_ordered(df, path, ["a"], max_records_per_file=300)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = ordered.positions(spark, path).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 5002)) and [r.a for r in got] == [None, *range(5000)]
    assert len(list((tmp_path / "o").glob("*.parquet"))) > 10
    assert ordered.order_faults(spark, path, ["a"]).count() == 0
    bad = str(tmp_path / "bad")
    spark.createDataFrame([(i,) for i in (1, 2, 5, 4)], "a long").coalesce(1).write.parquet(bad)
    spark.createDataFrame([(3,)], "a long").coalesce(1).write.mode("append").parquet(bad)
    assert {r.fault for r in ordered.order_faults(spark, bad, ["a"]).collect()} >= {"rows out of order"}
