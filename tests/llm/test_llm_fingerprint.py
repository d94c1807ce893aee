import hashlib
import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
import llm_data
from pyspark.sql import functions as F

from polyeval.llm import op9_fingerprint as f


def test_columns_and_likeness(spark):
    rows = llm_data.texts() | {30 + i: " ".join(llm_data.words(300 + i, 60 + i)) for i in range(80)}
    df = llm_data.frame(spark, rows, repeat=False).repartition(5)
    got = {r.doc_id: r for r in f.fingerprints(df).collect()}
    ids = sorted(rows)
    assert sorted(got) == ids
    for k, i in enumerate(ids):
        text, after = rows[i] or "", rows[ids[(k + 1) % len(ids)]] or ""
        q = len(text) // 4
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256((text[:len(text) - q] + after[:q]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if i >= 30:
            assert 0.4 < r.near_edited < 0.8 and (r.near_next < 0.2 or k == len(ids) - 1)
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    assert got[1].near_next > 0.85 and got[3].near_next == 1.0 and got[5].near_next < 1
    assert len({r.fingerprint for r in got.values()}) >= len({x or "" for x in rows.values()}) - 1  # white space only: no paragraphs
    assert f.fingerprints(llm_data.empty(spark)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    df = llm_data.frame(spark)
    got = f.fingerprints(df).collect()
    assert len(got) == df.count()
    assert len({(r.fingerprint) for r in got if r.doc_id == 0}) == 1
    one = f.fingerprints(llm_data.frame(spark, {5: "only one text here"}, repeat=False)).first()
    assert one.near_next == 1.0


def test_order_independence_insertion_and_deletion(spark):
    v = lambda c: f.vector(f.paragraph_hashes(F.col(c)))
    df = spark.createDataFrame([("one a.\ntwo b.\ntwo b.\nthree c.", "three c.\ntwo b.\none a.\ntwo b.", "one a.\ntwo b.", "two b.\nthree c.")], "x string, y string, a string, b string")
    r = df.select(f.written_out(v("x")).alias("x"), f.written_out(v("y")).alias("y"),
                  f.written_out(f.combined(v("a"), v("b"))).alias("sum"), f.written_out(f.combined(v("x"), v("b"), -1)).alias("less"),
                  f.written_out(v("a")).alias("a")).first()
    assert r.x == r.y == r["sum"] and r.less == r.a and r.a != r.x


def test_successors_across_blocks(spark):
    keys = [-(1 << 58), -5, 0, 1, 2, (1 << 15) - 1, 1 << 15, 1 << 31, (1 << 31) + 1, 1 << 57]
    got = dict(f._successors(spark.createDataFrame([(k,) for k in keys], "key long")).collect())
    assert got == dict(zip(keys, [*keys[1:], keys[0]]))
