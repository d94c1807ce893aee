import base64
import gzip
import hashlib
import os
import tempfile

from pyspark.sql import functions as F

from polyeval.llm import op10_warc as w

SCHEMA = "page_id long, url string, html string, digest string, payload string, refers_to long"


def pages(spark):
    rows = [(0, "http://a/x y\r\nz%20é", "same"), (1, "http://b", "same"), (2, None, None), (3, "http://c", ""), (4, "http://d", "é" * 5000),
            (5, "u" * 9000, "x\r\n\r\ny"), (6, "http://e", "same"), (6, "http://e", "same"), (None, "http://n", "same")]
    rows += [(100 + i, f"http://p/{i}", f"<p>{i % 40}</p>" * 50) for i in range(200)]
    return spark.createDataFrame([(*r, "d", "p", 1) for r in rows], SCHEMA)


def want(rows):
    top = {}
    for r in rows:
        if r.page_id is not None:
            h = r.html or ""
            top[h] = max(top.get(h, -1), r.page_id)
    out = []
    for r in rows:
        h = r.html or ""
        keep = r.page_id is None or top[h] == r.page_id
        out.append((r.page_id, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(),
                    "response" if keep else "revisit", None if keep else top[h]))
    return out


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def test_round_trip(spark):
    df = pages(spark)
    got = [tuple(r) for r in w.round_trip(df).collect()]
    assert sorted(got, key=key) == sorted(want(df.collect()), key=key)
    assert w.round_trip(df.limit(0)).count() == 0


def test_payloads_headers_and_plain_files(spark, monkeypatch):
    df = pages(spark)
    for level in (0, 6):
        path = tempfile.mkdtemp(prefix="warc-test-")
        w.write_pages(df, path, level=level, min_bytes=1)
        back = w.read_records(spark, path)
        got = {(r.page_id, r.target_uri): r for r in back.collect()}
        for r in df.collect():
            own = got[(r.page_id, r.url)]
            if own.record_type == "response":
                assert own.payload.decode() == (r.html or "")
            else:
                assert own.payload is None and own.refers_to > own.page_id
        assert got[(2, None)].record_type == got[(3, "http://c")].record_type == "response"  # shorter than min_bytes
        only = back.where("record_type = 'revisit' and page_id < 110 and refers_to is not null")
        assert "Filter (" not in only._jdf.queryExecution().executedPlan().toString()
        assert {r.record_type for r in only.collect()} == {"revisit"}
        assert w.read_records(spark, path, "skip").where("payload is not null").count() == 0
        odd = back.where(F.length("target_uri") == 9000).collect()  # not a header predicate: Spark filters
        assert [r.page_id for r in odd] == [5]


def test_unwanted_payloads_are_not_decoded(tmp_path):
    import pyarrow as pa
    good = w.member(w.render(1, "http://a", b"x" * 100_000, "D", None), 1)
    bad = bytearray(w.member(w.render(2, "http://b", os.urandom(100_000), "D", None), 1))
    bad[60_000:60_100] = bytes(100)  # a damaged payload behind sound headers
    path = tmp_path / "a.warc.gz"
    path.write_bytes(bytes(bad) + good)
    with pa.OSFile(str(path)) as f:
        records = [w.columns_of(h) for h, _ in w.Reader(f, path.stat().st_size).records()]
    assert [r["page_id"] for r in records] == [2, 1]


def test_members_written_elsewhere(tmp_path):
    import pyarrow as pa
    path = tmp_path / "b.warc.gz"
    path.write_bytes(b"".join(gzip.compress(w.render(i, "http://a", b"p" * i, "D", None)) for i in range(300)))
    with pa.OSFile(str(path)) as f:
        got = [(w.columns_of(h)["page_id"], w.payload_of(block())) for h, block in w.Reader(f, path.stat().st_size).records()]
    assert got == [(i, b"p" * i) for i in range(300)]


def test_uncommitted_files_are_not_read(spark):
    path = tempfile.mkdtemp(prefix="warc-test-")
    w.write_pages(pages(spark), path)
    n = w.read_records(spark, path, "skip").count()
    with open(f"{path}/part-lost.warc.gz", "wb") as f:
        f.write(w.member(w.render(1, "http://a", b"x", "D", None), 1))
    assert w.read_records(spark, path, "skip").count() == n
