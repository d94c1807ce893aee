import io
import json
import os
import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from llm_data import empty, frame, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from polyeval.llm import op11_token_frames as t

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["Áb é ï½ Ａ İstanbul", "<|ENDOFTEXT|> <|endoftext|>x <|startoftext|>", "we've we'LL 'tis don''t a_b 12,345.67 [x](y)",
       "a b c\u0085d\x1ce", "tab\tnew\nline\x0bv\x0cf", "日本語 текст ελληνικά", "� \x00 \x7f", "don’t \U0001f600\U0001f600 x̧́"]


def library(path, values, end=t.END_ID):
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return [e.ids + [end] for e in tok.encode_batch([x or "" for x in values], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def documents(spark):
    odd = {100 + i: x for i, x in enumerate(ODD)}
    return frame(spark, texts() | odd)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_round_trip_equals_the_library(spark, path):
    df = documents(spark).repartition(4)
    rows = df.collect()
    got = t.round_trip(df, path).collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, len(i), crc(i)) for r, i in zip(rows, library(path, [r.text for r in rows])))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in got) == want
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0, *(r.n_tokens for r in in_order)])[:-1].tolist()
    keys = [r.doc_id if r.doc_id is not None else -1 for r in in_order]  # null ids come first
    assert keys == sorted(keys)
    assert t.round_trip(empty(spark), path).count() == 0


def test_words_table_is_emptied_when_full(monkeypatch):
    monkeypatch.setattr(t, "MAX_ENTRIES", 50)
    with open(WORD, "rb") as f:
        w = t.Words(f.read(), 2)
    assert w.by_word
    values = [x or "" for x in texts().values()] + ODD
    for _ in range(2):
        got = [np.frombuffer(x, dtype="<u2").tolist() for x in w.encode([x.encode() for x in values])]
        assert got == [x[:-1] for x in library(WORD, values)]


def test_random_words_equal_the_library():
    r = random.Random(7)
    signs = "".join(map(chr, range(0x21, 0x7F))) + "aeiourst" * 12 + "ÀÉÖØÞßàéöøþÿ×÷ªºµ" + "'\u2019\u0301\u0130\u1e9e"
    values = [" ".join("".join(r.choices(signs, k=r.randrange(1, 9))) for _ in range(60)) for _ in range(400)]
    with open(WORD, "rb") as f:
        got = t.Words(f.read(), 4).encode([x.encode() for x in values])
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == [x[:-1] for x in library(WORD, values)]


def written(spark, df, monkeypatch, frame_bytes=4096, file_bytes=30_000):
    path = tempfile.mkdtemp(prefix="frames-test-")
    monkeypatch.setattr(t.FrameWriter.__init__, "__defaults__", (3, frame_bytes))
    monkeypatch.setattr(t, "FILE_BYTES", file_bytes)
    out = []
    encoded, width = t.tokens(df, WORD)
    rows = sorted(encoded.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.order, r.row))
    buffer, names = None, []
    for r in rows:
        if buffer is None:
            buffer = io.BytesIO()
            w = t.FrameWriter(buffer, width)
        w.add(r.doc_id, bytes(r.ids))
        if w.decoded >= file_bytes:
            w.close()
            out.append(buffer.getvalue())
            buffer = None
    if buffer is not None:
        w.close()
        out.append(buffer.getvalue())
    return path, rows, out, width


def reader(data):
    return t.FrameReader(lambda n, at: data[at:at + n], len(data))


def test_files_are_plain_zstandard_and_seekable(spark, monkeypatch):
    _, rows, files, width = written(spark, documents(spark), monkeypatch)
    assert width == 2 and len(files) > 1
    flat = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(f), read_across_frames=True).read() for f in files)
    assert flat == b"".join(bytes(r.ids) for r in rows)  # any tool reads the flat array
    at = 0
    for f in files:
        x = reader(f)
        for i in range(len(x.keys)):
            assert x.ids(i) == bytes(rows[at].ids) and (None if x.null[i] else x.keys[i]) == rows[at].doc_id
            at += 1
        assert x.decoded == len(x.at)  # in order, each frame once
    assert at == len(rows)


def test_only_the_frames_asked_for_are_decoded(spark, monkeypatch):
    _, rows, files, _ = written(spark, documents(spark), monkeypatch, frame_bytes=512, file_bytes=1 << 30)
    data = bytearray(files[0])
    x = reader(bytes(data))
    assert len(x.at) > 20
    last = len(rows) - 1
    damaged = int(x.at[2]) + int(x.sizes[2]) // 2
    data[damaged] ^= 0xFF
    y = reader(bytes(data))
    assert y.ids(last) == bytes(rows[last].ids) and y.decoded <= 2  # the damage lies elsewhere
    with pytest.raises((ValueError, zstandard.ZstdError)):
        for i in range(len(rows)):
            y.ids(i)
    other = t.FrameWriter(io.BytesIO(), 2)
    other.add(1, b"\1\0" * 50)
    other.close()
    sound = bytearray(other.out.getvalue())
    sound[-9 - 12 - 12 + 8] ^= 1  # the first frame's checksum in the seek table
    with pytest.raises(ValueError, match="checksum"):
        reader(bytes(sound)).ids(0)
    with pytest.raises(ValueError, match="seek table"):
        reader(bytes(sound[:-1]) + b"x")


def test_data_source_pushes_ids_down(spark):
    path = tempfile.mkdtemp(prefix="frames-test-")
    df = documents(spark)
    t.write_tokens(df, path, WORD)
    ids = {r.doc_id: i for r, i in zip(df.collect(), library(WORD, [r.text for r in df.collect()]))}
    back = t.read_documents(spark, path)
    for rule, want in (("doc_id = 10", [10]), ("doc_id in (1, 8, 555)", [1, 8]), ("doc_id >= 15 and doc_id < 101", [15, 16, 17, 100]),
                       ("doc_id is null", [None]), ("doc_id <=> 3", [3]), ("doc_id > 1000", []), ("doc_id <= 1", [0, 0, 1]), ("doc_id is not null and doc_id > 105", [106, 107])):
        only = back.where(rule)
        assert "Filter (" not in only._jdf.queryExecution().executedPlan().toString()
        got = only.collect()
        assert sorted((r.doc_id for r in got), key=str) == sorted(want, key=str)
        assert all(np.frombuffer(bytes(r.ids), dtype="<u4").tolist() == ids[r.doc_id] for r in got)
    assert t.read_documents(spark, path, "skip").where("ids is not null").count() == 0
    assert back.where(F.col("n_tokens") == 1).count() == sum(len(i) == 1 for i in library(WORD, [r.text for r in df.collect()]))
    with open(f"{path}/part-lost.zst", "wb") as f:
        f.write(b"rubbish")
    assert back.count() == df.count()  # files that no commit named aren't read
    manifest = json.load(open(f"{path}/_manifest.json"))
    assert manifest["width"] == 2 and all(os.path.getsize(f"{path}/{f['name']}") == f["bytes"] for f in manifest["files"])


def test_one_id_on_many_rows_spans_tasks(spark, monkeypatch):
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    path = tempfile.mkdtemp(prefix="frames-test-")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t.write_tokens(rows, path, WORD)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = json.load(open(f"{path}/_manifest.json"))["files"]
    assert len(files) > 1 and max(f["documents"] for f in files) < 3000
    assert t.read_documents(spark, path).count() == 4000
