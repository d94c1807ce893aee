import hashlib
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))
import llm_data

from polyeval.llm import op4_substring, op8_suffixes


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_words(rows, w=35):
    count = Counter(tuple(x[i:i + w]) for _, t in rows for x in [words_of(t)] for i in range(len(x) - w + 1))
    out = []
    for i, t in rows:
        x = words_of(t)
        gone = set()
        for k in range(len(x) - w + 1):
            if count[tuple(x[k:k + w])] > 1:
                gone |= set(range(k, k + w))
        out.append((i, len(x), len(gone), " ".join(v for k, v in enumerate(x) if k not in gone)))
    return out


def brute_bytes(rows, w=50):
    least = {}
    order = lambda i: (i is not None, i or 0)
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        b = (t or "").encode()
        for k in range(len(b) - w + 1):
            least.setdefault(b[k:k + w], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - w + 1):
            if order(least[b[k:k + w]]) < order(i):
                gone[k:k + w] = b"\1" * w
        runs = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_word_windows(spark):
    extra = llm_data.texts() | {1000 + i: f"{' '.join(llm_data.words(30 + i, 50 + i))} {' '.join(llm_data.words(36, 99))}" for i in range(6)}
    df = llm_data.frame(spark, extra)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in op4_substring.remove_repeats(df).collect()]
    assert sorted(got, key=key) == sorted(brute_words(rows_of(df)), key=key)
    assert op4_substring.remove_repeats(llm_data.empty(spark)).count() == 0


def test_word_windows_keep_columns_and_layout(spark):
    df = llm_data.frame(spark)
    out = op4_substring.remove_repeats(df, keep_columns=True, keep_layout=True).collect()
    want = {i: k for i, _, _, k in brute_words(rows_of(df))}
    whole = dict(rows_of(df))
    for r in out:
        assert words_of(r.kept_text) == words_of(want[r.doc_id])
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
        if not r.n_removed:
            assert r.kept_text == (whole[r.doc_id] or "")
        assert r.rest.chunk in ("c", None)


def test_byte_suffixes(spark):
    extra = llm_data.texts() | {1000 + i: "z" * i + llm_data.texts()[0][40:140 + i] + "é" * (40 + i) for i in range(0, 30, 7)}
    df = llm_data.frame(spark, extra)
    out = op8_suffixes.digest(op8_suffixes.remove_repeats(df))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()]
    assert sorted(got, key=key) == sorted(brute_bytes(rows_of(df)), key=key)
    assert op8_suffixes.remove_repeats(llm_data.empty(spark)).count() == 0


def test_byte_blocks_are_seamless(monkeypatch):
    import pyarrow as pa
    texts = [b"abc" * 40 + bytes(range(65, 91)) * 3, b"", b"q" * 200, bytes(range(32, 127)) * 3]
    group = pa.table({"chunk": [0] * 4, "id": [0, 1, 2, 3], "text": pa.array(texts, pa.binary())})
    ref = op8_suffixes.ChunkBytes(group, 50, 26, 3)
    ref.digits()
    monkeypatch.setattr(op8_suffixes, "BLOCK", 17)
    got = op8_suffixes.ChunkBytes(group, 50, 26, 3)
    got.digits()
    assert (ref.digit == got.digit).all() and (ref.shared == got.shared).all()


def test_byte_anchors_are_found_once_a_pass(monkeypatch):
    import numpy as np
    import pyarrow as pa
    texts = [" ".join(llm_data.words(300, i % 5)).encode() for i in range(8)] + [b"", b"short", b"a" * 500]
    group = pa.table({"chunk": [0] * 11, "id": list(range(11)), "text": pa.array(texts, pa.binary())})
    hashed = []
    real = op8_suffixes.ex.window_hash

    def counted(codes, length, *base):
        hashed.append(len(codes) if length == 26 else 0)
        return real(codes, length, *base)

    monkeypatch.setattr(op8_suffixes.ex, "window_hash", counted)
    for each in ("second_pass", "last_pass", "covered"):
        hashed.clear()
        getattr(op8_suffixes.ChunkBytes(group, 50, 26, 3), each)({})
        assert sum(hashed) <= 1.1 * sum(map(len, texts))
    whole = op8_suffixes.ChunkBytes(group, 50, 26, 3)
    whole.covered({})
    monkeypatch.setattr(op8_suffixes, "BLOCK", 17)
    cut = op8_suffixes.ChunkBytes(group, 50, 26, 3)
    cut.covered({})
    for name in ("start", "size", "owner", "stretch", "open", "values"):  # a stretch isn't cut where a block ends
        assert np.array_equal(getattr(whole, name), getattr(cut, name))
    cut.digits(places=False)
    whole.digits()
    assert np.array_equal(whole.digit, cut.digit) and np.array_equal(whole.shared, cut.shared)


def test_window_hashes_are_seamless(monkeypatch):
    import numpy as np
    from polyeval.llm import exchange as ex
    codes = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for base in (ex._POWER, ex.second_base()):
        want = [sum(int(c) * pow(int(base), 34 - k, 1 << 64) for k, c in enumerate(codes[i:i + 35])) % (1 << 64) for i in range(365)]
        assert ex.window_hash(codes, 35, base).tolist() == want
        with monkeypatch.context() as m:
            m.setattr(ex, "_STEP", 16)
            assert ex.window_hash(codes, 35, base).tolist() == want
    assert len(ex.window_hash(codes[:34], 35)) == 0
