"""The pipeline against brute force, and the SQL oracles."""

import os
import re
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import llm_data
import test_llm_minhash
import test_llm_substring
import test_llm_warc
from test_llm_packing import check_pieces

from polyeval.llm import op1_quality, op7_pii, oracle

pipeline = pytest.importorskip("corpus_pipeline")
P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


def documents():
    base = llm_data.words(200, 21, 3000)
    passage = " ".join(llm_data.words(60, 22, 3000))
    rows = dict(llm_data.texts())
    rows[40] = " ".join(base)
    rows[41] = " ".join([*base[:100], "edited", *base[101:]])
    for i in range(6):
        own = " ".join(llm_data.words(150, 30 + i, 5000))
        rows[50 + i] = f"{own}\n{passage}\n{own[:200]} x mail me{i}.x@mail.com or 10.0.0.{i}" if i < 4 else own
    return rows


def brute_without(text, words_gone):
    at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out, run = [], None
    for k, (a, b) in enumerate(at):
        if k in words_gone:
            run = None
        elif run is None:
            out.append(text[a:b])
            run = b
        else:
            out[-1] += text[run:b]
            run = b
    return " ".join(out)


def brute_windows(rows, w=35):
    from collections import Counter
    split = {i: test_llm_substring.words_of(t) for i, t in rows.items()}
    count = Counter(tuple(x[k:k + w]) for x in split.values() for k in range(len(x) - w + 1))
    out = {}
    for i, x in split.items():
        gone = {p for k in range(len(x) - w + 1) if count[tuple(x[k:k + w])] > 1 for p in range(k, k + w)}
        out[i] = brute_without(rows[i], gone) if gone else rows[i]
    return out


def test_stages_equal_brute_force(spark, tmp_path):
    rows = documents()
    data = [(i, t, "en", "src", len(t or "")) for i, t in rows.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want = {i: t for i, t in rows.items() if op1_quality.measure((t or "").encode())[-1]}
    steps = []
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / f"stage{len(steps)}")
        out.write.parquet(path)
        last, docs = docs, spark.read.parquet(path)
        steps.append(name)
        got = {r.doc_id: r.text for r in docs.collect()} if name != "packing" else None
        if name == "MinHash near-dedup":
            groups = test_llm_minhash.brute(list(want.items()))
            want = {i: t for i, t in want.items() if groups[i][1] == i}
        elif name == "substring dedup":
            want = brute_windows(want)
        elif name == "PII":
            field = op7_pii.train(last)
            want = {i: op7_pii.redacted(t, field.spans(t)[1]) for i, t in want.items()}
            assert not any("@" in t for t in want.values())
        if got is not None:
            assert got == want, name
            assert docs.schema == spark.read.parquet(str(tmp_path / "documents.parquet")).schema
    assert 40 in want and 41 not in want and 12 not in want
    t = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in want.items()}
    check_pieces([(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in docs.collect()], ids)
    assert pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == len(want)


def test_sql_equals_brute_force():
    con = duckdb.connect()
    rows = [(i, t) for i, t in documents().items() if i not in (10, 17)]
    con.sql("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    import hashlib
    words = sorted((a, b, c, hashlib.sha256(d.encode()).hexdigest()) for a, b, c, d in test_llm_substring.brute_words(rows))
    assert sorted(con.sql(oracle.SUBSTRING_SQL).fetchall()) == words
    assert sorted(con.sql(oracle.SUFFIX_SQL).fetchall()) == sorted(test_llm_substring.brute_bytes(rows))
    near = test_llm_minhash.brute(rows)
    assert sorted(con.sql(oracle.NEAR_SQL).fetchall()) == sorted((i, n, c, i == c) for i, (n, c) in near.items())

    class Page:
        def __init__(self, page_id, html):
            self.page_id, self.html = page_id, html

    pages = [(1, "a"), (2, "a"), (3, ""), (4, None), (5, "é" * 99), (6, "a")]
    con.sql("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, 'u', ?)", pages)
    assert sorted(con.sql(oracle.WARC_SQL).fetchall()) == sorted(test_llm_warc.want([Page(*p) for p in pages]))


def test_near_dedup_stage_takes_pairs_from_80_percent(spark):
    rows = {}
    for group, changes in enumerate((3, 4, 5)):  # of 200 shingles 185, 180 and 175 stay: 0.86, 0.82 and 0.78
        base = llm_data.words(204, 70 + group, 50_000)
        near = [f"other{k}" if k % 30 == 15 and k < 30 * changes else w for k, w in enumerate(base)]
        rows |= {10 * group: " ".join(base), 10 * group + 1: " ".join(near)}
    sets = {i: test_llm_minhash.shingle_set(t) for i, t in rows.items()}
    dropped = {b for a in rows for b in rows if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert dropped == {1, 11}
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in pipeline.near_dedup(spark, docs, "").collect()} == set(rows) - dropped


def test_one_of_each_repeated_row_stays(spark):
    """Brute force by row: of rows with equal id and text one goes on, and substring dedup then leaves its text alone."""
    base, other = " ".join(llm_data.words(120, 91, 5000)), " ".join(llm_data.words(120, 92, 5000))
    rows = [(1, base, "en", "b", 9), (1, base, "en", "a", 9), (1, base, "en", "a", 9), (2, other, "de", "s", 1), (3, base + " x", "de", "s", 1),
            (None, other, "en", "s", 2), (None, other, "en", "s", 2), (None, None, "en", "s", 2), (None, "", "en", "s", 2), (None, None, "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = pipeline.near_dedup(spark, docs, "")
    got = sorted(map(str, near.collect()))
    gone = {i for i, (_, c) in test_llm_minhash.brute([(r[0], r[1]) for r in rows[:5]]).items() if i != c}
    least = {}
    for r in rows:
        if r[0] not in gone or r[0] is None:
            least[r[:2]] = min(least.get(r[:2], r), r, key=lambda x: x[2:])
    assert len(got) == len(least) and near.columns == docs.columns
    alone = pipeline.near_dedup(spark, docs.where("doc_id = 1"), "")
    assert [(r.doc_id, r.text, r.source) for r in alone.collect()] == [(1, base, "a")]
    path = f"{tempfile.mkdtemp(prefix='pipe-test-')}/stage"
    alone.write.parquet(path)
    assert [r.text for r in pipeline.substring_dedup(spark, spark.read.parquet(path), "").collect()] == [base]
