import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))
import llm_data

from polyeval.llm import op1_quality as q

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    w = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    three = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = set()
    for i in range(len(w) - 2):
        if three[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed)


def test_base_columns_equal_brute_force(spark):
    df = llm_data.frame(spark)
    got = q.quality(df).collect()
    assert len(got) == df.count()
    want = llm_data.texts() | {None: "no id here"}
    for r in got:
        assert tuple(r)[1:6] + (r.base_failed,) == brute(want[r.doc_id]), r
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert kept[0] and kept[10] and not kept[12] and not kept[15] and not kept[3]
    assert q.quality(llm_data.empty(spark)).count() == 0


def test_filter_keeps_rows_and_columns(spark):
    df = llm_data.frame(spark)
    out = q.filter_quality(df)
    assert out.schema == df.schema
    verdict = {r.doc_id: r.kept for r in q.quality(df).collect()}
    assert sorted(r.doc_id for r in out.collect()) == sorted([i for i, k in verdict.items() if k] + [0])


def test_repetition_is_rejected_and_one_repeated_line_is_not():
    clean = " ".join(llm_data.words(200, 9))
    block = " ".join(llm_data.words(40, 10))
    assert q.measure(f"{clean}\nAll rights reserved here.\n{clean[:300]}x\nAll rights reserved here.".encode())[-1]
    assert not q.measure(f"{clean} {block} {block} {block} {block} {block} {block}".encode())[-1]


def test_published_limits_hold_for_longer_texts():
    own, passage = llm_data.words(1600, 12, 5000), llm_data.words(200, 13, 5000)
    lines = [" ".join(llm_data.words(12, 100 + i, 5000)) for i in range(100)]
    planted = " ".join(own[:800] + passage + own[800:] + passage + passage)  # a fifth of the words are in later repeats
    assert not q.measure(planted.encode())[-1]
    assert q.measure(" ".join(own + passage).encode())[-1]
    assert not q.measure("\n".join(lines + lines[:45]).encode())[-1]  # 31 % of the lines
    assert not q.measure("\n".join(lines + [f"{i} {lines[0]}" for i in range(25)]).encode())[-1]
    notice = " ".join(llm_data.words(20, 14))
    for n in (60, 100, 300, 1000, 10_000):  # one line held twice rejects no text
        text = "\n".join([notice] + [" ".join(own[:n][i:i + 15]) for i in range(0, n, 15)] + [notice])
        assert q.measure(text.encode())[-1], n
