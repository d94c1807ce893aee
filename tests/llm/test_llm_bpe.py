import hashlib
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import llm_data

from polyeval.llm import op2_bpe as b

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    path = P.path("byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return b.Codec(b.read_file(path)), t


def test_equals_the_library_on_hard_texts(both):
    c, t = both
    r = random.Random(0)
    parts = [*" \n\t  abcde'stll.,!1239éß中文😀́\x85\xa0​\x1c ", "<|endoftext|>", "the", "  ", "\n\n", "1st", "'ve", "aaaa", " \n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += ["a" * 3000, " " * 500, "\n" * 501, "ab" * 700, "é" * 300, "!" * 257]
    for s, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert c.encode(s) == e.ids, s
        assert c.decode(e.ids) == t.decode(e.ids, skip_special_tokens=False)


def test_a_small_automaton_by_hand():
    # merges: a a, aa b, b c -> ids 3, 4, 5
    a = b.Automaton({b"a": 0, b"b": 1, b"c": 2}, [(0, 0, 3), (3, 1, 4), (1, 2, 5)],
                    {0: b"a", 1: b"b", 2: b"c", 3: b"aa", 4: b"aab", 5: b"bc"})
    assert a.run(b"aaa") == [3, 0]  # leftmost pair first
    assert a.run(b"aabc") == [4, 2]  # aa b before b c
    assert a.run(b"abc") == [0, 5]
    assert a.run(b"aaaaab") == [3, 3, 0, 1]


def test_query_columns(spark, both):
    c, t = both
    path = P.path("byte_bpe_50k.json")
    df = llm_data.frame(spark)
    got = b.round_trip(df, path).collect()
    assert len(got) == df.count()
    want = llm_data.texts() | {None: "no id here"}
    for r in got:
        text = want[r.doc_id] or ""
        ids = t.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert b.round_trip(llm_data.empty(spark), path).count() == 0
    back = b.decode_ids(b.encode(df, path), path)
    assert back.where("coalesce(text, '') <> decoded").count() == 0
    assert set(df.columns) < set(back.columns)
