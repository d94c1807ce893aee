import os
import random
import sys
import zlib
from array import array
from collections import defaultdict

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import llm_data

from polyeval.llm import op3_packing as p

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = P.path("word_bpe_49k.json")


def check_pieces(rows, want):
    """rows: (key, start, length, crc, total, sequence, offset)."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r[0]].append(r)
        sequences[r[5]].append(r)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r[6]):
            assert r[6] == at and r[2] > 0
            at += r[2]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    for key, ids in want.items():
        at = 0
        for r in sorted(docs[key], key=lambda r: r[1]):
            assert r[1] == at and r[4] == len(ids)
            assert r[3] == zlib.crc32(array("I", ids[at:at + r[2]]).tobytes())
            at += r[2]
        assert at == len(ids)
    assert set(docs) == set(want)
    return padding


def test_words_as_the_library():
    t = tokenizers.Tokenizer.from_file(PATH)
    w = p.WordIds(open(PATH, "rb").read())
    r = random.Random(0)
    parts = [*" \n\t  abcde'stlLEÉ.,!1239éß中文😀́\x85\xa0​\x1cΣσςİǅﬁªµ×÷Å", "<|endoftext|>", "<|ENDOFTEXT|>", "the", "'RE", " ́"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    got = w.encode([x.encode() for x in texts])
    for s, ids, e in zip(texts, got, t.encode_batch(texts, add_special_tokens=False)):
        assert ids == array("I", e.ids).tobytes(), s


def test_pieces_cover_every_document(spark):
    t = tokenizers.Tokenizer.from_file(PATH)
    df = llm_data.frame(spark, repeat=False)
    rows = p.pieces(p.pack(df, PATH)).collect()
    want = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in llm_data.texts().items()}
    tasks = df.rdd.getNumPartitions()
    assert check_pieces([(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in rows], want) <= 2048 * tasks
    assert p.pack(llm_data.empty(spark), PATH).count() == 0
    both = p.pack(llm_data.frame(spark), PATH).where("doc_id = 0 and start = 0").count()
    assert both == 2  # a repeated row is a document of its own


def test_rounds_tiers_and_step_groups():
    r = random.Random(4)
    packer, rows, want = p.Packer(1), [], {}
    for i in range(3000):
        ids = [r.randrange(40000) for _ in range(min(20000, int(r.paretovariate(0.9) * 20)))]
        want[i] = ids
        packer.add(i, array("I", ids).tobytes())
        if packer.held >= 1 << 16:
            rows += packer.pack()
    rows += packer.pack(last=True)
    assert check_pieces([(k, s, n, zlib.crc32(x), t, q, o) for k, s, n, x, t, q, o, _, _ in rows], want) < 2048
    size, step = defaultdict(int), defaultdict(set)
    for row in rows:
        size[row[5]] += row[2]
        step[row[8]].add((row[5], row[7]))
    for group in step.values():  # one tier a group, within the step's tokens
        assert len({tier for _, tier in group}) == 1
        assert sum(tier for _, tier in group) <= packer.step_tokens
    full = [s for s in size.values() if s in p.TIERS]
    assert len(full) >= len(size) - 1
