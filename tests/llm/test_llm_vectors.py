import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyeval.llm import op12_whitening as w
from polyeval.llm import op13_negatives as h

SCHEMA = "vec_id long, embedding array<double>, label int, n long, v double, component string, slot string, id long, cell int"
ODD = [None, [1.0, None, 2.0], [1.0, float("nan"), 0.0], [float("inf"), 0.0, 0.0]]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 1.0, "c", "s", 1, 1) for i, v, label in rows], SCHEMA)


def vectors(n, width, seed=0):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, width)) @ r.normal(size=(width, width)) * 0.05).tolist()


# ---------------------------------------------------------------- whitening

def sound(rows):
    return [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def check_whitened(got, rows, components):
    kept = sound(rows)
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    values, vecs = np.linalg.eigh(np.cov(x.astype(float).T, bias=True))
    values, vecs = values[::-1], vecs[:, ::-1]
    want = (x.astype(float) - sums.astype(float) / n) @ vecs[:, :components] / np.sqrt(values[:components])
    deviations = [sum(int(n * a - b) ** 2 for a, b in zip(r, sums)) for r in x]
    assert len(got) == n * components and {r.n for r in got} == {n}
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    signs = np.ones(components)
    for at, (i, _) in enumerate(kept):
        for c in range(components):
            r = by_id[i][c + 1]
            if at == 0:
                signs[c] = np.sign(r.whitened * want[0, c])
            assert r.whitened * signs[c] == pytest.approx(want[at, c], rel=1e-7, abs=1e-7)
            assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
            assert int(r.deviation_exact or r.deviation) == deviations[at]
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_against_numpy(spark):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(700, 11))] + [(1000 + i, (x + [0.0] * 8)[:11] if x else None, 1) for i, x in enumerate(ODD)]
    df = frame(spark, rows).repartition(5, "vec_id")
    check_whitened(w.whiten(df).collect(), rows, 8)
    check_whitened(w.whiten(frame(spark, [(i, v, 0) for i, v in enumerate(vectors(300, 3))])).collect(), [(i, v, 0) for i, v in enumerate(vectors(300, 3))], 3)


def test_moments_are_exact(spark, monkeypatch):
    monkeypatch.setattr(w, "BLOCK_ENTRIES", 100)
    r = random.Random(1)
    rows = [[r.choice([r.uniform(-1, 1), r.uniform(-1e6, 1e6), 3e12, -7e14]) for _ in range(4)] for _ in range(500)]
    m = w.moments(w._rows(frame(spark, [(i, v, 0) for i, v in enumerate(rows)]).repartition(3), "vec_id", "embedding"), 4)
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in rows]
    assert (m.n, m.sums) == (500, [sum(c) for c in zip(*x)])
    assert m.products == [[sum(a[i] * a[j] for a in x) for j in range(4)] for i in range(4)]


def test_plane_products():
    x = np.array([[0, 5, 1023], [7, 0, 1], [2, 2, 512]], dtype=np.uint64)
    sums, products = w.plane_products(w.bit_planes(x))
    assert sums.tolist() == x.astype(int).sum(axis=0).tolist() and products.tolist() == (x.astype(int).T @ x.astype(int)).tolist()
    for x in (np.array([[w.whole_numbers(np.array([1e300]), 1024)[0], -5]]), np.array([[-(1 << 62), 1 << 62], [1 << 62, -(1 << 62)]])):
        sums, products = w.block_moments(x)
        rows = [[int(c) for c in r] for r in x]
        assert sums.tolist() == [sum(c) for c in zip(*rows)]
        assert products.tolist() == [[sum(r[i] * r[j] for r in rows) for j in range(2)] for i in range(2)]


def test_deviation_beyond_a_long(spark):
    rows = [(0, [1e13, 0.0], 0), (1, [-1e13, 0.5], 0), (2, [0.25, 0.25], 0)]
    got = w.whiten(frame(spark, rows)).collect()
    assert {r.deviation for r in got if r.vec_id < 2} == {None}
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v, _ in rows]
    s = [sum(c) for c in zip(*x)]
    assert {int(r.deviation_exact or r.deviation) for r in got if r.vec_id == 0} == {sum((3 * a - b) ** 2 for a, b in zip(x[0], s))}


def test_whitening_cases(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]
    for rows in ([], [(1, [0.1, 0.2], 0)], [(i, [0.1, 0.2], 0) for i in range(9)], [(1, None, 0)], [(1, [], 0), (2, [], 0)]):
        out = w.whiten(frame(spark, rows))
        assert out.columns == names and out.count() == 0
    rank = w.whiten(frame(spark, [(i, v, 0) for i, v in enumerate(vectors(4, 6))])).collect()  # four rows have rank three
    assert {r.component for r in rank} == {1, 2, 3} and rank[0].identity_error < 1e-9
    ragged = [(None, [0.5, 0.25], 0), (None, [0.5, 0.25], 0), (3, [0.75], 0), (4, [0.1, 0.9], 0)]
    got = w.whiten(frame(spark, ragged)).collect()
    assert sorted((r.vec_id or 0) for r in got) == [0] * 4 + [3] * 2 + [4] * 2  # repeated rows and null ids stay
    filled = w.whiten(frame(spark, [(i, (v + [0.0])[:2], 0) for i, v, _ in ragged])).collect()
    assert sorted(map(str, got)) == sorted(map(str, filled))


# ---------------------------------------------------------------- hard negatives

def brute(rows, scale=256, positives=5, negatives=5, step=100):
    kept = []
    for i, v, label in rows:
        if label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(scale * c) for c in v], label))
    asked = {(i, tuple(v), label) for i, v, label in kept if i is not None and i % step == 0}
    last = float("inf")
    out = []
    for a, x, label in asked:
        scored = sorted(((sum(p * q for p, q in zip(x, v)), i, own) for i, v, own in kept if i != a),
                        key=lambda t: (-t[0], last if t[1] is None else t[1]))
        for s, i, _ in [t for t in scored if t[2] == label][:positives]:
            inside = [t for t in scored if t[2] != label and 80 * s <= 100 * t[0] <= 100 * s][:negatives]
            out += [(a, i, k, t[1], s, t[0]) for k, t in enumerate(inside, 1)]
    return out


def rows_of(df):
    return sorted(((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=str)


def sample(n, width=9, seed=3):
    r = random.Random(seed)
    rows = [(i, [x + 0.3 for x in v], r.randrange(4)) for i, v in enumerate(vectors(n, width, seed))]
    rows += [(n + i, rows[1][1], r.randrange(4)) for i in range(40)]  # ties
    rows += [(None, rows[0][1], 1), (None, rows[0][1], 2), (n + 50, [0.0] * width, 1), (n + 51, rows[2][1], None)]
    rows += [rows[100], rows[100], (100, rows[5][1], 3)]  # a repeated anchor, and another of the same id
    return rows + [(n + 60 + i, (v + [0.0] * width)[:width] if v else None, 1) for i, v in enumerate(ODD)] + [(n + 70, [0.4] * (width - 3), 2)]


@pytest.mark.parametrize("entries", [h.BLOCK_ENTRIES, 200])
def test_negatives_against_brute_force(spark, monkeypatch, entries):
    monkeypatch.setattr(h, "BLOCK_ENTRIES", entries)  # 200: many blocks of anchors and of rows
    rows = sample(600)
    df = frame(spark, rows).repartition(3)
    every = 20 if entries == 200 else 100
    got = rows_of(h.mine(df, F.col("vec_id") % every == 0))
    assert got == sorted(brute(rows, step=every), key=str) and len(got) > 100


def test_negatives_cases(spark):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"]
    for rows in ([], [(0, [0.5], None)], [(1, [0.5], 1), (2, [0.5], 1)], [(0, [0.5], 1)], [(0, [], 1), (1, [], 1), (2, [], 2)]):
        out = h.mine(frame(spark, rows), F.col("vec_id") % 100 == 0)
        assert out.columns == names and rows_of(out) == sorted(brute(rows), key=str)
    far = [(0, [1e30, 1.0], 1), (100, [0.5, 0.5], 1), (2, [0.5, 0.25], 1), (3, [0.4, 0.4], 2)]
    assert rows_of(h.mine(frame(spark, far), F.col("vec_id") % 100 == 0)) == sorted(brute(far[1:]), key=str)  # its scores don't fit a long


def test_scores_are_exact():
    r = np.random.default_rng(5)
    for width, size in ((1, 3), (64, 200), (300, 5000), (700, 1 << 23)):
        a, b = r.integers(-size, size, (5, width)), r.integers(-size, size, (40, width))
        bound = int(max((a * a).sum(axis=1).max(), (b * b).sum(axis=1).max()))
        assert bound < h.NORM_BOUND
        got = h.Scores(b, a, h.primes_for(bound)).of(0, 5)
        assert got.tolist() == (a.astype(object) @ b.astype(object).T).tolist()
    for p in h.primes():
        assert (h.EXACT // (p // 2) ** 2) * (p // 2) ** 2 <= h.EXACT and all(p % d for d in range(2, p))
    most = h.primes_for(h.NORM_BOUND)
    assert math.prod(most) < 1 << 63
