import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))
import llm_data
import numpy as np

from polyeval.llm import op5_minhash as m
from polyeval.llm.components import components


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: (len(s), top(i)) for i, s in sets.items()}


def test_groups_chains_and_copies(spark):
    r = random.Random(7)
    base = llm_data.words(300, 11, 5000)
    rows, now = dict(llm_data.texts()), list(base)
    for i in range(40):  # a chain whose ends are far apart, and copies
        rows[100 + i] = " ".join(now)
        rows[200 + i] = " ".join(now).upper()
        for _ in range(3):
            now[r.randrange(len(now))] = f"new{r.random()}"
    for i in range(30):  # many near copies, most under the threshold
        own = list(base)
        for _ in range(r.randrange(1, 40)):
            own[r.randrange(len(own))] = f"own{r.random()}"
        rows[300 + i] = " ".join(own)
    df = llm_data.frame(spark, rows)
    got = m.near_duplicates(df).collect()
    assert len(got) == df.count()
    want = brute(list(rows.items()))
    for x in got:
        if x.doc_id is None:
            assert x.component_id is None and x.kept
        else:
            assert (x.n_shingles, x.component_id) == want[x.doc_id], x
            assert x.kept == (x.doc_id == x.component_id)
    assert m.near_duplicates(llm_data.empty(spark)).count() == 0


def test_recall_at_the_threshold():
    r = np.random.default_rng(0)
    met = 0
    for _ in range(2000):
        inter, only = 170, 15
        x = m.mix64(r.integers(1, 1 << 62, inter + 2 * only).astype(np.uint64))
        a, b = np.unique(x[:inter + only]), np.unique(np.concatenate((x[:inter], x[inter + only:])))
        (la, ra), (lb, rb) = m.signature(a, m.SIDE, m.SMALL), m.signature(b, m.SIDE, m.SMALL)
        met += bool((la == lb).any() and (ra == rb).any())
    assert met >= 1999


def test_sketches_pass_pairs_at_the_threshold_and_stop_others():
    r = np.random.default_rng(1)

    def passed(percent, inter, only):
        n = 0
        for _ in range(2000):
            x = r.integers(1, 1 << 48, inter + 2 * only).astype(np.uint64)
            apart = m.sketch(x[:inter + only]) ^ m.sketch(np.concatenate((x[:inter], x[inter + only:])))
            n += sum(((int(v) >> k) & 3) > 0 for v in apart.view(np.uint64) for k in range(0, 64, 2)) <= m.most_apart(percent)
        return n
    assert passed(85, 170, 15) >= 1999 and passed(80, 160, 20) >= 1999
    assert passed(85, 120, 40) <= 20


def test_a_template_under_the_threshold_makes_few_pairs(spark, monkeypatch):
    r = random.Random(3)
    template, variants = llm_data.words(200, 21, 9000), [llm_data.words(12, 500 + i, 9000) for i in range(40)]
    rows = {}
    for i in range(300):
        own = list(template)
        for k, v in enumerate(r.sample(variants, 6)):
            own[(k + 1) * 30:(k + 1) * 30] = v
        rows[i] = " ".join(own)
    for i in range(300, 306):  # true links
        rows[i] = rows[i - 300] + " one more word"
    made, confirm = [], m.verified
    monkeypatch.setattr(m, "verified", lambda pairs, sets, percent: made.append(pairs.count()) or confirm(pairs, sets, percent))
    got = {x.doc_id: x.component_id for x in m.near_duplicates(llm_data.frame(spark, rows, repeat=False)).collect()}
    assert {i: got[i] for i in got} == {i: c for i, (_, c) in brute(list(rows.items())).items()}
    assert sum(made) <= 3 * len(rows), made


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 1000 for i in range(1000, 1100))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
