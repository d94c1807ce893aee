import hashlib
import os
import random
import re
import sys
import time

sys.path.insert(0, os.path.dirname(__file__))
import llm_data

from polyeval.llm import op7_pii as p

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        spans = []
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and p.luhn(d)):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            spans.append(m.span())
        out[kind] = spans
    return out


def test_base_patterns_on_random_texts():
    r = random.Random(3)
    parts = ["a", "b.", "@", "1", "25", "4", "0", ".", "..", "-", " ", "+", "(", ")", "é", "x@y.z", "1.2.3.4", "4111111111111111",
             "+1 (988) 555-2485", "\n", "٣"]
    for _ in range(20000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 18)))
        assert p.base_spans(t) == plain(t), t


def test_long_runs_take_linear_time():
    t = "1" * 200_000 + " " + "a" * 200_000 + "@" + "b" * 100_000 + " +1" + "(" * 100_000 + " " + "1." * 50_000 + "a@" * 50_000
    start = time.time()
    p.base_spans(t)
    p.signal_tokens(t)
    assert time.time() - start < 20


PRIVATE = {
    50: "Mail john.smith7@mail.com or ask john.smith7 later, said john.smith7.",
    51: "Card 4111 1111 1111 1111 then again 4111.1111.1111.1111 and 4111111111111111",
    52: "from 10.0.0.1 to 10.0.0.256, call +1 (988) 555-2485 4532015112830366 soon",
    53: "version 1.2.3 of 2024-01-02, 12345 items at 3.14 for user@localhost é 10.1.2.3",
}


def test_query_columns_and_added_spans(spark):
    rows = llm_data.texts() | PRIVATE | {100 + i: f"call 453201511283036{i % 10} or 4111111111111111 now" for i in range(30)}
    df = llm_data.frame(spark, rows)
    field = p.train(df)
    got = p.find(df, field=field).collect()
    assert len(got) == df.count()
    for r in got:
        base = plain((rows | {None: "no id here"})[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(base[k]) for k in p.KINDS)
        listed = p.listed(base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(filter(None, r.spans.split(",")))
    spans = {r.doc_id: r.spans for r in got}
    text = PRIVATE[50]
    for m in re.finditer("john.smith7", text):  # repeats of what a base span names
        assert any(int(a) <= m.start() and m.end() <= int(b) for _, a, b in (x.split(":") for x in spans[50].split(",")))
    assert not spans[0] and not spans[10] and not spans[12]  # clean documents stay clean
    assert p.find(llm_data.empty(spark)).count() == 0


def test_redaction(spark):
    df = llm_data.frame(spark, {0: PRIVATE[50], 1: None, 2: "", 3: "clean text"})
    out = {r.doc_id: r.text for r in p.redact(df).collect()}
    assert "@" not in out[0] and "<EMAIL>" in out[0]
    assert out[1] is None and out[2] == "" and out[3] == "clean text"
    assert p.redact(df).schema == df.schema
    assert p.redacted("ab cd", {"email": [(0, 4)], "ip": [(1, 5)], "card": [], "phone": []}) == "<EMAIL>"


def test_repeats_are_found_however_many():
    trained = [("s01", 0, 900_000), ("s01", 1, 40), ("s40", 0, 50_000), ("s42a", 0, 70_000), ("s10", 0, 2_000_000),
               ("t0", 0, 900_000), ("t0", 1, 3), ("t1", 0, 3), ("t1", 1, 900), ("t3", 3, 500), ("t4", 4, 5000), ("t0", 4, 200)]
    ways = (lambda base, x, n: f"write {base}" + f" and then ({x})," * n, lambda base, x, n: f"{base} is " + " ".join([x] * n),
            lambda base, x, n: f"write {base}\n" + "\n".join(f"{i} {x} 12:{i:02d}" for i in range(n)))
    items = (("email", "john.smith7@mail.com", "john.smith7"), ("email", "mailto:john.smith7@mail.com", "John.Smith7"),
             ("card", "4111111111111111", "4111.1111.1111.1111"), ("ip", "10.200.30.40", "10.200.30.40:"))
    for field in (p.Field([]), p.Field(trained)):
        for kind, base, x in items:
            for way in ways:
                for n in (1, 2, 3, 10, 100, 1000):
                    text = way(base, x, n)
                    found = field.spans(text)[1][kind]
                    bare, after = x.rstrip(":"), text.index(base) + len(base)
                    want = {(m.start(), m.end()) for m in re.compile(re.escape(bare)).finditer(text, after)}
                    assert len(want) == n and want <= set(found), (kind, n, text[:80])


def test_other_numbers_stay_beside_many_repeats():
    field = p.Field([("s10", 0, 1000), ("t0", 0, 1000), ("t0", 1, 50), ("t1", 0, 50)])
    text = "write john.smith7@mail.com now\n" + "\n".join(f"row {i} of john.smith7 total {i}" for i in range(100))
    base, every = field.spans(text)
    assert [text[a:b] for a, b in every["email"]] == ["john.smith7@mail.com"] + ["john.smith7"] * 100
    assert not every["ip"] and not every["card"] and not every["phone"]


def test_marginals_against_enumeration():
    """On graphs without cycles the messages give the exact marginals: all labellings are summed."""
    import itertools

    import numpy as np

    from polyeval.llm import op7_pii as p
    r = np.random.default_rng(4)
    field = p.Field([])
    for edges in ([], [(0, 1, 0)], [(0, 1, 0), (1, 2, 0), (2, 3, 0)], [(0, 4, 1), (1, 4, 1), (2, 4, 1), (2, 3, 0)], [(0, 1, 0), (3, 2, 1), (1, 4, 1), (1, 2, 0)]):
        node, potentials = r.normal(size=(5, 3)) * 2, r.normal(size=(2, 3, 3))
        want = np.zeros((5, 3))
        for labels in itertools.product(range(3), repeat=5):
            weight = np.exp(sum(node[i, y] for i, y in enumerate(labels)) + sum(potentials[k, labels[a], labels[b]] for a, b, k in edges))
            want[np.arange(5), labels] += weight
        want /= want.sum(axis=1, keepdims=True)
        ends = [np.array([e[k] for e in edges], dtype=np.int64) for k in (0, 1)]
        got = field.marginals(node, *ends, np.array([e[2] for e in edges], dtype=np.int8), potentials)
        assert np.abs(got - want).max() < 1e-3


def test_blocks_of_edges_change_nothing(monkeypatch):
    from polyeval.llm import op7_pii as p
    field = p.Field([("s9.9", 0, 50), ("s9-9", 4, 9), ("t0", 0, 20), ("t4", 0, 3)])
    text = " ".join(["call +49 30 1234567 now, or mail jo.doe-77@mail.com;", "12.5 jo.doe-77 17.25 4111 1111 1111 1111", "jo.doe-77 9-9 8-8"] * 40)
    whole = field.spans(text)
    monkeypatch.setattr(p, "EDGES_AT_ONCE", 7)
    assert field.spans(text) == whole
