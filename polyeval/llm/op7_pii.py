"""Personal data by base patterns and a skip-chain conditional random field.

Base patterns find emails, ip addresses, card and phone numbers; their spans always
stay. The field then labels tokens (O or a kind). Its nodes are the tokens with a
digit, ``@`` or ``+``, and the tokens that repeat or resemble what a base span
names (same letters and digits without signs around them, same digits in another
notation, or an email's local part). Any other token has no evidence and is O. Edges:

* neighbouring nodes, with transition potentials;
* each node and the entity of its key, one variable for all tokens that share keys,
  however many and distant, with a potential for equal labels.

An entity that a base span names has the label that most of its base spans give it,
and its tokens are held to that as a base span's are, so that the weak potentials of
many repeats never add up against it; other entities have no evidence of their own.

Node and transition potentials are trained on the whole table: Spark counts, over
all documents, how often each token shape carries each label of the base patterns,
and the labels of neighbouring nodes; a bounded number of counts (shapes times
labels) comes to the driver. Loopy sum-product message passing with damping runs
per document until no message changes, ``ROUNDS`` rounds at most; a token whose best
label isn't O with probability ``SURE`` adds a span.

Everything is per document in two passes over the table; edges are linear in a
document's tokens. Patterns are matched in linear time for any text.

Defined cases: a null or empty text has no spans; rows are independent, so repeated
rows each give a row; an empty table trains to no evidence and gives no rows; other
columns pass through ``redact`` unchanged.
"""

from __future__ import annotations

import hashlib
import re
import warnings
from array import array
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.llm.common import arrow_map, bounded_batches, decode, utf8

KINDS = ("email", "ip", "card", "phone")
SKIP_WEIGHT = 10.0  # log potential of equal labels of a token and its entity
PINNED = 25.0  # log potential of a base span's kind on its tokens and their repeats
MOST_EVIDENCE = 4.0  # bound of trained log potentials, so that they mean the same at any table size
NO_EVIDENCE = -3.0  # log potential of a kind on a token without a trained shape
SURE = 0.9
EDGES_AT_ONCE = 1 << 16
ROUNDS = 1000
SMOOTHING = 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@+]")
_SPACE = re.compile(r"\s")
_TOKEN = re.compile(r"\S+")


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start, following = at, at + 1
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = following = domain.end()
            out.append((start, done))
        at = text.find("@", following)
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping matches of each kind; failing ones are dropped."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if _SIGNAL.search(text):
        out["ip"] = [m.span() for m in _IP.finditer(text)
                     if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        out["card"] = [m.span() for m in _CARD.finditer(text)
                       if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def signal_tokens(text: str) -> list[tuple[int, int]]:
    """White-space tokens with a digit, ``@`` or ``+``."""
    out, end = [], 0
    while m := _SIGNAL.search(text, end):
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        stop = _SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        out.append((start, end))
    return out


def shape(token: str) -> str:
    """What the trained potentials know of a token: one of a fixed number of values."""
    digits = _digits(token)
    n = len(digits)
    size = "0" if not n else "1" if n < 4 else "2" if n < 9 else "3" if n < 13 else "4" if n < 20 else "5"
    marks = "".join(c for c in "@+(:=/" if c in token)
    return (f"{size}{min(token.count('.'), 4)}{marks}{'a' if any(c.isalpha() for c in token) else ''}"
            f"{'-' if '-' in token else ''}{'L' if 13 <= n <= 19 and luhn(digits) else ''}")


def _labels(tokens: list[tuple[int, int]], base: dict[str, list[tuple[int, int]]]) -> list[int]:
    """0, or 1 + the kind whose base span overlaps the token."""
    out = [0] * len(tokens)
    for k, kind in enumerate(KINDS):
        spans, j = base[kind], 0
        for i, (a, b) in enumerate(tokens):
            while j < len(spans) and spans[j][1] <= a:
                j += 1
            if j < len(spans) and spans[j][0] < b and not out[i]:
                out[i] = k + 1
    return out


def _adjacent(text: str, tokens: list[tuple[int, int]]) -> list[bool]:
    """Whether only one white-space character stands before each token and its predecessor."""
    return [i > 0 and tokens[i][0] - tokens[i - 1][1] == 1 for i in range(len(tokens))]


def counts(text: str) -> Counter:
    """Shape-label and label-label counts of one text."""
    tokens = signal_tokens(text)
    labels = _labels(tokens, base_spans(text)) if tokens else []
    found = Counter((f"s{shape(text[a:b])}", y) for (a, b), y in zip(tokens, labels))
    found.update((f"t{labels[i - 1]}", labels[i]) for i, near in enumerate(_adjacent(text, tokens)) if near)
    return found


class Field:
    """The trained potentials."""

    def __init__(self, counted: list[tuple[str, int, int]]):
        n = len(KINDS) + 1
        shapes: dict[str, np.ndarray] = {}
        steps = np.full((n, n), SMOOTHING)
        for name, label, count in counted:
            if name[0] == "t":
                steps[int(name[1:]), label] += count
            else:
                shapes.setdefault(name[1:], np.full(n, SMOOTHING))[label] += count
        self.shapes = {k: np.clip(np.log(v / v[0]), -MOST_EVIDENCE, MOST_EVIDENCE) for k, v in shapes.items()}
        # how much more often two labels meet than their shares say
        joint = steps / steps.sum()
        self.steps = np.clip(np.log(joint / np.outer(joint.sum(1), joint.sum(0))), -MOST_EVIDENCE, MOST_EVIDENCE)
        self.unknown = np.array([0.0] + [NO_EVIDENCE] * len(KINDS))

    def marginals(self, node: np.ndarray, left: np.ndarray, right: np.ndarray, kind: np.ndarray, potentials: np.ndarray) -> np.ndarray:
        """Loopy sum-product: ``node`` (n, labels) and ``potentials`` (kinds, labels, labels) are
        logarithms; ``left``, ``right`` and ``kind`` are the edges' ends and which potential they have. All
        messages of a round follow from those of the round before. An edge costs its two messages; its
        potential is shared, and a round goes over the edges in blocks. Without convergence
        after ``ROUNDS`` rounds the text is named in a warning."""
        if not len(left):
            return _normal(node)
        both = np.exp(potentials)
        there, back = np.zeros((len(left), node.shape[1])), np.zeros((len(left), node.shape[1]))  # to the right ends, to the left ones
        for turn in range(ROUNDS + 1):
            belief = node.copy()
            np.add.at(belief, right, there)
            np.add.at(belief, left, back)
            if turn == ROUNDS:
                warnings.warn(f"no convergence of {len(node)} variables and {len(left)} edges", RuntimeWarning, stacklevel=2)
                break
            change = 0.0
            for i in range(0, len(left), EDGES_AT_ONCE):
                at = slice(i, i + EDGES_AT_ONCE)
                ahead, behind = _message(belief[left[at]] - back[at], kind[at], both), _message(belief[right[at]] - there[at], kind[at], both.transpose(0, 2, 1))
                change = max(change, np.abs(ahead - there[at]).max(), np.abs(behind - back[at]).max())
                there[at] = 0.5 * there[at] + 0.5 * ahead
                back[at] = 0.5 * back[at] + 0.5 * behind
            if change < 1e-4:
                belief = node.copy()
                np.add.at(belief, right, there)
                np.add.at(belief, left, back)
                break
        return _normal(belief)

    def spans(self, text: str) -> tuple[dict, dict]:
        """Base spans, and all spans."""
        base = base_spans(text)
        tokens = signal_tokens(text)
        if not tokens:
            return base, base
        wanted = _named(text, base)
        if wanted:
            own = set(tokens)
            tokens = sorted(own | {m.span() for m in _TOKEN.finditer(text) if _keys(m[0]) & wanted})
        labels = _labels(tokens, base)
        entity = _entities(text, tokens, base)
        members, votes = Counter(entity), defaultdict(Counter)
        for e, y in zip(entity, labels):
            if y:
                votes[e][y] += 1
        held = {e: max(c, key=lambda y: (c[y], -y)) for e, c in votes.items() if e >= 0}
        n = len(KINDS) + 1
        node = np.stack([self.shapes.get(shape(text[a:b]), self.unknown) for a, b in tokens])
        pinned = np.array([y or held.get(e, 0) for e, y in zip(entity, labels)])
        node[np.arange(len(tokens)), pinned] += np.where(pinned > 0, PINNED, 0.0)
        steps, stars = np.flatnonzero(_adjacent(text, tokens)), {}
        own, tops = array("q"), array("q")
        for i, e in enumerate(entity):
            if e >= 0 and members[e] > 1 and e not in held:
                own.append(i)
                tops.append(stars.setdefault(e, len(tokens) + len(stars)))
        node = np.concatenate((node, np.zeros((len(stars), n))))
        left = np.concatenate((steps - 1, np.array(own, dtype=np.int64)))
        right = np.concatenate((steps, np.array(tops, dtype=np.int64)))
        kind = np.repeat(np.array([0, 1], dtype=np.int8), (len(steps), len(own)))
        p = self.marginals(node, left, right, kind, np.stack((self.steps, np.eye(n) * SKIP_WEIGHT)))
        best = p.argmax(axis=1)  # tokens first, then entities
        every = {k: list(v) for k, v in base.items()}
        for (a, b), y, row, label in zip(tokens, best.tolist(), p, labels):
            if y and not label and row[y] >= SURE:
                while a < b and not text[a].isalnum() and text[a] != "+":
                    a += 1
                while b > a and not text[b - 1].isalnum():
                    b -= 1
                if a < b:  # without a label, so no base span overlaps it
                    every[KINDS[y - 1]].append((a, b))
        return base, every


def _message(out: np.ndarray, kind: np.ndarray, both: np.ndarray) -> np.ndarray:
    """What goes along edges whose senders believe ``out`` (logarithms) without them."""
    out = np.exp(out - out.max(axis=1, keepdims=True))
    new = np.empty_like(out)
    for k, matrix in enumerate(both):
        new[kind == k] = out[kind == k] @ matrix
    new = np.log(new + 1e-300)
    return new - new.max(axis=1, keepdims=True)


def _normal(belief: np.ndarray) -> np.ndarray:
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _keys(token: str) -> set[str]:
    """What a token shares with one that repeats or resembles it."""
    bare = token.lower().strip(".,;:!?()[]{}<>\"'")
    out = {bare} if len(bare) >= 6 else set()
    if len(digits := _digits(bare)) >= 9:
        out.add(digits)
    local = bare.partition("@")[0]
    if len(local) >= 6 and any(not c.isalpha() for c in local):
        out.add(local)
    return out


def _named(text: str, base: dict) -> set[str]:
    return {k for spans in base.values() for a, b in spans for t in text[a:b].split() for k in _keys(t)}


def _entities(text: str, tokens: list[tuple[int, int]], base: dict) -> list[int]:
    """The entity of each token, -1 without a key: tokens that share a key, also by
    way of others, are one. A base span's words count as keys of the token they are in."""
    keys = [_keys(text[a:b]) or None for a, b in tokens]  # most tokens have none
    starts = [a for a, _ in tokens]
    for spans in base.values():
        for x, z in spans:
            for m in _TOKEN.finditer(text, x, z):
                i = bisect_right(starts, m.start()) - 1
                if i >= 0 and m.start() < tokens[i][1]:
                    keys[i] = (keys[i] or set()) | _keys(m[0]) or None
    first: dict[str, int] = {}
    top = list(range(len(tokens)))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    for i, own in enumerate(keys):
        for key in own or ():
            x, y = sorted((find(first.setdefault(key, i)), find(i)))
            top[y] = x
    return [find(i) if own else -1 for i, own in enumerate(keys)]


def train(df: DataFrame, text_col: str = "text") -> Field:
    """Potentials from counts over all texts of ``df``."""
    bounded_batches(df.sparkSession)
    src = df.select(utf8(text_col).alias("_t"))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        total: Counter = Counter()
        for x in b.column(0).to_pylist():
            total.update(counts(decode(x)))
        rows = [(name, y, c) for (name, y), c in total.items()]
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64()))],
                                          ["name", "label", "n"])

    rows = arrow_map(src, each, "name string, label int, n long").groupBy("name", "label").agg(F.sum("n").alias("n")).collect()
    return Field(sorted((r.name, r.label, r.n) for r in rows))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """One row per input row: id, counts of base spans by kind, base_sha256 and
    spans (``kind:start:end`` in code points, end exclusive; by kind, then start)."""
    bounded_batches(df.sparkSession)
    field = field or train(df, text_col)
    src = df.select(F.col(id_col).alias("_id"), utf8(text_col).alias("_t"))
    names = [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for x in b.column(1).to_pylist():
            base, every = field.spans(decode(x))
            rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)))
        kinds = [pa.int64()] * len(KINDS) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, zip(*rows), kinds)], names)

    return arrow_map(src, each, f"{id_col} {src.schema['_id'].dataType.simpleString()}, "
                     + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redacted(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind."""
    out, at = [], 0
    for a, b, kind in sorted((a, -b, k) for k, v in spans.items() for a, b in v):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, -b)
    return "".join(out) + text[at:]


def redact(df: DataFrame, text_col: str = "text", field: Field | None = None) -> DataFrame:
    """``df`` with personal data in the text column replaced; null texts stay null."""
    bounded_batches(df.sparkSession)
    field = field or train(df, text_col)
    at, schema = df.columns.index(text_col), df.schema

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if x is None else redacted(x, field.spans(x)[1]) for x in b.column(at).to_pylist()]
        cols = list(b.columns)
        cols[at] = pa.array(texts, b.schema.types[at])
        return pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return df.mapInArrow(lambda it: (each(b) for b in it if b.num_rows), schema)
