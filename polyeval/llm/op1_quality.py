"""Quality rules: repetition coverage from rolling hashes.

A document's words get 64-bit codes; the hash of every n-word window follows
from the (n-1)-word one by a multiply and an add, so all window lengths cost one
vector operation each. Sorting a window length's hashes shows its repeated
windows; the *characters* inside repeated windows (each counted once) and inside
repeated lines, over all word characters, are the repetition coverage.

Everything is per document: one pass over the table, no shuffle, and nothing
larger than one document in memory beside the Arrow batch.

Defined cases: a null or empty text has no words and fails the base rule; an
invalid threshold set is the caller's; repeated rows and ids are judged row by
row; other columns, whatever their names, pass ``filter_quality`` unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.llm.common import arrow_map, bounded_batches, mix64, utf8

_SYMBOLS = [bytes([c]) for c in b"#*$%&|<>"]
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class QualityRules:
    """Limits; fractions are of word characters. They are those of published
    web-text repetition filters (top n-gram for 2-4 words, all duplicated n-grams for
    5-10 words, duplicate lines). One boilerplate line that a short clean document
    holds twice doesn't reject it: the limits on duplicated n-grams and lines are
    wider by one line (``line_chars`` word characters), which counts for less the
    longer the text is, and by the ``more`` fractions at most."""

    min_words: int = 50
    max_repeat_words_pct: int = 50
    top_ngram: dict = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    dup_ngram: dict = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    dup_line_fraction: float = 0.30
    dup_line_chars: float = 0.20
    line_chars: int = 200
    more_dup_ngram: float = 0.15
    more_dup_line_fraction: float = 0.20
    more_dup_line_chars: float = 0.10
    symbol_fraction: float = 0.08


DEFAULT = QualityRules()

COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "dup_line_char_fraction double, top_ngram_fraction double, dup_ngram_fraction double, "
           "base_failed boolean, kept boolean")


def _code_points(data: bytes) -> np.ndarray:
    """Prefix counts of code points: entry i is the number in data[:i]."""
    a = np.frombuffer(data, dtype=np.uint8)
    out = np.zeros(len(a) + 1, dtype=np.int64)
    np.cumsum((a & 0xC0) != 0x80, out=out[1:])
    return out


def window_hashes(codes: np.ndarray, lengths) -> dict[int, np.ndarray]:
    """Rolling hashes of every window of each length (in words)."""
    out, h, wanted = {}, codes, set(lengths)
    for n in range(1, max(wanted, default=0) + 1):
        if n > 1:
            if len(codes) < n:
                break
            h = h[:-1] * _BASE + codes[n - 1:]
        if n in wanted:
            out[n] = mix64(h)
    return out


def _repeats(h: np.ndarray) -> np.ndarray:
    """The hashes that occur twice or more, sorted, one entry per later occurrence."""
    s = np.sort(h)
    return s[1:][s[1:] == s[:-1]]


def _among(h: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Positions of the windows whose hash is in ``twice``."""
    at = np.searchsorted(twice, h)
    at[at == len(twice)] = 0
    return np.flatnonzero(twice[at] == h)


def _later(h: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Of the positions of repeated windows, those that are not the first."""
    first = np.unique(h[positions], return_index=True)[1]
    return np.delete(positions, first)


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words inside any of the n-word windows that begin at ``starts``."""
    edge = np.zeros(size + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(data: bytes, rules: QualityRules = DEFAULT) -> tuple:
    """One text's row of ``COLUMNS``."""
    words = data.split()  # ASCII white space: 0x20, 0x09-0x0D
    n = len(words)
    if not n:
        return (0, 0, 0, 0, 0, 0.0, 0.0, 0.0, True, False)
    n_symbols = sum(map(data.count, _SYMBOLS))
    if data.isascii():
        chars = np.fromiter(map(len, words), dtype=np.int64, count=n)
    else:
        raw = np.frombuffer(data, dtype=np.uint8)
        white = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
        ends = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).astype(np.int8)))
        points = _code_points(data)
        chars = points[ends[1::2]] - points[ends[0::2]]
    total = int(chars.sum())

    lines = [x for x in data.split(b"\n") if x.split(None, 1)]
    n_dup = dup_line_chars = 0
    if len(set(lines)) < len(lines):
        seen: set[bytes] = set()
        for x in lines:
            if x in seen:
                n_dup += 1
                dup_line_chars += sum(len(w.decode("utf-8", "replace")) for w in x.split())
            seen.add(x)

    last = dict(zip(words, range(n)))  # a code of its own for each distinct word
    codes = mix64(np.fromiter(map(last.__getitem__, words), dtype=np.uint64, count=n) + np.uint64(1))
    hashes = window_hashes(codes, {3, *rules.top_ngram, *rules.dup_ngram})
    repeats: dict[int, np.ndarray] = {}
    for k in sorted(hashes):
        found = _repeats(hashes[k])
        if not len(found):
            break  # a longer repeat would hold a repeat of this length
        repeats[k] = found
    n_repeat = 0
    if 3 in repeats:
        n_repeat = int(_covered(_among(hashes[3], repeats[3]), 3, n).sum())

    prefix = np.concatenate(([0], np.cumsum(chars)))
    top_worst = top_over = 0.0
    for k, limit in rules.top_ngram.items():
        if k in repeats:
            found = repeats[k]
            runs = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1], [True])))
            i = int(np.diff(runs).argmax())
            at = int((hashes[k] == found[runs[i]]).argmax())
            share = float(runs[i + 1] - runs[i] + 1) * float(prefix[at + k] - prefix[at]) / total
            top_worst, top_over = max(top_worst, share), max(top_over, share / limit)
    dup_worst = dup_over = 0.0
    line = rules.line_chars / total
    more = min(line, rules.more_dup_ngram)
    for k, limit in rules.dup_ngram.items():
        if k in repeats:
            later = _later(hashes[k], _among(hashes[k], repeats[k]))
            share = float(chars[_covered(later, k, n)].sum()) / total
            dup_worst, dup_over = max(dup_worst, share), max(dup_over, share / (limit + more))

    failed = n < rules.min_words or 100 * n_repeat > rules.max_repeat_words_pct * n
    kept = not (failed or top_over > 1 or dup_over > 1
                or n_dup > rules.dup_line_fraction * len(lines) + min(1, rules.more_dup_line_fraction * len(lines))
                or dup_line_chars > (rules.dup_line_chars + min(line, rules.more_dup_line_chars)) * total
                or n_symbols > rules.symbol_fraction * total)
    return (n, total, n_symbols, n_dup, n_repeat, dup_line_chars / total, top_worst, dup_worst, failed, kept)


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            rules: QualityRules = DEFAULT) -> DataFrame:
    """One row per input row: id, the measures of ``COLUMNS`` and the verdict."""
    bounded_batches(df.sparkSession)
    src = df.select(F.col(id_col).alias("_id"), utf8(text_col).alias("_t"))
    schema = f"{id_col} {src.schema['_id'].dataType.simpleString()}, {COLUMNS}"
    names = [id_col, *(c.split()[0] for c in COLUMNS.split(", "))]

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = list(zip(*(measure(x, rules) for x in b.column(1).to_pylist())))
        kinds = [pa.int64()] * 5 + [pa.float64()] * 3 + [pa.bool_()] * 2
        return pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, rows, kinds)], names)

    return arrow_map(src, each, schema)


def filter_quality(df: DataFrame, text_col: str = "text", rules: QualityRules = DEFAULT) -> DataFrame:
    """The rows of ``df`` that the rules keep, all columns unchanged."""
    bounded_batches(df.sparkSession)
    at = df.columns.index(text_col)

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column(at).to_pylist()
        return b.filter(pa.array([measure((x or "").encode("utf-8", "replace"), rules)[-1] for x in texts], pa.bool_()))

    return df.mapInArrow(lambda it: (each(b) for b in it if b.num_rows), df.schema)
