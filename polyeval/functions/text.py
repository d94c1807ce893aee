"""Column expressions on segment text and metric cells.

All are built-in Spark expressions (whole-stage codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip()/str.split() see it: Unicode White_Space
# plus the four ASCII separators U+001C..U+001F.
WS = r"[\s\x{1c}-\x{1f}]"
_STRIP_RE = rf"(?U)^{WS}+|{WS}+\z"

THINK_CLOSE = "</think>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Unicode-whitespace strip on both ends (``trim`` strips spaces only)."""
    return F.regexp_replace(_c(c), _STRIP_RE, "")


def rstrip(c) -> Column:
    return F.regexp_replace(_c(c), rf"(?U){WS}+\z", "")


def clean_translation(c) -> Column:
    """Drop everything up to and including the last ``</think>``, then
    strip. An unclosed ``<think>`` stays. ``substring_index(.., -1)`` is the
    text after the last delimiter (the whole text when there is none), which is
    what the lazy dot-all regex removal leaves, without its back-tracking."""
    return strip(F.substring_index(_c(c), THINK_CLOSE, -1))


def stringify_missing(c, na_compat: bool = True) -> Column:
    """P5: a missing text cell reads as the literal ``nan`` (as a pandas
    ``astype(str)`` does); with ``na_compat=False`` as the empty string."""
    return F.coalesce(_c(c), F.lit("nan" if na_compat else ""))


def strip_output(c) -> Column:
    """Generated text, whitespace-stripped."""
    return strip(c)


def is_missing_numeric(c) -> Column:
    """NULL, empty, non-numeric or NaN -> True."""
    v = _c(c).cast("string").try_cast("double")
    return v.isNull() | F.isnan(v)


def numeric_or_null(c) -> Column:
    v = _c(c).cast("string").try_cast("double")
    return F.when(~F.isnan(v), v)


def make_pair(src, tgt) -> Column:
    """``src-tgt``."""
    return F.concat_ws("-", _c(src), _c(tgt))


def split_pair(pair) -> tuple[Column, Column, Column]:
    """(src, tgt, valid). Anything but exactly one '-' is invalid; the
    caller routes invalid units to run_status instead of failing the job."""
    parts = F.split(_c(pair), "-")
    valid = F.size(parts) == 2
    return (F.when(valid, parts[0]), F.when(valid, parts[1]), valid)


def round_half_even(c, digits: int) -> Column:
    """``round(x, d)`` as Python rounds a float (half to even on the
    decimal expansion); ties are the only place Spark's HALF_UP differs."""
    return F.bround(_c(c), digits)


def to_scorer_triple(source="source", translation="translation_clean", reference="target",
                     names=("src", "mt", "ref")) -> list[Column]:
    """The scorer's input triple."""
    return [_c(source).alias(names[0]), _c(translation).alias(names[1]), _c(reference).alias(names[2])]
