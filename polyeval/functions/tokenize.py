"""Tokenizers for the n-gram metrics.

``13a``, ``char`` and ``none`` are built-in Spark expressions. ``spm`` (the
subword tokenizer the reference's BLEU setting uses) needs a SentencePiece
model file supplied by the user and runs as an Arrow UDF that loads the model
once per Python worker.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import WS, rstrip

_WS_RUN = rf"(?U){WS}+"

# FIXED VALUES: the mteval-v13a tokenizer (punctuation classes and the digit
# rules for '.', ',' and '-'), applied in this order to " line ".
_13A_RULES = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
_13A_PRE = [("<skipped>", ""), ("-\n", ""), ("\n", " "),
            ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]

# FIXED VALUES: ASCII punctuation split off word ends for chrF++ word n-grams.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def split_ws(c: Column) -> Column:
    """Python ``str.split()``: runs of whitespace, no empty tokens."""
    s = F.regexp_replace(c, rf"(?U)^{WS}+|{WS}+\z", "")
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, _WS_RUN))


def tok_13a(c: Column) -> Column:
    s = c
    for a, b in _13A_PRE:
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pat, rep in _13A_RULES:
        s = F.regexp_replace(s, pat, rep)
    return split_ws(s)


def tok_char(c: Column) -> Column:
    s = F.regexp_replace(c, _WS_RUN, "")
    return F.regexp_extract_all(s, F.lit("(.)"), 1)


def tok_none(c: Column) -> Column:
    return split_ws(c)


# ---- the same tokenizers as plain Python, for use inside Arrow tasks ----
_13A_PY = [(re.compile(p), r.replace("$1", r"\1").replace("$2", r"\2"))
           for p, r in _13A_RULES]


# The first 13a rule pads every character of its class with spaces. Padding
# a space with spaces changes no token, so the in-task version leaves spaces
# out of the class (most matches in running text are spaces).
_13A_RULE0_NO_SPACE = re.compile(r"[\{-\~\[-\`!-&\(-\+\:-\@\/]")
_13A_PADDED = [(c, f" {c} ") for c in map(chr, range(128)) if _13A_RULE0_NO_SPACE.match(c)]


def py_13a(line: str) -> list[str]:
    line = line.rstrip()
    for a, b in _13A_PRE:
        if a in line:
            line = line.replace(a, b)
    line = f" {line} "
    for c, padded in _13A_PADDED:  # a search for each is faster than the class's, character by character
        if c in line:
            line = line.replace(c, padded)
    if "." in line or "," in line:
        line = _13A_PY[1][0].sub(_13A_PY[1][1], line)
        line = _13A_PY[2][0].sub(_13A_PY[2][1], line)
    if "-" in line:
        line = _13A_PY[3][0].sub(_13A_PY[3][1], line)
    return line.split()


def py_char(line: str) -> list[str]:
    return list("".join(line.rstrip().split()))


def py_none(line: str) -> list[str]:
    return line.rstrip().split()


def py_chrf_chars(line: str) -> str:
    return "".join(line.split())


def py_chrf_words(line: str) -> list[str]:
    out = []
    for w in line.split():
        if len(w) == 1:
            out.append(w)
        elif w[-1] in PUNCTUATION:
            out += [w[:-1], w[-1]]
        elif w[0] in PUNCTUATION:
            out += [w[0], w[1:]]
        else:
            out.append(w)
    return out


MAX_MODEL = 64 << 20  # bytes of a SentencePiece model that may be sent to executors


def spm_model_bytes(path: str) -> bytes:
    """A SentencePiece model's bytes, read once through Spark, so any path that Spark reaches will do and
    no worker opens it: they go to the workers with the function that uses them."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if spark is None:
        with open(path, "rb") as f:
            data = f.read(MAX_MODEL + 1)
    else:
        file = spark.read.format("binaryFile").load(path).select("length", F.when(F.col("length") <= MAX_MODEL, F.col("content")).alias("content")).first()
        data = b"" if file is None else bytes(file.content) if file.content is not None else bytes(MAX_MODEL + 1)
    if not data or len(data) > MAX_MODEL:
        raise ValueError(f"{path}: no SentencePiece model of at most {MAX_MODEL} bytes")
    return data


class _SpmTokens:
    def __init__(self, model: bytes):
        self.model = model

    def __call__(self, line: str) -> list[str]:
        return " ".join(_spm(self.model).encode(line.rstrip(), out_type=str)).split()


def py_bleu_tokenizer(tokenizer: str = "13a", spm_model: str | None = None):
    """The BLEU tokenizer as a picklable per-text function."""
    if tokenizer == "13a":
        return py_13a
    if tokenizer == "char":
        return py_char
    if tokenizer in ("none", "whitespace"):
        return py_none
    if tokenizer in ("spm", "flores200", "flores101"):
        if not spm_model:
            raise ValueError(f"tokenizer={tokenizer!r} needs spm_model=<path to a SentencePiece model>")
        return _SpmTokens(spm_model_bytes(spm_model))
    raise ValueError(f"unknown tokenizer {tokenizer!r}")


@lru_cache(maxsize=4)
def _spm(model: bytes):
    import sentencepiece as spm
    return spm.SentencePieceProcessor(model_proto=model)


def spm_udf(model_path: str):
    model = spm_model_bytes(model_path)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _tok(s: pd.Series) -> pd.Series:
        sp = _spm(model)
        return pd.Series([" ".join(sp.encode(x, out_type=str)).split() for x in s])
    return _tok


def bleu_signature(tokenizer: str = "13a", spm_model: str | None = None) -> str:
    """What a BLEU score was made with, to be kept beside it: scores of different tokenizers, or
    different models under one name, can't be compared."""
    import hashlib
    model = f"|model:{hashlib.sha256(spm_model_bytes(spm_model)).hexdigest()[:12]}" if tokenizer in ("spm", "flores200", "flores101") and spm_model else ""
    return f"nrefs:1|case:mixed|tok:{tokenizer}|smooth:exp{model}"


def bleu_token_string(c, tokenizer: str = "13a", spm_model: str | None = None) -> Column:
    """The BLEU tokens as one string, single spaces between tokens (cheaper to
    hand to a Python worker than an array)."""
    col = F.col(c) if isinstance(c, str) else c
    if tokenizer == "13a":
        s = rstrip(col)
        for a, b in _13A_PRE:
            s = F.replace(s, F.lit(a), F.lit(b))
        s = F.concat(F.lit(" "), s, F.lit(" "))
        for pat, rep in _13A_RULES:
            s = F.regexp_replace(s, pat, rep)
        return F.regexp_replace(F.regexp_replace(s, rf"(?U)^{WS}+|{WS}+\z", ""), _WS_RUN, " ")
    return F.array_join(bleu_tokens(col, tokenizer, spm_model), " ")


def bleu_tokens(c, tokenizer: str = "13a", spm_model: str | None = None) -> Column:
    """BLEU preprocessing: right-strip, then tokenize -> array<string>."""
    col = F.col(c) if isinstance(c, str) else c
    s = rstrip(col)
    if tokenizer == "13a":
        return tok_13a(s)
    if tokenizer == "char":
        return tok_char(s)
    if tokenizer in ("none", "whitespace"):
        return tok_none(s)
    if tokenizer in ("spm", "flores200", "flores101"):
        if not spm_model:
            raise ValueError(f"tokenizer={tokenizer!r} needs spm_model=<path to a SentencePiece model>")
        return spm_udf(spm_model)(s)
    raise ValueError(f"unknown tokenizer {tokenizer!r}")


def chrf_chars(c) -> Column:
    """chrF character stream: the text with all whitespace removed."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, _WS_RUN, "")


def chrf_words(c) -> Column:
    """chrF++ word tokens: whitespace split, then one punctuation mark split
    off the end of a word (or else off its start)."""
    col = F.col(c) if isinstance(c, str) else c
    words = split_ws(col)
    p = F.lit(PUNCTUATION)

    def one(w):
        last, first = F.substring(w, -1, 1), F.substring(w, 1, 1)
        n = F.length(w)
        return (F.when(n <= 1, F.array(w))
                 .when(F.instr(p, last) > 0, F.array(F.substring(w, 1, n - 1), last))
                 .when(F.instr(p, first) > 0, F.array(first, F.substring(w, 2, n - 1)))
                 .otherwise(F.array(w)))
    return F.flatten(F.transform(words, one))
