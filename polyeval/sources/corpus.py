"""Parallel corpora -> translation requests.

A corpus is read as one long table for all datasets and languages; pair
selection is an unpivot plus a join with the fixed (dataset, corpus code)
table, not a loop over 257 pair configurations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import registry

# Column of the English text in the wide layout.
SOURCE_CORPUS_CODE = "eng_Latn"


def expected_split() -> Column:
    """Each dataset's split (flores-200 devtest, wmt24 train, else test)."""
    ds = F.col("dataset")
    expr = None
    for name, split, _drop, _col in registry.DATASETS:
        expr = F.when(ds == name, F.lit(split)) if expr is None else expr.when(ds == name, F.lit(split))
    return expr.otherwise(F.lit("test"))


def scan_corpus(df: DataFrame) -> DataFrame:
    """Keep each dataset's own split. ``df``: (dataset, split, seg_id, ...)."""
    return df.filter(F.col("split") == expected_split())


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S4 from storage: a wide corpus table (dataset, split, seg_id, one column
    per corpus code). ``seg_id`` must be the row position in the source file
    (e.g. written from ``_metadata.row_index``), never a generated id."""
    return scan_corpus(spark.read.format(fmt).load(path))


def select_pair_columns(wide: DataFrame, lang_corpus: DataFrame,
                        source_code: str = SOURCE_CORPUS_CODE) -> DataFrame:
    """Wide layout -> (dataset, seg_id, src_lang, tgt_lang, source, target).
    Language columns are unpivoted and mapped to language keys through the
    fixed (dataset, corpus_code) table; segments without both texts go."""
    code_cols = [c for c in wide.columns if c not in ("dataset", "split", "seg_id", source_code)]
    long = wide.unpivot(["dataset", "seg_id", source_code], code_cols, "corpus_code", "target")
    lc = lang_corpus.select("dataset", "corpus_code", F.col("lang_code").alias("tgt_lang"))
    j = long.join(F.broadcast(lc), ["dataset", "corpus_code"], "inner")  # fixed 258-row table
    return (j.filter(F.col("target").isNotNull() & F.col(source_code).isNotNull())
             .select("dataset", "seg_id", F.lit(registry.SOURCE_LANG).alias("src_lang"), "tgt_lang",
                     F.col(source_code).alias("source"), "target"))


SENTENCE = "sentence_"


def sentence_pairs(df: DataFrame, lang_corpus: DataFrame, dataset: str,
                   source_code: str = SOURCE_CORPUS_CODE) -> DataFrame:
    """S5, per-pair configurations with ``sentence_<code>`` columns (read together,
    a row has two of them): the text of the source language and of the other one."""
    codes = [c.removeprefix(SENTENCE) for c in df.columns if c.startswith(SENTENCE)]
    wide = df.select(F.lit(dataset).alias("dataset"), "seg_id",
                     *[F.col(f"`{SENTENCE}{c}`").alias(c) for c in codes])
    return select_pair_columns(wide, lang_corpus, source_code)


def source_target_pairs(df: DataFrame, lang_corpus: DataFrame, dataset: str, config_col: str = "config") -> DataFrame:
    """S5, per-pair configurations (``en-<code>``) with ``source`` and ``target``."""
    lc = lang_corpus.where(F.col("dataset") == dataset).select("corpus_code", F.col("lang_code").alias("tgt_lang"))
    code = F.regexp_extract(config_col, "^[^-]*-(.*)$", 1)
    j = df.withColumn("corpus_code", code).join(F.broadcast(lc), "corpus_code")  # fixed table
    return (j.filter(F.col("source").isNotNull() & F.col("target").isNotNull())
             .select(F.lit(dataset).alias("dataset"), "seg_id", F.lit(registry.SOURCE_LANG).alias("src_lang"),
                     "tgt_lang", "source", "target"))


def read_pair_configs(spark: SparkSession, base: str, lang_corpus: DataFrame, dataset: str) -> DataFrame:
    """S4 + S5 from a local copy of a corpus downloaded by configuration:
    ``<base>/<config>/<split>*.parquet``, only the dataset's own split, either
    column layout. The row position in the file is the segment id."""
    split = next(s for name, s, _d, _c in registry.DATASETS if name == dataset)
    raw = (spark.read.option("mergeSchema", True).parquet(f"{base.rstrip('/')}/*/{split}*.parquet")
           .withColumn("seg_id", F.col("_metadata.row_index"))
           .withColumn("config", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)))
    if any(c.startswith(SENTENCE) for c in raw.columns):
        return sentence_pairs(raw, lang_corpus, dataset)
    return source_target_pairs(raw, lang_corpus, dataset)


def drop_leading_row(df: DataFrame) -> DataFrame:
    """Datasets flagged in the registry (wmt24) lose their first row."""
    drop = [name for name, _s, d, _c in registry.DATASETS if d]
    return df.filter(~(F.col("dataset").isin(drop) & (F.col("seg_id") == 0)))


def render_template(template: str, values: dict[str, Column]) -> Column:
    """A ``{name}`` template as a concat of literals and columns."""
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(values[m.group(1)])
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def build_prompt(df: DataFrame, name_col: str = "name", text_col: str = "source",
                 variant_col: str | None = None) -> Column:
    """The user turn asking for a translation into ``name``; the shorter
    template where ``variant_col`` says 'plain'."""
    vals = {"name": F.col(name_col), "text": F.col(text_col)}
    main = render_template(registry.PROMPT_TEMPLATES["thinking_off"], vals)
    if variant_col is None:
        return main
    plain = render_template(registry.PROMPT_TEMPLATES["plain"], vals)
    return F.when(F.col(variant_col) == "plain", plain).otherwise(main)


def chat_turn(prompt: Column) -> Column:
    """The prompt as a single-user-turn chat: array<struct<role, content>>."""
    return F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")))


def with_sampling(df: DataFrame, sampling: DataFrame, family_col: str = "family") -> DataFrame:
    """P10: sampling parameters of the row's model family; an unknown family
    gets the fallback (temperature 0.7, 1024 tokens). The parameter table is
    the fixed per-family list, broadcast."""
    t, p, k, mx = registry.SAMPLING_FALLBACK
    s = sampling.withColumnRenamed("family", "_fam")
    j = df.join(F.broadcast(s), F.col(family_col) == F.col("_fam"), "left")
    known = F.col("_fam").isNotNull()
    return j.select(*df.columns,
                    F.when(known, F.col("temperature")).otherwise(F.lit(t)).alias("temperature"),
                    F.when(known, F.col("top_p")).otherwise(F.lit(p).cast("double")).alias("top_p"),
                    F.when(known, F.col("top_k")).otherwise(F.lit(k).cast("int")).alias("top_k"),
                    F.when(known, F.col("max_tokens")).otherwise(F.lit(mx)).alias("max_tokens"))
