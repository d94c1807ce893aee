"""A corpus from raw documents to training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; its result is written as Parquet and read again. All but the last return
the columns of ``documents`` (``n_chars`` follows the text). An empty table
passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyeval.llm import op1_quality, op3_packing, op4_substring, op5_minhash, op7_pii
from polyeval.llm.common import table
from polyeval.llm.components import written


#: Least similarity of near duplicates in the pipeline; op5's own query has another.
NEAR_PERCENT = 80


def _with_text(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return op1_quality.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id. Rows that
    repeat an id with its text are one document, and one of them stays (of rows that differ in other
    columns, the least); rows of one id with other texts stay, as does each null id's text once."""
    found = op5_minhash.near_duplicates(docs, percent=NEAR_PERCENT)
    kept = docs.join(found.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti")
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():  # reads ids alone
        return kept
    keyed = kept.withColumns({"_hash": F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256), "_null": F.col("text").isNull()})
    key = ["doc_id", "_hash", "_null"]
    again = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    on = [keyed[c].eqNullSafe(again[c]) for c in key]
    once = keyed.join(again, on, "left_anti")
    repeated = keyed.join(again, on, "left_semi").groupBy(*key).agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return once.select(*docs.columns).unionByName(repeated.select("_row.*"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages."""
    done = op4_substring.remove_repeats(docs, keep_columns=True, keep_layout=True)
    rest = [F.col(f"rest.{c}").alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    return _with_text(done.select("doc_id", F.col("kept_text").alias("text"), *rest).select(*docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _with_text(op7_pii.redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    import public_tokenizers
    return op3_packing.pieces(op3_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality rules", quality_rules), ("MinHash near-dedup", near_dedup), ("substring dedup", substring_dedup),
          ("PII", personal_data), ("packing", packing)]

#: The stages can't be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
