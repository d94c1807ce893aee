"""Registered queries of this subpackage: ``QUERIES`` and ``ORACLE``."""

from __future__ import annotations

from pyspark.sql import functions as F

from polyeval.llm import op1_quality, op2_bpe, oracle
from polyeval.llm.common import table

QUERIES = {}
ORACLE = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_quality_rules(spark, sf_dir):
    return op1_quality.quality(table(spark, sf_dir, "documents"))


@_query
def op2_bpe_round_trip(spark, sf_dir):
    import public_tokenizers
    return op2_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op3_packing(spark, sf_dir):
    import public_tokenizers
    from polyeval.llm import op3_packing as packing
    return packing.pieces(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@_query
def op4_substring_dedup(spark, sf_dir):
    from polyeval.llm import op4_substring
    out = op4_substring.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@_query
def op8_suffix_dedup(spark, sf_dir):
    from polyeval.llm import op8_suffixes
    return op8_suffixes.digest(op8_suffixes.remove_repeats(table(spark, sf_dir, "documents")))


@_query
def op5_minhash_near_dedup(spark, sf_dir):
    from polyeval.llm import op5_minhash
    return op5_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op9_fingerprint(spark, sf_dir):
    from polyeval.llm import op9_fingerprint as fingerprint
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@_query
def op7_pii_spans(spark, sf_dir):
    from polyeval.llm import op7_pii
    return op7_pii.find(table(spark, sf_dir, "documents"))


@_query
def op10_warc(spark, sf_dir):
    from polyeval.llm import op10_warc as warc
    return warc.round_trip(table(spark, sf_dir, "pages"))


@_query
def op6_chat_format(spark, sf_dir):
    from polyeval.llm import op6_chat
    return op6_chat.format_chats(table(spark, sf_dir, "conversations"))


@_query
def op11_token_frames(spark, sf_dir):
    import public_tokenizers
    from polyeval.llm import op11_token_frames as frames
    return frames.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op12_whitening(spark, sf_dir):
    from polyeval.llm import op12_whitening as whitening
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@_query
def op13_hard_negatives(spark, sf_dir):
    from polyeval.llm import op13_negatives
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return op13_negatives.mine(rows, F.col("vec_id") % 100 == 0).drop("positive_rank")


ORACLE |= {"op4_substring_dedup": oracle.SUBSTRING_SQL, "op5_minhash_near_dedup": oracle.NEAR_SQL,
           "op8_suffix_dedup": oracle.SUFFIX_SQL, "op10_warc": oracle.WARC_SQL,
           "op13_hard_negatives": oracle.NEGATIVES_SQL}
