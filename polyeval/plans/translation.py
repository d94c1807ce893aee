"""Corpora -> translations of what is still pending.

work grid --J3--> pending units --join with the corpora's pairs--> S6 --> prompts
(P9) and sampling (P10) --U2/P6--> segments, written in the K2 layout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import registry, schemas
from ..operators import joins as J
from ..operators import neural as U
from ..sources import corpus as S

PAIR = ["dataset", "src_lang", "tgt_lang"]


def translation_requests(models: DataFrame, pairs: DataFrame, done: DataFrame) -> DataFrame:
    """A row for each segment of each pending unit, with prompt and sampling.
    ``models``: registry rows; ``pairs``: (dataset, src_lang, tgt_lang, seg_id, source,
    target); ``done``: anything with the unit keys. A segment is repeated for each
    model that lacks it (15 at most), through a list of models per pair (257
    pairs), not through a join of segments with models."""
    spark = pairs.sparkSession
    done = done.withColumn("model", registry.canonical_model("model"))
    grid = J.translation_grid(models.where("in_translation")).select(*schemas.UNIT_KEYS)
    todo = J.pending_units(grid, done, schemas.UNIT_KEYS)
    asked = todo.groupBy(*PAIR).agg(F.sort_array(F.collect_list("model")).alias("models"))
    rows = S.drop_leading_row(pairs).join(F.broadcast(asked), PAIR)  # at most 257 rows
    rows = rows.select(*PAIR, "seg_id", "source", "target", F.explode("models").alias("model"))
    info = models.select("model", "family", "prompt_variant")
    names = registry.languages_df(spark).select(F.col("lang_code").alias("tgt_lang"), "name")
    rows = rows.join(F.broadcast(info), "model").join(F.broadcast(names), "tgt_lang")  # fixed tables
    rows = S.with_sampling(rows, registry.sampling_df(spark))
    return rows.withColumn("prompt", S.build_prompt(rows, "name", "source", "prompt_variant"))


def translate_pending(models: DataFrame, pairs: DataFrame, done: DataFrame, factory: Callable) -> DataFrame:
    """Segments (D10) of every pending unit."""
    out = U.generate(translation_requests(models, pairs, done), factory)
    return out.select(*[f.name for f in schemas.SEGMENTS.fields])
