"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch. Documents can be long, so the default of 10,000
#: rows would not bound a Python worker's memory.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default (a running session's
    explicit smaller setting is kept)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def utf8(col: str) -> Column:
    """Bytes of a text column; null is the empty text."""
    return F.coalesce(F.col(col).cast("string").cast("binary"), F.lit(b"").cast("binary"))


def arrow_map(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``each`` maps one non-empty batch to one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield each(b)
    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix64's constants), vectorized."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def decode(data: bytes) -> str:
    """Spark strings are UTF-8; a damaged sequence becomes U+FFFD."""
    return data.decode("utf-8", "replace")
