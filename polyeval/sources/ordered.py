"""O1, O2 at any size: tables written in a total order, and the order read back.

``write_ordered`` deals rows into ranges of the keys and sorts each, so file after file the table is in
order, with no task that holds all of it; rows that are equal in all keys may span
files. ``positions`` numbers the stored rows by where they lie: the rows of the files before (one
number a file), and Parquet's row index. ``order_faults`` lists the files that break the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, path: str, keys: list[str], mode: str = "error", max_records_per_file: int = 1_000_000) -> None:
    """Parquet files whose names, and rows, follow the ascending order of ``keys`` (nulls first)."""
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode)
       .option("maxRecordsPerFile", max_records_per_file).parquet(path))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _place(file: Column) -> list[Column]:
    """A file's place: its task's number, then its number among the task's files."""
    return [F.regexp_extract(file, r"part-(\d+)-", 1).cast("long"), F.regexp_extract(file, r"-c(\d+)", 1).cast("long")]


def positions(spark: SparkSession, path: str, out_col: str = "position") -> DataFrame:
    """The table with each row's place in it, from 1. The files' counts (a row a file) are summed in
    their order and joined back by file."""
    rows = _stored(spark, path)
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(*_place(F.col("_file"))).rowsBetween(Window.unboundedPreceding, -1))
    starts = files.select("_file", F.coalesce(before, F.lit(0)).alias("_start"))
    return rows.join(starts, "_file").withColumn(out_col, F.col("_start") + F.col("_row") + 1).drop("_file", "_row", "_n", "_start")


def order_faults(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """file, fault: rows of a file out of order, or a file that begins before the one ahead of it
    ends. No rows: the table is in order. Rows are compared within their files (split by
    file), files by their least and greatest keys."""
    key = F.struct(*keys)
    rows = _stored(spark, path).select("_file", "_row", key.alias("_key"))
    # Neighbours meet in blocks of row numbers, the last row of a block in the next one too: no task holds a whole file.
    size = 1 << 16
    blocks = rows.withColumn("_block", F.explode(F.when((F.col("_row") + 1) % size == 0, F.array((F.col("_row") / size).cast("long"), (F.col("_row") / size).cast("long") + 1))
                                                .otherwise(F.array((F.col("_row") / size).cast("long")))))
    ahead = F.lag("_key").over(Window.partitionBy("_file", "_block").orderBy("_row"))
    within = blocks.withColumn("_ahead", ahead).where(F.col("_ahead") > F.col("_key")).select(
        F.col("_file").alias("file"), F.lit("rows out of order").alias("fault")).distinct()
    ends = rows.groupBy("_file").agg(F.min("_key").alias("_least"), F.max("_key").alias("_most"))
    between = ends.withColumn("_before", F.max("_most").over(Window.orderBy(*_place(F.col("_file"))).rowsBetween(Window.unboundedPreceding, -1)))
    return within.unionByName(between.where(F.col("_before") > F.col("_least")).select(F.col("_file").alias("file"), F.lit("begins before the files ahead end").alias("fault")))
