"""Connected components of a distributed edge list, by alternating stars.

A large star joins every greater neighbour of a node to the least node that
it knows, a small star does so for the lesser ones; both keep the components, and
after a few rounds every node hangs on its component's least node. Each round is
written to the shared checkpoint folder, so lineage stays short and a lost
executor costs one round. Nothing but whether a round is left to do reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u > v). Large: over all neighbours; small: over lesser ones."""
    around = edges
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("least")).withColumn("m", F.least("u", "least"))
    hung = around.join(least.select("u", "m"), "u")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node that hangs on none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))).alias("e")).select("e.*")
    ends = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return ends.where("hangs > 1 or hangs + holds > 1").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its least node) of every node with a link."""
    edges = written(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while not _stars(edges):
        edges = written(_star(_star(edges, True), False), "edges")
    tops = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
