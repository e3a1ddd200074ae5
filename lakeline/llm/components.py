"""Connected components of a large graph, by alternating star operations over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.arrow import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"),
                                                       F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return (moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct())


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge; label is the smallest node it reaches.

    ``edges`` has two columns of one type without nulls; direction, repeats and loops do not
    matter. Ends when a round changes nothing; rounds grow with the logarithm of the size, not
    with the length of a chain. Each round is a written table. A node with very many neighbours
    is never gathered: minima are partial sums of each task, and joins on it can be split.
    """
    a, b = (F.col("`" + c + "`") for c in edges.columns)
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where("u <> v").distinct(), "edges")
    digest = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = None
    while (state := now.agg(digest.alias("d")).first()["d"]) != before:
        before = state
        now = stored(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
