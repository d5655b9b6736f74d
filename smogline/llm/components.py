"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import written


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).withColumn("least", F.least("u", "least"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the least of them."""
    least = _least_neighbour(edges)
    moved = edges.join(least, "u").where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.withColumnRenamed("least", "v")).distinct()


def connected(links: DataFrame, purpose: str = "components") -> DataFrame:
    """(id, component) for every id in ``links(a, b)``; component is the least id reachable.

    Stars are grouped with sums before the shuffle, so a node with very many
    links does not meet in one task. The number of rounds grows with the
    logarithm of the longest chain; each round is written to the shared folder.
    Links of an id to itself and repeated links change nothing; without links
    the result is empty.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), purpose
    )

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()

    before = mark(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)), purpose)
        after = mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
