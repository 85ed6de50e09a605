"""Connected components of an undirected graph, as a distributed loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymesh.llm.common import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least node it knows."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the least of them. Rows have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v): label is the least node that is reachable.

    Alternates the large-star and small-star steps until every node but the labels has one row, and no
    label has one. Each round is written to the shared folder, so lineage stays short. Self-links are
    ignored; a graph without links gives no rows.
    """
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    for _ in range(most_rounds):
        now = durable(_small_star(_large_star(now)), "star")
        roots = now.select(F.col("v").alias("u")).distinct()
        if now.join(roots, "u", "left_semi").isEmpty() and now.groupBy("u").count().where("count > 1").isEmpty():
            children = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
            return children.unionByName(roots.select(F.col("u").alias("node"), F.col("u").alias("label")))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
