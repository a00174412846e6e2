"""Connected components of a graph given as links, by contraction, entirely on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import spread_join, store


def components(links: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node reachable) of every node in ``links`` (columns ``a``, ``b``); stored.

    Each round every node takes the smallest of itself and its neighbours as parent, follows that parent once,
    and links are redrawn between parents; loops and repeats vanish. Rounds grow with the logarithm of the
    longest path. A hub's links are cut into parts where they are joined, and pre-aggregated elsewhere.
    """
    edges = store(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    roots = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = store(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p"), F.count("*").alias("n")), "parents")
        # Nodes that share a parent may be many, so the parent's own row gets their number as weight.
        followers = parents.groupBy("p").agg(F.count("*").alias("n")).withColumnRenamed("p", "key")
        onward = parents.select(F.col("a").alias("key"), F.col("p").alias("to")).join(followers, "key")
        jumped = store(
            spread_join(parents.select(F.col("p").alias("key"), F.col("a").alias("node"), F.col("n").alias("degree")),
                        store(onward, "onward"), "key", "n", "node").select("node", "to", "degree"),
            "jumped",
        )

        def moved(rows: DataFrame, column: str, by: str, weights: DataFrame = jumped) -> DataFrame:
            keyed = weights.select(F.col("node").alias(column), F.col("to").alias("_to"), F.col("degree").alias("_n"))
            joined = spread_join(rows, keyed, column, "_n", by, "left")
            return joined.withColumn(column, F.coalesce("_to", column)).drop("_to", "_n")

        if roots is None:
            roots = jumped.select("node", F.col("to").alias("root"))
        else:
            gathered = roots.groupBy("root").agg(F.count("*").alias("degree"))
            weights = store(
                jumped.select("node", "to").join(gathered, F.col("node") == F.col("root"), "left")
                .select("node", "to", F.coalesce("degree", F.lit(1)).alias("degree")),
                "gathered",
            )
            roots = store(moved(roots, "root", "node", weights), "roots")
        edges = store(
            moved(moved(edges, "a", "b"), "b", "a").filter("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
