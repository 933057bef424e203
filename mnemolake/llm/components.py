"""Connected components of large graphs, as rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemolake.llm.common import stage


def connected_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the component's smallest node.

    Alternating large-star and small-star rounds: each hangs a node's larger, then its smaller neighbours under the
    smallest one known, until only stars are left. Every round is staged in the shared folder, which cuts the
    lineage; the number of rounds is logarithmic for any shape, chains included. Minima are combined before the
    shuffle, so a node with very many neighbours is no hot group. Edges and their number never reach the driver.
    """

    def tidy(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = stage(tidy(edges), check=F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0)))
    for _ in range(rounds):
        if not now.rows:
            break
        e = now.df
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_b")).select("a", F.least("a", "_b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = tidy(large)
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        small = e.join(least, "a").select("b", "m", "a")
        hung = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        after = stage(tidy(hung), check=F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0)))
        if after.rows == now.rows and after.seen["check"] == now.seen["check"]:
            break
        now = after
    else:
        raise RuntimeError("components did not settle")
    stars = now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(now.df.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
