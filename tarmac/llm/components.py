"""Connected components of a link table, by alternating large-star / small-star rounds.

Every round is a grouped minimum (combined map-side) and an equi-join that
AQE may split, written to the shared folder, so neither a node with very
many links nor a lost executor hurts. Links never reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.layers import materialise


def _measure() -> dict:
    return {"links": F.count(F.lit(1)), "mark": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Return (node, root) for every node of ``links``; root is the least node reached.

    Self links and repeated links are harmless; an empty table gives an empty
    result. Raises when ``max_rounds`` did not suffice (rounds grow with the
    logarithm of the longest chain).
    """
    high, low = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    edges, seen = materialise(
        links.select(high.alias("a"), low.alias("b")).where("a <> b").distinct(), "cc", _measure())
    for _ in range(max_rounds):
        if not seen["links"]:
            break
        # large star: every larger neighbour of a node is linked to the node's least neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours are linked to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct())
        before = seen
        edges, seen = materialise(small, "cc", _measure())
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
