"""Connected components by random contraction, for links with hubs of any degree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.llm.common import Scratch, join_groups


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (node, root) for every end of ``links`` (a, b); equal roots are connected.

    Each round orders nodes by a fresh hash; a node moves to its lowest
    neighbour if that is lower, and links are renamed, which contracts a fixed
    share of the nodes whatever the shape. The moves are composed backwards.
    Counts go with every join, so a hub is split.
    """
    left = scratch.store(links.select("a", "b").filter("a != b").distinct())
    moves: list[DataFrame] = []
    while not left.isEmpty():
        number = F.lit(len(moves))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = F.min(F.struct(F.xxhash64("b", number).alias("h"), "b"))
        best = both.groupBy("a").agg(F.count("*").alias("n"), low.alias("low"))
        lower = F.col("low.h") < F.xxhash64("a", number)
        moves.append(scratch.store(best.select("a", "n", F.when(lower, F.col("low.b")).otherwise(F.col("a")).alias("to"))))
        once = join_groups(left, moves[-1], "a").select(F.col("to").alias("c"), "b")
        degree = moves[-1].select(F.col("a").alias("b"), "n", "to")
        twice = join_groups(once, degree, "b").select(F.col("c").alias("a"), F.col("to").alias("b"))
        left = scratch.store(twice.filter("a != b").distinct())
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves[-1].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for step in reversed(moves[:-1]):
        sizes = step.groupBy("to").agg(F.count("*").alias("n"))
        named = sizes.join(roots, sizes["to"] == roots["node"], "left").select(
            "to", "n", F.coalesce("root", "to").alias("root")
        )
        met = join_groups(step.select("a", "to"), scratch.store(named), "to")
        roots = scratch.store(met.select(F.col("a").alias("node"), "root"))
    return roots
