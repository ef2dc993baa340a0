"""Connected components of a table of links by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.tables import hand_over


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of the links ``a``, ``b`` (bigint).

    Each round gives every node the neighbour (or itself) with the least hash of that round, follows
    this twice, and goes on with the links between what remains; the number of nodes falls by a
    constant factor on average, whatever the shape.  A round is a few shuffles of the remaining
    links: minima are taken before the shuffle, and a hub is a skewed join key for adaptive
    execution.  Nothing is collected; every round is a stored table.  Links with NULL ends and of a
    node to itself are ignored.
    """
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    left = hand_over(links.filter("a <> b").select(a, b).distinct(), "links")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        order = lambda c, seed=len(rounds): F.struct(F.xxhash64(F.lit(seed), F.col(c)).alias("h"), F.col(c).alias("n"))
        both = left.select("a", "b").union(left.select("b", "a")).toDF("node", "other")
        near = both.groupBy("node").agg(F.min(order("other")).alias("m"))
        near = hand_over(near.select("node", F.least(order("node"), F.col("m"))["n"].alias("parent")), "nearest")
        up = near.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        step = hand_over(near.join(up, "parent").select("node", F.col("top").alias("parent")), "contracted")
        rounds.append(step)
        ends = [step.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_up")) for c in "ab"]
        rest = left.join(ends[0], "a").join(ends[1], "b").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
        left = hand_over(rest.filter("a <> b").select(a, b).distinct(), "links")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    tops = rounds[-1].toDF("node", "top")
    for step in reversed(rounds[:-1]):
        later = tops.select(F.col("node").alias("parent"), "top")
        tops = hand_over(step.join(later, "parent", "left").select("node", F.coalesce("top", "parent").alias("top")), "tops")
    least = tops.groupBy("top").agg(F.min("node").alias("component"))
    return hand_over(tops.join(least, "top").select("node", "component"), "components")
