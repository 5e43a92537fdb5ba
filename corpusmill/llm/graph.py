"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.storage import discard, give_back_driver, materialize

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node that can be reached.

    Loops, repeated and null edges are ignored. Each step is a grouped minimum (combined before the shuffle) and an
    equi-join, and the edges of each round are written to the shared folder, in place of those before; the driver sees only a count and a hash,
    and gives memory back after each.
    """
    a, b = F.col("a"), F.col("b")
    now = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = materialize(now, "edges")
    seen = None
    for _ in range(ROUNDS):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).where(a != b).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.explode(F.array(F.struct("b", "m"), F.struct(a.alias("b"), "m"))).alias("e"))
        small = small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where(a != b).distinct()
        before, now = now, materialize(small, "edges")
        discard(before)
        give_back_driver(now.sparkSession)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
