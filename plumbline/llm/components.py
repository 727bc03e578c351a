"""Connected components by alternating stars, each round a few joins and grouped minima over edges; no node's neighbours are ever gathered.

How many edges are left is known in every round. Up to SMALL of them (a few MB) the minima are broadcast and everything runs in FILES tasks, so
that the many short rounds at the end cost no wide shuffles; beyond that the same joins are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import staged

SMALL = 1 << 18
FILES = 8


def narrow(df: DataFrame, small: bool) -> DataFrame:
    return df.coalesce(FILES) if small else df


def sent(df: DataFrame, small: bool) -> DataFrame:
    """The side of a join that is broadcast if it is known to be small."""
    return F.broadcast(df.coalesce(FILES)) if small else df


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its component. Self-loops and repeats are fine."""
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        small = before[0] <= SMALL
        edges = narrow(edges, small)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(sent(least, small), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        large = staged(narrow(large, small), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(sent(least, small), "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = staged(narrow(pairs.select("e.*").where("a > b").distinct(), small), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    return staged(narrow(roots, before[0] <= SMALL), "roots")
