"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlift.llm.tables import written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Each step replaces edges by edges to the smallest neighbour until all are stars, in a
    number of rounds that grows with the logarithm of the diameter.  Neighbourhoods are reduced
    to their minimum before a join, so a node with many neighbours meets no task as a list.
    Every round is a written table; only its row count and checksum reach the driver.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.select(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())

    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = written(pairs, name)
    last = state(pairs)
    while last[0]:
        both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        pairs = written(small.select("e.a", "e.b").where("a <> b").distinct(), name)
        now = state(pairs)
        if now == last:
            break
        last = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
