"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm.scratch import Scratch


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``edges`` (``a``, ``b``).

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its smallest neighbour, then its smaller ones. Each step is a
    minimum per node (combined before the shuffle) and a join back, so a node with
    very many neighbours is never gathered; the number of rounds grows with the
    logarithm of the longest chain.
    """
    scratch = Scratch(edges.sparkSession)
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = scratch.keep(ordered, "edges")
    seen = _state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("c")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("c")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        smallest = large.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m"))
        joined = large.join(smallest, F.col("a") == F.col("c"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(smallest.select(F.col("c").alias("a"), F.col("m").alias("b"))).distinct()
        before, now = now, scratch.keep(small, "edges")
        scratch.drop(before)
        last, seen = seen, _state(now)
        if last == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
