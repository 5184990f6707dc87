"""Connected components by alternating stars, in Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Parts that the rows of one key are dealt to before a join.
SALTS = 8


def salted(rows: DataFrame, by: str) -> DataFrame:
    """Adds ``part``, which deals the rows of any key to ``SALTS`` tasks."""
    return rows.withColumn("part", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))


def resalted(keys: DataFrame) -> DataFrame:
    """Rows of unique keys, once for each part of :func:`salted`."""
    return keys.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a, b) with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = salted(both, "b").join(resalted(least), ["a", "part"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    smallest = large.groupBy("a").agg(F.min("b").alias("m"))
    small = salted(large, "b").join(resalted(smallest), ["a", "part"])
    return small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id of ``edges`` (columns a, b); component is the least id reachable.

    Each round is written to the shared folder, so lost executors cost one round
    at most.  Rounds grow with the logarithm of the longest chain.  Self loops
    and repeated edges are harmless.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        # done when every id has one parent and no parent has a parent
        children = now.groupBy("a").agg(F.count("*").alias("n"))
        open_ = children.where("n > 1").select("a").union(now.select(F.col("b").alias("a")).distinct().join(children, "a", "left_semi")).limit(1)
        if open_.isEmpty():
            break
        now = written(_stars(now), "stars")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
