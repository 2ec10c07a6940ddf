"""Connected components by alternating large and small stars (Kiveris and others, 2014)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soleprint.llm.tables import saved


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it can reach, for each node of ``links``.

    ``links`` holds pairs ``a``, ``b`` of longs. Each round is a minimum per node, which is
    combined before the shuffle, and a join with one row per node, so that Spark can split a node
    with very many links.
    """
    edges = saved(links.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before, state = None, _state(edges)
    while state != before:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")))
        large = both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b")
        large = saved(large.distinct())
        least = saved(large.groupBy("b").agg(F.min("a").alias("least")))
        small = large.join(least, "b").select("least", "a", "b")
        edges = saved(
            small.select(F.col("least").alias("a"), "b")
            .unionByName(small.where("a > least").select(
                F.col("least").alias("a"), F.col("a").alias("b")))
            .distinct())
        before, state = state, _state(edges)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
