"""Connected components of a table of links, without collecting any node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node it can reach.

    Alternates two steps until nothing changes. Large star: every node hands its smallest neighbour
    (or itself) to its larger neighbours. Small star: it does so for itself and its smaller ones. Each
    step is a minimum per node and a join, so a node with very many links is only counted together;
    the number of rounds grows with the logarithm of the nodes.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == before or not state[0]:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(least, "a")
        small = joined.select("a", F.col("least").alias("b")).unionByName(joined.select(F.col("b").alias("a"), F.col("least").alias("b")))
        edges = stage(small.filter("a <> b").distinct())
