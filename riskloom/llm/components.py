"""Connected components by alternating stars: each round joins and groups, none collects."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import stored


def components(edges: DataFrame) -> DataFrame:
    """`node` and its component's smallest node `root`, for nodes with an edge (`a`, `b`: longs).

    A round links every node's larger neighbours to its smallest one, then all its smaller
    neighbours; the number of rounds grows with the logarithm of the nodes.  Smallest neighbours are
    pre-aggregated, and a node with very many neighbours is a skewed join, which is split.
    """
    links = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).unionByName(low.select("a", F.col("m").alias("b")))
        links = stored(small.distinct())
        before, state = state, _state(links)
        if state == before:
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(links: DataFrame) -> tuple:
    """Number of links and a sum of their hashes: equal when a round changes nothing."""
    row = links.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]
