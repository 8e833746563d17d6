"""Connected components of a table of links, without a collect: alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root): every node of a link with the smallest node that it reaches.

    Each round sends the larger neighbours of a node to its smallest neighbour, then the smaller
    ones, until nothing moves; rounds grow with the logarithm of the longest chain. Each round is a
    written table. A node with a third of all links is pre-aggregated by ``min``; the join back on it
    is a plain equi-join that adaptive execution splits.
    """
    links = stage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    state = None
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: larger neighbours go to the smallest of the neighbourhood.
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: smaller neighbours, and the node itself, go to the smallest neighbour.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select("b", "m").where("b <> m").toDF("a", "b").unionByName(lowest.toDF("a", "b")).distinct()
        links = stage(small, "links")
        # Links, their sum and that of their ends stay the same once every node points to its root.
        size = links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if tuple(size) == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = tuple(size)
