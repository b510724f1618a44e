"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of links (a, b); component is the least node that it reaches.

    Alternates large-star and small-star steps: neighbours are handed the least node seen, until
    all links point at the least node of their component. Steps grow with the logarithm of the
    longest path, each written to the shared folder; minima are combined before they are shuffled,
    and nothing is gathered by node.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
    while True:
        both = links.select("v", "u").union(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        root = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(root, "v")
        handed = joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        small = handed.union(root.select("v", F.col("m").alias("u"))).distinct()
        new = stored(small, "links")
        if _digest(new) == _digest(links):
            break
        links = new
    roots = links.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return links.select(F.col("v").alias("node"), F.col("u").alias("component")).union(roots)


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(v, u))"), F.expr("bit_xor(xxhash64(u, v, 1))")).first())
