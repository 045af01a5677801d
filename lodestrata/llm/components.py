"""Connected components of a table of links, by stars that grow round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.tables import stored


def _to_least(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with the least v of each u; sums are combined before the shuffle, and joins can be split."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is its least node.

    Each round links every node's larger neighbours to its least neighbour, then
    every node and its smaller neighbours to the least of them, until nothing
    changes: then each node has one link, to the least of its component. Only counts
    reach the driver, and the number of rounds grows with the logarithm of the size.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stored(pairs, "links")
    before = None
    while True:
        mark = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).filter("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _to_least(large)
        pairs = stored(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
