"""Connected components of a graph in tables, by alternating stars: no links or components reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of the links (a long, b long) can reach, for all nodes of links.

    In the large step every node links its larger neighbours to its smallest one; in the small step every node links its
    smaller neighbours and itself to the smallest one. Both only aggregate by min and join, so a hub is pre-aggregated
    and a skewed join can be split. Ends when a round changes nothing; then every link leads to a root."""
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums == seen or not sums[0]:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).union(edges.select("v", "v").distinct())
        seen = sums
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        old, edges = edges, stage(small.distinct(), "links")
        unstage(old)
