"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage_narrow


def _done(edges: DataFrame) -> bool:
    """True where every node hangs on one node that hangs on none: the edges are the components."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("low")), F.struct(F.col("v").alias("n"), F.lit(0).alias("low")))).alias("e"))
    turn = ends.select("e.*").groupBy("n").agg(F.sum("low").alias("low"), F.min("low").alias("top"))
    return not turn.filter("low > 1 OR (low = 1 AND top = 0)").head(1)


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(x, y)``; the label is the smallest node reachable.

    Every step is two groupings and joins over the link table, which is written
    once a step; no group is collected.  Steps grow with the logarithm of the
    longest chain.  An empty link table gives an empty result.
    """
    edges = stage_narrow(links.filter("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "edges")
    while not _done(edges):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: larger neighbours hang on the smallest of the neighbourhood
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: smaller neighbours and the node itself hang on the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                               F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").filter("u <> v").distinct())
        edges = stage_narrow(small, "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
