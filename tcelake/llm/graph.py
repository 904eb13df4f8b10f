"""Connected components of a link table, as Spark joins; no link or label passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tcelake.llm.common import written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``id, component``: every id of the links ``a, b`` with the smallest id it is connected to.

    Union-find in rounds: in each, every node hands its larger neighbours, then all its smaller ones, to the smallest of
    them (large-star, small-star), until every node hangs on its component's smallest id; the number of rounds grows with
    the logarithm of the component sizes. Minima are combined before the shuffle, so hubs are no hot groups there."""
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = written(links, name)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        links = written(small.select("e.u", "e.v").filter("u <> v").distinct(), name)
        # Done when every node has one neighbour and no node is both a root and below one.
        ends = links.select("u", F.lit(1).alias("below"), F.lit(0).alias("root")).unionByName(
            links.select(F.col("v").alias("u"), F.lit(0).alias("below"), F.lit(1).alias("root")))
        seen = ends.groupBy("u").agg(F.sum("below").alias("below"), F.max("root").alias("root"))
        if not seen.filter("below + root > 1").limit(1).count():
            break
    ends = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
