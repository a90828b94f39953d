"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``v`` and ``least``: the least vertex that each vertex of an edge reaches.  ``edges`` has ``u`` and ``v``.

    Alternates large stars (a vertex hands its larger neighbours to its least neighbour) and small stars (the same for the
    others) until the edges stay as they are; the number of rounds grows with the logarithm of the largest component.
    Only a count and a hash of the edges come to the driver.
    """
    edges = staged(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == seen or now[0] == 0:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("least"))
        seen = tuple(now)
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = staged(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u != v").distinct())
