"""Connected components by alternating star contractions.

Each round hangs every node's larger neighbours on its smallest neighbour, then
every node's smaller neighbours likewise, until only stars are left.  A round is
a few joins and aggregates over the edges; it is written to the shared folder, so
a lost executor costs a round at most, and edges never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every node of ``edges`` (u, v): component is the
    smallest id that can be reached.  Loops, repeated and reversed edges are
    allowed; edges with a null end are ignored."""
    stars = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(stars)
    while before[0]:
        both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v"))))
        stars = stage(small.distinct(), name)
        after = mark(stars)
        if tuple(after) == tuple(before):
            break
        before = after
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
