"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def _sum_of(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``m`` of their ``u`` in ``least`` (u, m).

    Both sides also join on a flag that follows from ``u``.  It changes no result, but a partitioning by node alone is then not
    the join's, so the minimum takes an exchange of its own and adaptive execution may split the edges of a star.
    """
    flag = F.hash("u") == F.lit(0)
    return edges.withColumn("flag", flag).join(least.withColumn("flag", flag), ["u", "flag"]).drop("flag")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: for every node of an edge the smallest node it reaches.

    A step joins edges with a partially aggregated minimum per node; a star of any size is split by its measured bytes
    (:func:`with_least`).  Each round is written to the shared folder, which cuts the lineage; the number of rounds grows with
    the logarithm of the longest path.
    """
    now = stored(edges.where(F.col(a) != F.col(b))
                 .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = _sum_of(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = with_least(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = with_least(large, least)
        small = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = stored(small, "edges")
        was, seen = seen, _sum_of(now)
        if was == seen:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
