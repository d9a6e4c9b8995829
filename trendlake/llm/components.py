"""Connected components by alternating large-star and small-star rounds.

Each round joins the edges with one minimum per node, so its size stays that of the edges;
nothing is gathered per node or on the driver but a count and a checksum. Every round is a
written table in the shared scratch folder. The number of rounds grows with the logarithm of
the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm import common


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v, both long); the root is the least node.

    Self links, repeated links and both directions are allowed; rows with a null are ignored.
    """
    tidy = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = common.materialize(tidy, "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == before:
            break
        before = state
        now = common.materialize(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
