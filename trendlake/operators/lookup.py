"""Category lookup (one name per category_id) and the fact -> category join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.functions.metrics import UNKNOWN_CATEGORY

def category_lookup(categories: DataFrame) -> DataFrame:
    """category_id -> category_name across regions.

    Deterministic choice when regions disagree: the name from the latest ingestion wins,
    then the greatest region, then the greatest name. Partial aggregation keeps the
    shuffle at one row per id and map partition.
    """
    pick = F.struct(
        F.col("ingestion_timestamp"), F.col("region"), F.col("category_name")
    )
    return (
        categories.select(
            F.col("category_id").cast("long").alias("category_id"),
            F.col("category_name").cast("string").alias("category_name"),
            "ingestion_timestamp",
            "region",
        )
        .where(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(F.max_by("category_name", pick).alias("category_name"))
    )


def join_categories(facts: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Left join facts to the lookup on category_id; a missing name is ``Unknown``.

    ``lookup=None`` (dimension unreadable) still yields a ``category_name`` column. There is
    no hint: a lookup below the byte threshold is broadcast, by statistics or at run time,
    and a larger one shuffles.
    """
    if lookup is None:
        return facts.withColumn("category_name", F.lit(UNKNOWN_CATEGORY))
    joined = facts.join(lookup, on="category_id", how="left")
    return joined.withColumn("category_name", F.coalesce("category_name", F.lit(UNKNOWN_CATEGORY)))
