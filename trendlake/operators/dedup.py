"""Latest-row-per-key deduplication.

``row_number() = 1`` over a window is planned by Spark as a ``WindowGroupLimit``: a
partial top-1 runs on each map partition *before* the shuffle, so duplicates (several
snapshots a day) and hot keys are collapsed map-side, and only one row per key and
partition crosses the network.

The order is made total: the leading order columns, then every remaining column
descending. Equal timestamps therefore resolve the same way on every run and engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.sinks.writers import write_scratch

STATS_KEYS = ("video_id", "region", "trending_date")
CATEGORY_KEYS = ("category_id", "region")


def total_order(df: DataFrame, keys: Sequence[str], leading: Sequence[str]) -> list[Column]:
    """Leading columns, then all other non-key columns, each DESC NULLS LAST."""
    rest = [c for c in df.columns if c not in keys and c not in leading]
    return [F.col(c).desc_nulls_last() for c in (*leading, *rest)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    leading: Sequence[str] = ("ingestion_timestamp",),
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (default: ``total_order``)."""
    order = list(order) if order is not None else total_order(df, keys, leading)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def dedup_statistics(df: DataFrame) -> DataFrame:
    """Latest snapshot per (video_id, region, trending_date)."""
    return latest_per_key(df, STATS_KEYS, ("ingestion_timestamp", "ingestion_id"))


def dedup_repeated(df: DataFrame) -> DataFrame:
    """``dedup_statistics`` of rows that were deduplicated before, and are read more than once.

    Keys alone are shuffled, once, to find those of several rows; they are written, and only their
    rows go through the window. All other rows stay where they are.
    """
    keys = [F.col(c).alias(f"_{c}") for c in STATS_KEYS]
    repeated = write_scratch(df.groupBy(*keys).count().where("count > 1").drop("count"), "repeated")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in STATS_KEYS]
    return df.join(repeated, same, "left_anti").unionByName(dedup_statistics(df.join(repeated, same, "left_semi")))


def dedup_categories(df: DataFrame) -> DataFrame:
    """Latest row per (category_id, region)."""
    return latest_per_key(df, CATEGORY_KEYS, ("ingestion_timestamp",))
