"""Lifetime of channels in Gold: a day bitmap per channel, region and month.

``channel_days`` holds, per (region, month) partition, one row per channel with a bit for each
day of the month on which it trended. A run clears the bits of the days it rebuilt and sets those
of the channels it found, in the months concerned only; a late or rebuilt day, also one that a
channel has left, is then right without any other day being read. One more row per partition
tells which of its days are merged, so a partition always says itself how far it is.

Lifetimes are sums over a channel's months. They are joined to ``channel_analytics`` when it is
read, since a value stored with an early day would be out of date after the next.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.sinks import writers

STATE = "channel_title string, merged boolean, days int, region string, month date"
PARTITIONS = ("region", "month")
KEYS = ("region", "month", "merged", "channel_title")
LIFETIME_COLUMNS = ("lifetime_times_trending", "lifetime_first_date", "lifetime_last_date")

Days = Collection[tuple[str, dt.date]]


def _bit() -> Column:
    return F.expr("shiftleft(1, day(trending_date) - 1)")


def _month() -> Column:
    return F.trunc("trending_date", "month").alias("month")


def merged_days(spark: SparkSession, path: str) -> set[tuple[str, dt.date]]:
    """(region, day) pairs in the table (bounded by the days)."""
    table = writers.read_parquet_or_none(spark, path, _schema())
    if table is None:
        return set()
    marks = table.where("merged").select("region", "month", "days").collect()
    return {(r.region, r.month + dt.timedelta(days=i)) for r in marks for i in range(31) if r.days >> i & 1}


def _schema():
    from pyspark.sql.types import StructType

    return StructType.fromDDL(STATE)


def month_bits(channels: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the table from (region, trending_date, channel_title) and the (region, trending_date) rebuilt."""
    held = channels.select("region", _month(), F.lit(False).alias("merged"), "channel_title", _bit().alias("bit"))
    marks = days.select("region", _month(), F.lit(True).alias("merged"), F.lit(None).cast("string").alias("channel_title"), _bit().alias("bit"))
    return held.union(marks).groupBy(*KEYS).agg(F.bit_or("bit").alias("days"))


def merge_days(spark: SparkSession, path: str, channels: DataFrame, rebuilt: Days) -> int:
    """Bring the days ``rebuilt`` into the table from the channels that trended on them. Returns rows written."""
    if not rebuilt:
        return 0
    days = spark.createDataFrame(sorted(rebuilt), "region string, trending_date date")
    new = month_bits(channels, days)
    old = writers.read_parquet_or_none(spark, path, _schema())
    if old is not None:
        clear = days.groupBy("region", _month()).agg(F.bit_or(_bit()).alias("gone"))
        touched = old.where(F.col("month").isin(sorted({d.replace(day=1) for _, d in rebuilt})))  # prunes partitions
        left = touched.join(clear, list(PARTITIONS)).select(*KEYS, F.col("days").bitwiseAND(F.bitwise_not("gone")).alias("days"))
        new = new.unionByName(left).groupBy(*KEYS).agg(F.bit_or("days").alias("days")).where("days <> 0")
    new = writers.write_scratch(new, "channel-days")  # cut off from the files that the write replaces
    return writers.write_partitions(new, path, list(PARTITIONS), "channel_days")


def lifetimes(table: DataFrame) -> DataFrame:
    """Per (region, channel): distinct days, first and last day."""
    first = F.date_add("month", F.bit_count(F.expr("(days & -days) - 1")).cast("int"))
    last = F.date_add("month", (F.length(F.bin("days")) - 1).cast("int"))
    values = (F.sum(F.bit_count("days")).cast("long"), F.min(first), F.max(last))
    return table.where("not merged").groupBy("region", "channel_title").agg(*[v.alias(c) for v, c in zip(values, LIFETIME_COLUMNS)])


def with_lifetime(channel_analytics: DataFrame, table: DataFrame) -> DataFrame:
    """``channel_analytics`` rows with the lifetime columns of their channel."""
    a, b = channel_analytics.alias("a"), lifetimes(table).alias("b")
    same = (F.col("a.region") == F.col("b.region")) & F.col("a.channel_title").eqNullSafe(F.col("b.channel_title"))
    return a.join(b, same, "left").select("a.*", *[f"b.{c}" for c in LIFETIME_COLUMNS])


def read_channels(spark: SparkSession, gold_path: str, days_path: str) -> DataFrame:
    """The written ``channel_analytics`` with its lifetime columns."""
    return with_lifetime(spark.read.parquet(gold_path), spark.read.schema(_schema()).parquet(days_path))
