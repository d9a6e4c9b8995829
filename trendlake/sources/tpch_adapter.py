"""Adapter: the driver's TPC-H-style tables as snapshot facts (FIXTURES.md section 4).

The test data has no video snapshots, so line items stand in for them:

==================  ===========================================================
video_id            l_partkey as text
region              lower(r_name) of the ordering customer's region
title / channel     p_name / s_name
category_id         the number in p_brand; category name is p_brand
views               0 when l_quantity = 1, else floor(l_extendedprice^2 / 50)
likes / comments    floor(price * discount * 100) / floor(price * tax * 10)
definition          returnflag R -> hd, A -> sd, else unknown
ingestion_ts        l_shipdate (UTC); ingestion_id = yyyyMMdd_HHmmss + order key
trending_date       first day of the ship month (months stand in for days)
==================  ===========================================================

One order is one ingestion envelope (at most a handful of items), which keeps landed
JSON documents bounded however large the tables grow.

Join plan: nation and region are fixed-size (25 and 5 rows by the TPC-H definition) and
are broadcast, last, so that keys and not region names are shuffled. lineitem -> orders and
orders -> customer join two tables that both grow with the scale factor; they carry a
``merge`` hint so that neither the fact table nor orders is ever chosen as a broadcast
build side (at small scale the size estimate would otherwise broadcast line items,
collecting the fact table to the driver). supplier is left to the size-based choice. part
is joined after it by the video id itself, at any size with a ``merge`` hint: line items
move while they are narrow, and what groups them by video (the dedup first) finds them in
place. All of a part's line items meet in one task for it. Only the columns used are read,
so every scan carries a pruned ReadSchema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.session import prepare_session

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# What statistics and categories are made of.
LINE_COLUMNS = (
    "video_id", "region", "p_name", "s_name", "p_brand", "p_type", "o_orderdate", "c_mktsegment", "l_orderkey",
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(c: str):
    return F.col(c).cast("timestamp")


def snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined to their customer region, part and supplier (pruned columns)."""
    prepare_session(spark)
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey"), F.lower(F.col("r_name")).alias("region")
    )
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment"
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ords = orders.join(customer.hint("merge"), orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_orderdate", "c_mktsegment", "c_nationkey"
    )
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    part = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("part_id"), "p_name", "p_brand", "p_type"
    )
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    sold = lines.join(ords.hint("merge"), lines.l_orderkey == ords.o_orderkey)
    return (
        sold.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .withColumn("video_id", F.col("l_partkey").cast("string"))
        .join(part.hint("merge"), F.col("video_id") == F.col("part_id"))
        .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def _category_id():
    return F.regexp_extract(F.col("p_brand"), r"([0-9]+)", 1).try_cast("long")


def raw_statistics(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Flat fact rows (before cleansing and dedup), typed as after flattening Bronze."""
    lines = lines if lines is not None else snapshot_lines(spark, sf_dir)
    price = F.col("l_extendedprice")
    ts = _ts("l_shipdate")
    views = F.when(F.col("l_quantity") == 1, F.lit(0.0)).otherwise(F.floor(price * price / 50))
    return lines.select(
        F.col("video_id"),
        F.col("region"),
        F.col("p_name").alias("title"),
        F.col("s_name").alias("channel_title"),
        _category_id().alias("category_id"),
        _ts("o_orderdate").alias("publish_time"),
        F.col("p_type").alias("description"),
        F.lower(F.col("c_mktsegment")).alias("audio_language"),
        views.cast("long").alias("views"),
        F.floor(price * F.col("l_discount") * 100).cast("long").alias("likes"),
        F.lit(0).cast("long").alias("dislikes"),
        F.floor(price * F.col("l_tax") * 10).cast("long").alias("comment_count"),
        F.lit(0).cast("long").alias("favorite_count"),
        F.concat(F.lit("PT"), F.col("l_quantity").cast("int").cast("string"), F.lit("M")).alias("duration"),
        F.when(F.col("l_returnflag") == "R", F.lit("hd"))
        .when(F.col("l_returnflag") == "A", F.lit("sd"))
        .otherwise(F.lit("unknown"))
        .alias("definition"),
        ts.alias("ingestion_timestamp"),
        F.concat(
            F.date_format(ts, "yyyyMMdd_HHmmss"),
            F.lit("_"),
            F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
        ).alias("ingestion_id"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("trending_date"),
    )


def raw_categories(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Category feed rows: (brand, customer region, ship day)."""
    lines = lines if lines is not None else snapshot_lines(spark, sf_dir)
    cid = _category_id()
    return lines.select(
        cid.alias("category_id"),
        F.col("p_brand").alias("category_name"),
        F.lit(True).alias("assignable"),
        F.md5(F.col("p_brand")).alias("etag"),
        F.col("region"),
        _ts("l_shipdate").alias("ingestion_timestamp"),
    )
