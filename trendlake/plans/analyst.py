"""The eight published analyst questions over Gold (DataFrame form and SQL form).

Both forms run through Catalyst; the SQL text is what an analyst types against Gold
tables registered as views (``register_gold_views``). Every ``LIMIT`` carries a key
tie-break so that the top-k is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.functions.metrics import exact_mean

GROWING = ("surging", "growing")
SLOWING = ("declining", "fading")


def q1_cross_region_creators(channel: DataFrame, k: int = 10) -> DataFrame:
    """Creators trending across regions, by total views."""
    return (
        channel.groupBy("channel_title")
        .agg(
            F.count_distinct("region").alias("regions_trended"),
            F.sum("total_views").alias("total_views"),
            F.sum("total_videos").alias("total_trending_videos"),
        )
        .orderBy(F.col("total_views").desc(), F.col("channel_title").asc_nulls_first())
        .limit(k)
    )


def q2_category_by_market(category: DataFrame) -> DataFrame:
    """Categories dominating each market."""
    return (
        category.groupBy("region", "category_name")
        .agg(
            F.sum("total_views").alias("total_views"),
            exact_mean("avg_engagement_rate", 9).alias("avg_engagement"),
        )
        .orderBy("region", F.col("total_views").desc())
    )


def q3_top_channels_latest(channel: DataFrame, k: int = 10) -> DataFrame:
    """Top-k channels per region on the latest day (scalar subquery on max date)."""
    latest = channel.agg(F.max("trending_date").alias("_latest"))
    return (
        channel.join(F.broadcast(latest), F.col("trending_date") == F.col("_latest"), "left_semi")
        .where(F.col("rank_in_region") <= k)
        .select(
            "region",
            "rank_in_region",
            "channel_title",
            "total_videos",
            F.round(F.col("total_views") / F.lit(1e6), 2).alias("total_views_millions"),
            F.round("avg_engagement_rate", 4).alias("avg_engagement_rate"),
            "primary_views_tier",
            "categories",
        )
        .orderBy("region", "rank_in_region")
    )


def _velocity_top(velocity: DataFrame, labels, ascending: bool, cols, k: int) -> DataFrame:
    growth = F.col("view_growth_pct")
    return (
        velocity.where(F.col("momentum").isin(*labels))
        .orderBy(
            growth.asc() if ascending else growth.desc(),
            "video_id", "region", "trending_date",
        )
        .limit(k)
        .select(*cols)
    )


def q4_still_gaining(velocity: DataFrame, k: int = 20) -> DataFrame:
    return _velocity_top(
        velocity, GROWING, False, ["title", "region", "views", "view_growth_pct", "momentum"], k
    )


def q5_region_interaction(trending: DataFrame) -> DataFrame:
    return (
        trending.groupBy("region")
        .agg(
            F.round(exact_mean("avg_engagement_rate", 9), 2).alias("avg_engagement_rate"),
            F.sum("total_comments").alias("total_comments"),
            F.sum("total_likes").alias("total_likes"),
        )
        .orderBy(F.col("avg_engagement_rate").desc())
    )


def q6_momentum_mix(velocity: DataFrame) -> DataFrame:
    return (
        velocity.groupBy("momentum")
        .agg(
            F.count(F.lit(1)).alias("video_count"),
            exact_mean("view_growth_pct", 2).alias("avg_growth_pct"),
        )
        .orderBy(F.col("avg_growth_pct").desc())
    )


def q7_consistent_channels(channel: DataFrame, k: int = 10, min_videos: int = 3) -> DataFrame:
    return (
        channel.groupBy("channel_title")
        .agg(
            F.round(exact_mean("avg_views_per_video", 4), 1).alias("avg_views"),
            F.sum("total_videos").alias("total_videos"),
        )
        .where(F.col("total_videos") >= min_videos)
        .orderBy(F.col("avg_views").desc(), F.col("channel_title").asc_nulls_first())
        .limit(k)
    )


def q8_losing_momentum(velocity: DataFrame, k: int = 20) -> DataFrame:
    return _velocity_top(
        velocity, SLOWING, True, ["title", "region", "view_growth_pct", "momentum"], k
    )


# --------------------------------------------------------------------------- SQL form
def _mean_sql(c: str, scale: int) -> str:
    return f"try_divide(CAST(SUM(CAST({c} AS DECIMAL(38,{scale}))) AS DOUBLE), COUNT({c}))"


SQL = {
    "q1": """
SELECT channel_title,
       COUNT(DISTINCT region) AS regions_trended,
       SUM(total_views) AS total_views,
       SUM(total_videos) AS total_trending_videos
FROM channel_analytics
GROUP BY channel_title
ORDER BY total_views DESC, channel_title ASC
LIMIT 10""",
    "q2": f"""
SELECT region, category_name,
       SUM(total_views) AS total_views,
       {_mean_sql('avg_engagement_rate', 9)} AS avg_engagement
FROM category_analytics
GROUP BY region, category_name
ORDER BY region, total_views DESC""",
    "q3": """
SELECT region, rank_in_region, channel_title, total_videos,
       ROUND(total_views / 1e6, 2) AS total_views_millions,
       ROUND(avg_engagement_rate, 4) AS avg_engagement_rate,
       primary_views_tier, categories
FROM channel_analytics
WHERE trending_date = (SELECT MAX(trending_date) FROM channel_analytics)
  AND rank_in_region <= 10
ORDER BY region, rank_in_region""",
    "q4": """
SELECT title, region, views, view_growth_pct, momentum
FROM video_velocity
WHERE momentum IN ('surging', 'growing')
ORDER BY view_growth_pct DESC, video_id, region, trending_date
LIMIT 20""",
    "q5": f"""
SELECT region,
       ROUND({_mean_sql('avg_engagement_rate', 9)}, 2) AS avg_engagement_rate,
       SUM(total_comments) AS total_comments,
       SUM(total_likes) AS total_likes
FROM trending_analytics
GROUP BY region
ORDER BY avg_engagement_rate DESC""",
    "q6": f"""
SELECT momentum, COUNT(*) AS video_count,
       {_mean_sql('view_growth_pct', 2)} AS avg_growth_pct
FROM video_velocity
GROUP BY momentum
ORDER BY avg_growth_pct DESC""",
    "q7": f"""
SELECT channel_title,
       ROUND({_mean_sql('avg_views_per_video', 4)}, 1) AS avg_views,
       SUM(total_videos) AS total_videos
FROM channel_analytics
GROUP BY channel_title
HAVING SUM(total_videos) >= 3
ORDER BY avg_views DESC, channel_title ASC
LIMIT 10""",
    "q8": """
SELECT title, region, view_growth_pct, momentum
FROM video_velocity
WHERE momentum IN ('declining', 'fading')
ORDER BY view_growth_pct ASC, video_id, region, trending_date
LIMIT 20""",
}

DATAFRAME = {
    "q1": lambda g: q1_cross_region_creators(g["channel_analytics"]),
    "q2": lambda g: q2_category_by_market(g["category_analytics"]),
    "q3": lambda g: q3_top_channels_latest(g["channel_analytics"]),
    "q4": lambda g: q4_still_gaining(g["video_velocity"]),
    "q5": lambda g: q5_region_interaction(g["trending_analytics"]),
    "q6": lambda g: q6_momentum_mix(g["video_velocity"]),
    "q7": lambda g: q7_consistent_channels(g["channel_analytics"]),
    "q8": lambda g: q8_losing_momentum(g["video_velocity"]),
}


def register_gold_views(spark: SparkSession, gold: dict[str, DataFrame]) -> None:
    """Expose Gold DataFrames (or tables read from paths) to ``spark.sql``."""
    for name, df in gold.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(SQL[name])
