"""Explicit schemas for every layer (no inference on any read)."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- Bronze (as landed)
BRONZE_STATS_ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("snippet", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("channelTitle", T.StringType()),
        T.StructField("categoryId", T.StringType()),
        T.StructField("publishedAt", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("defaultAudioLanguage", T.StringType()),
    ])),
    T.StructField("statistics", T.StructType([
        T.StructField("viewCount", T.StringType()),
        T.StructField("likeCount", T.StringType()),
        T.StructField("commentCount", T.StringType()),
        T.StructField("favoriteCount", T.StringType()),
    ])),
    T.StructField("contentDetails", T.StructType([
        T.StructField("duration", T.StringType()),
        T.StructField("definition", T.StringType()),
    ])),
])

BRONZE_STATS_META = T.StructType([
    T.StructField("ingestion_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("video_count", T.LongType()),
    T.StructField("source", T.StringType()),
])

# Document schema (partition columns region/date/hour come from the directory names).
BRONZE_STATS = T.StructType([
    T.StructField("items", T.ArrayType(BRONZE_STATS_ITEM)),
    T.StructField("_pipeline_metadata", BRONZE_STATS_META),
    T.StructField("_corrupt_record", T.StringType()),
])

BRONZE_CATS_ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("snippet", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("assignable", T.BooleanType()),
    ])),
])

BRONZE_CATS_META = T.StructType([
    T.StructField("ingestion_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("source", T.StringType()),
])

BRONZE_CATS = T.StructType([
    T.StructField("items", T.ArrayType(BRONZE_CATS_ITEM)),
    T.StructField("_pipeline_metadata", BRONZE_CATS_META),
    T.StructField("_corrupt_record", T.StringType()),
])

STATS_PARTITIONS = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
])
CATS_PARTITIONS = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("date", T.DateType()),
])

# ---------------------------------------------------------------- Silver
# Flattened fact columns before cleansing (names final, types final).
FLAT_STATS_COLUMNS = [
    "video_id", "region", "title", "channel_title", "category_id", "publish_time",
    "description", "audio_language", "views", "likes", "dislikes", "comment_count",
    "favorite_count", "duration", "definition", "ingestion_timestamp", "ingestion_id",
]

SILVER_STATS = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("channel_title", T.StringType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("description", T.StringType()),
    T.StructField("audio_language", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("dislikes", T.LongType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("favorite_count", T.LongType()),
    T.StructField("duration", T.StringType()),
    T.StructField("definition", T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("ingestion_id", T.StringType()),
    T.StructField("like_ratio", T.DoubleType()),
    T.StructField("engagement_rate", T.DoubleType()),
    T.StructField("views_tier", T.StringType()),
    T.StructField("_processed_at", T.TimestampType()),
    T.StructField("_job_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("trending_date", T.DateType()),
])
SILVER_STATS_COLUMNS = [f.name for f in SILVER_STATS.fields]

SILVER_CATS = T.StructType([
    T.StructField("category_id", T.LongType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("assignable", T.BooleanType()),
    T.StructField("etag", T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("_processed_at", T.TimestampType()),
    T.StructField("region", T.StringType()),
])
SILVER_CATS_COLUMNS = [f.name for f in SILVER_CATS.fields]

# ---------------------------------------------------------------- Gold
GOLD_PARTITION_KEYS = ["region", "trending_date"]

TRENDING_COLUMNS = [
    "total_videos", "total_views", "total_likes", "total_comments", "avg_views_per_video",
    "max_views", "avg_like_ratio", "avg_engagement_rate", "unique_channels",
    "unique_categories", "hd_percentage", "mega_count", "viral_count", "popular_count",
    "trending_count", "emerging_count", "_aggregated_at", "region", "trending_date",
]
CHANNEL_COLUMNS = [
    "channel_title", "total_videos", "total_views", "total_likes", "total_comments",
    "avg_views_per_video", "peak_views", "avg_engagement_rate", "avg_like_ratio",
    "times_trending", "first_trending_date", "last_trending_date", "categories",
    "primary_views_tier", "rank_in_region", "_aggregated_at", "region", "trending_date",
]
CATEGORY_COLUMNS = [
    "category_name", "category_id", "video_count", "total_views", "total_likes",
    "total_comments", "avg_engagement_rate", "avg_like_ratio", "unique_channels",
    "top_video_views", "hd_percentage", "view_share_pct", "rank_on_day", "_aggregated_at",
    "region", "trending_date",
]
VELOCITY_COLUMNS = [
    "video_id", "title", "channel_title", "category_name", "prev_trending_date",
    "days_since_prev", "views", "prev_views", "view_delta", "view_growth_pct",
    "views_per_day", "likes", "prev_likes", "like_delta", "engagement_rate", "views_tier",
    "momentum", "_aggregated_at", "region", "trending_date",
]

GOLD_TABLES = {
    "trending_analytics": TRENDING_COLUMNS,
    "channel_analytics": CHANNEL_COLUMNS,
    "category_analytics": CATEGORY_COLUMNS,
    "video_velocity": VELOCITY_COLUMNS,
}

PROVENANCE_COLUMNS = ("_processed_at", "_job_name", "_aggregated_at")
