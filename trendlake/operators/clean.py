"""Silver cleansing and derived metrics (pure DataFrame -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.functions import casts, metrics

COUNTER_COLUMNS = ("views", "likes", "dislikes", "comment_count", "favorite_count")
METRIC_COLUMNS = ("like_ratio", "engagement_rate", "views_tier")


def _as_timestamp(df: DataFrame, name: str):
    """Text -> timestamp (tolerant); an existing timestamp column is kept as is."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        return F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(name).cast("timestamp")
    return casts.to_ts(name)


def has_video_id():
    """True when video_id is neither null nor empty (never null itself)."""
    return F.coalesce(F.col("video_id") != F.lit(""), F.lit(False))


def valid_video_id(df: DataFrame) -> DataFrame:
    """Drop rows whose video_id is null or empty."""
    return df.where(has_video_id())


def clean_statistics(flat: DataFrame) -> DataFrame:
    """Cleansing of flat fact rows.

    * drop null/empty video_id
    * region -> lower(trim(region))
    * ingestion_timestamp, publish_time -> timestamp (junk -> null)
    * trending_date = to_date(ingestion_timestamp) unless the input already carries one
    * null counters -> 0
    * definition outside {hd, sd} -> unknown
    """
    df = normalize_statistics(valid_video_id(flat))
    df = df.withColumns({c: casts.zero_if_null(c) for c in COUNTER_COLUMNS})
    return df.withColumn("definition", metrics.normalize_definition("definition"))


def normalize_statistics(flat: DataFrame) -> DataFrame:
    """Region, timestamps and trending_date (no rows dropped)."""
    df = flat.withColumns({
        "region": casts.norm_region("region"),
        "ingestion_timestamp": _as_timestamp(flat, "ingestion_timestamp"),
        "publish_time": _as_timestamp(flat, "publish_time"),
    })
    if "trending_date" not in df.columns:
        df = df.withColumn("trending_date", F.to_date("ingestion_timestamp"))
    return df


def add_metrics(df: DataFrame) -> DataFrame:
    """like_ratio, engagement_rate (percent, 4 dp) and views_tier."""
    return df.withColumns({
        "like_ratio": metrics.like_ratio(),
        "engagement_rate": metrics.engagement_rate(),
        "views_tier": metrics.views_tier(),
    })


def clean_categories(flat: DataFrame) -> DataFrame:
    """Drop categories with a null id or name; parse the ingestion timestamp."""
    df = flat.where(F.col("category_id").isNotNull() & F.col("category_name").isNotNull())
    return df.withColumns({
        "region": casts.norm_region("region"),
        "ingestion_timestamp": _as_timestamp(df, "ingestion_timestamp"),
    })


def add_provenance(df: DataFrame, run_ts, job_name: str | None = None) -> DataFrame:
    """``_processed_at`` from an injected run clock (deterministic) and ``_job_name``."""
    cols = {"_processed_at": F.lit(run_ts).cast("timestamp")}
    if job_name is not None:
        cols["_job_name"] = F.lit(job_name)
    return df.withColumns(cols)
