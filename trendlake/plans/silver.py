"""Silver builders: flat rows -> clean, enriched, deduplicated tables, and their merge into Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendlake.operators import clean, dedup, dq
from trendlake.schemas import SILVER_CATS_COLUMNS, SILVER_STATS, SILVER_STATS_COLUMNS
from trendlake.sinks import writers

DEFAULT_JOB_NAME = "bronze_to_silver"
SILVER_KEYS = ("region", "trending_date")


def build_silver_statistics(flat: DataFrame, run_ts=None, job_name: str = DEFAULT_JOB_NAME) -> DataFrame:
    """clean_statistics: cleanse -> latest snapshot per (video, region, date) -> metrics.

    Metrics are functions of counters that the order of snapshots has before them, so they
    choose no row: they are made after the dedup and not shuffled for it.
    """
    return finish_statistics(latest_statistics(flat), run_ts, job_name)


def latest_statistics(flat: DataFrame) -> DataFrame:
    """The latest snapshots, cleansed, with what Silver holds of them but metrics and provenance."""
    return dedup.dedup_statistics(clean.clean_statistics(flat))


def finish_statistics(latest: DataFrame, run_ts=None, job_name: str = DEFAULT_JOB_NAME) -> DataFrame:
    return clean.add_provenance(clean.add_metrics(latest), run_ts, job_name).select(*SILVER_STATS_COLUMNS)


def build_silver_categories(flat: DataFrame, run_ts=None) -> DataFrame:
    """clean_reference_data: one row per (category_id, region), latest ingestion."""
    df = dedup.dedup_categories(clean.clean_categories(flat))
    df = clean.add_provenance(df, run_ts)
    return df.select(*SILVER_CATS_COLUMNS)


def silver_run_metrics(flat: DataFrame) -> DataFrame:
    """Counts reported by a Silver run, as one row from one aggregate:

    raw_rows, null_id_dropped, duplicates_removed (valid rows minus distinct keys),
    clean_rows. Null-id rows and duplicates are kept apart (the reference lumped them).
    """
    df = clean.normalize_statistics(flat)
    valid = clean.has_video_id()
    key = F.when(valid, F.struct(*dedup.STATS_KEYS))
    counts = df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~valid).alias("null_id_dropped"),
        F.count_distinct(key).alias("clean_rows"),
    )
    return counts.select(
        "raw_rows",
        "null_id_dropped",
        (F.col("raw_rows") - F.col("null_id_dropped") - F.col("clean_rows")).alias("duplicates_removed"),
        "clean_rows",
    )


def merge_silver(
    spark: SparkSession, flat: DataFrame, silver_path: str, run_ts, job_name: str, warnings: Observation | None = None
) -> int:
    """Upsert flat rows into Silver: they and the existing rows of exactly the partitions they
    touch (the null date among them) are deduplicated together. Returns rows written."""
    # one parse of the input: what follows reads the clean rows back
    new = writers.write_scratch(clean.add_metrics(clean.clean_statistics(flat)), "silver-new")
    touched = new.select(*SILVER_KEYS).distinct()
    days = [r[0] for r in touched.select("trending_date").distinct().collect()]  # bounded by days
    if not days:
        return 0
    merged = new
    existing = writers.read_parquet_or_none(spark, silver_path, SILVER_STATS)
    if existing is not None:
        wanted = F.col("trending_date").isin([d for d in days if d is not None])
        if None in days:
            wanted = wanted | F.col("trending_date").isNull()
        p, t = existing.where(wanted).alias("p"), touched.alias("t")
        same = F.col("p.region").eqNullSafe(F.col("t.region")) & F.col("p.trending_date").eqNullSafe(F.col("t.trending_date"))
        merged = new.unionByName(p.join(t, same, "left_semi").drop("_processed_at", "_job_name"))
    out = clean.add_provenance(dedup.dedup_statistics(merged), run_ts, job_name).select(*SILVER_STATS_COLUMNS)
    # cut off from the files that the write replaces
    out = writers.write_scratch(out, "silver-merged")
    if warnings is not None:
        out = out.observe(warnings, *dq.prewrite_warnings(out))
    return writers.write_partitions(out, silver_path, list(SILVER_KEYS), "silver_merge")
