"""Silver -> Gold composition (pure; the job in ``plans.jobs`` adds planning and I/O)."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.operators import dedup, gold, lookup

GOLD_BUILDERS = ("trending_analytics", "channel_analytics", "category_analytics", "video_velocity")

# Silver columns the Gold builders read; everything else (descriptions, durations, ...)
# is pruned at the Parquet scan.
GOLD_INPUT_COLUMNS = (
    "video_id", "region", "trending_date", "title", "channel_title", "category_id", "views",
    "likes", "comment_count", "like_ratio", "engagement_rate", "views_tier", "definition",
    "ingestion_timestamp", "ingestion_id",
)


def gold_facts(silver_stats: DataFrame, silver_categories: DataFrame | None, redup: bool = True) -> DataFrame:
    """Silver facts ready for the builders: (re-)deduplicated, category names joined,
    rows with a null trending_date excluded (they can never be planned).

    The re-dedup guards against duplicate Silver partitions. Its tie-break is total over
    the columns read, and rows equal on all of them give the same Gold output, so only
    ``GOLD_INPUT_COLUMNS`` are read.
    """
    facts = silver_stats.select(*GOLD_INPUT_COLUMNS).where(F.col("trending_date").isNotNull())
    if redup:
        facts = dedup.dedup_statistics(facts)
    table = lookup.category_lookup(silver_categories) if silver_categories is not None else None
    return lookup.join_categories(facts, table)


def single_rows(silver_stats: DataFrame) -> DataFrame:
    """The columns and rows that ``gold_facts`` keeps of Silver, for what is made of them more than once
    (``gold_facts`` and ``build_pairs`` with ``redup=False``)."""
    return dedup.dedup_repeated(silver_stats.select(*GOLD_INPUT_COLUMNS).where(F.col("trending_date").isNotNull()))


def velocity_history(silver_stats: DataFrame, dates: Collection | None) -> DataFrame:
    """The Silver rows that velocity of ``dates`` can depend on: up to the last of them, the
    histories of the (video, region) pairs that trended on one of them.

    Both cuts are on the scan's rows, below the dedup: a daily run reads the key columns of
    its day, and shuffles and sorts the histories of that day's videos only.
    """
    if dates is None:
        return silver_stats
    past = silver_stats.where(F.col("trending_date") <= F.lit(max(dates)).cast("date"))
    trended = gold.restrict_dates(silver_stats, dates).select("video_id", "region").distinct()
    return past.join(trended, ["video_id", "region"], "left_semi")


def build_velocity(
    silver_stats: DataFrame, silver_categories: DataFrame | None, dates: Collection | None = None, run_ts=None
) -> DataFrame:
    """Velocity of ``dates`` (None = every date) straight from Silver, as the job builds it."""
    return gold.velocity_of(build_pairs(silver_stats, silver_categories, dates), run_ts)


def build_pairs(
    silver_stats: DataFrame, silver_categories: DataFrame | None, dates: Collection | None = None, redup: bool = True
) -> DataFrame:
    """What velocity of ``dates`` is made of (``gold.velocity_pairs``), straight from Silver."""
    if dates is not None and not dates:
        silver_stats = silver_stats.limit(0)
        dates = None
    facts = gold_facts(velocity_history(silver_stats, dates), silver_categories, redup)
    return gold.velocity_pairs(facts, dates)


def build_gold(facts: DataFrame, dates: Iterable | DataFrame | None = None, run_ts=None, tables: Iterable = GOLD_BUILDERS) -> dict[str, DataFrame]:
    """The named Gold tables for ``dates`` (None = every date), from facts of all dates.

    trending/channel/category roll up one aggregate of the processed dates; velocity reads
    the whole history and is restricted after its LAG.
    """
    day_facts = gold.restrict_dates(facts, dates)
    cube = gold.day_cube(day_facts)
    makers = {
        "trending_analytics": lambda: gold.trending_analytics(day_facts, run_ts, cube),
        "channel_analytics": lambda: gold.channel_analytics(day_facts, run_ts, cube),
        "category_analytics": lambda: gold.category_analytics(day_facts, run_ts, cube),
        "video_velocity": lambda: gold.video_velocity(facts, dates, run_ts),
    }
    return {t: makers[t]() for t in tables}
