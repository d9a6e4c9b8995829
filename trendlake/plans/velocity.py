"""Velocity runs over a last-snapshot table instead of the history.

The state holds the last two snapshots of every (video, region) in the days merged so far. A run
whose days come after all merged ones (or repeat the latest) reads those days and the state: the
snapshot before a video's first planned day is its last one, or the one before that when the
latest day is built again. The new state comes from the same rows. (A video that a rebuilt latest
day has lost keeps one snapshot: the one before is only looked at when its last one's day is the
latest, which that day then isn't any more.)

Late or rebuilt days change what later days look back to. Then the days that follow them in the
history of their videos are rebuilt as well, from the histories of the videos on those days, and
the state of exactly the videos concerned is taken from Silver again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlake.operators import gold
from trendlake.plans.gold import build_pairs, gold_facts, single_rows
from trendlake.plans.publish import PublishedGold
from trendlake.schemas import GOLD_PARTITION_KEYS, VELOCITY_COLUMNS
from trendlake.sinks import writers
from trendlake.sinks.state import VersionedState

SNAPSHOT = "struct<trending_date:date,views:bigint,likes:bigint>"
STATE = f"video_id string, region string, last {SNAPSHOT}, before {SNAPSHOT}"
KEYS = ("video_id", "region")
STATE_NAME = "last_snapshots"

Days = Collection[tuple[str, dt.date]]


def snapshot_state(spark: SparkSession, path: str, upto: int | None = None) -> VersionedState:
    return VersionedState(spark, path, STATE, upto)


def _snapshot() -> F.Column:
    return F.struct("trending_date", "views", "likes").cast(SNAPSHOT)


def _by_video():
    return Window.partitionBy(*KEYS).orderBy("trending_date")


def last_two(facts: DataFrame) -> DataFrame:
    """State rows from deduplicated facts."""
    earlier = facts.select(*KEYS, "trending_date", _snapshot().alias("last"), F.lag(_snapshot()).over(_by_video()).alias("before"))
    return earlier.groupBy(*KEYS).agg(F.max_by(F.struct("last", "before"), "trending_date").alias("x")).select(*KEYS, "x.last", "x.before")


def forward_pairs(facts: DataFrame, state: DataFrame, first_days: dict[str, dt.date]) -> DataFrame:
    """Facts of the planned days and the state's snapshots before them, each with its ``earlier`` snapshot.

    ``first_days`` has the first planned day of each region; state rows of other regions stay as they are.
    """
    first = F.create_map(*[F.lit(x) for r, d in first_days.items() for x in (r, d)])[F.col("region")]
    superseded = F.col("last.trending_date") >= first  # the latest day is built again
    kept = F.when(F.coalesce(superseded, F.lit(False)), F.col("before")).otherwise(F.col("last"))
    old = state.select(
        *KEYS, kept.alias("s"), F.when(~F.coalesce(superseded, F.lit(False)), F.col("before")).alias("own")
    ).where("s is not null").select(*KEYS, "s.*", "own", F.lit(True).alias("old"))
    carried = [c for c in VELOCITY_COLUMNS if c in facts.columns]
    rows = facts.select(*carried, F.lit(None).cast(SNAPSHOT).alias("own"), F.lit(False).alias("old"))
    both = rows.unionByName(old, allowMissingColumns=True)
    earlier = F.when(F.col("old"), F.col("own")).otherwise(F.lag(_snapshot()).over(_by_video()))
    return both.withColumn("earlier", earlier).drop("own")


def next_state(pairs: DataFrame) -> DataFrame:
    at = F.struct(_snapshot().alias("last"), F.col("earlier").cast(SNAPSHOT).alias("before"))
    return pairs.groupBy(*KEYS).agg(F.max_by(at, "trending_date").alias("x")).select(*KEYS, "x.last", "x.before")


def following_days(stats: DataFrame, written: DataFrame | None, dates: Collection[dt.date]) -> set[dt.date]:
    """Days whose velocity looks back to ``dates``, or will: the next days of the videos on them, and the days whose
    written rows looked back to them (their videos may be gone from there now)."""
    days = stats.select(*KEYS, "trending_date").where(F.col("trending_date") >= F.lit(min(dates)).cast("date"))
    videos = gold.restrict_dates(days, dates).select(*KEYS).distinct()
    history = days.join(videos, list(KEYS), "left_semi").distinct()
    looked = history.select("trending_date", F.lag("trending_date").over(_by_video()).alias("prev"))
    found = looked.where(F.col("prev").isin(list(dates))).select("trending_date").distinct()
    if written is not None:
        found = found.union(written.where(F.col("prev_trending_date").isin(list(dates))).select("trending_date")).distinct()
    return {r.trending_date for r in found.collect()} - set(dates)  # bounded by the days


def refreshed_state(
    stats: DataFrame, state: DataFrame | None, dates: Collection[dt.date], merged: Days, redup: bool = True
) -> DataFrame:
    """The state over the days ``merged`` after ``dates`` were rebuilt: taken from Silver for the videos on them, now or before,
    or, without ``state``, for all videos."""
    lasts: dict[str, dt.date] = {}
    for region, day in merged:
        lasts[region] = max(day, lasts.get(region, day))
    upto = F.create_map(*[F.lit(x) for r, d in lasts.items() for x in (r, d)])[F.col("region")]
    known = stats.where(F.col("trending_date") <= upto)
    if state is None:
        return last_two(gold_facts(known, None, redup))
    touched = F.col("last.trending_date").isin(list(dates)) | F.col("before.trending_date").isin(list(dates))
    videos = gold.restrict_dates(known, dates).select(*KEYS).union(state.where(touched).select(*KEYS)).distinct()
    videos = writers.write_scratch(videos, "videos")
    again = last_two(gold_facts(known.join(videos, list(KEYS), "left_semi"), None, redup))
    return state.join(videos, list(KEYS), "left_anti").unionByName(again)


def plan_velocity(planned: Collection[dt.date], silver_days: Days, applied: dict, existing: Days, forced: Collection[dt.date]) -> list[dt.date]:
    """Of the planned days those with something to do: forced ones, and days of which a region isn't merged or has lost its rows."""
    open_ = {d for r, d in silver_days if d in planned and ((r, d) not in applied or (applied[r, d] and (r, d) not in existing))}
    return sorted(open_ | (set(forced) & set(planned)))


def first_days(dates: Collection[dt.date], silver_days: Days, applied: dict) -> dict[str, dt.date] | None:
    """The first planned day of each region; None if a region has merged days after it, that is, if it is late."""
    found: dict[str, dt.date] = {}
    for region, day in silver_days:
        if day in dates:
            found[region] = min(day, found.get(region, day))
    return None if any(r in found and d > found[r] for r, d in applied) else found


def run_velocity(
    spark: SparkSession, path: str, state_path: str, stats: DataFrame, cats: DataFrame | None,
    dates: list[dt.date], silver_days: Days, run_ts: dt.datetime, published: PublishedGold | None = None,
    single: DataFrame | None = None,
) -> tuple[int, dict]:
    """Build and write the velocity of ``dates``, then commit the state. Returns rows written and what was done.

    With ``published``, the earlier rows and the state are those of that version, and ``path`` is the run's own folder.
    ``single`` is what ``plans.gold.single_rows`` gives of these days at least; without it rows are deduplicated here.
    """
    state = snapshot_state(spark, state_path, published and published.state_version(STATE_NAME))
    applied, rows = state.applied(), state.rows()
    firsts = first_days(dates, silver_days, applied) if rows is not None else None
    if firsts is not None:
        facts = gold_facts(gold.restrict_dates(stats if single is None else single, dates), cats, redup=single is None)
        pairs = writers.write_scratch(forward_pairs(facts, rows, firsts), "velocity-pairs")
        made, new, done = pairs.where("not old and earlier.views is not null").drop("old"), next_state(pairs), set(dates)
    else:
        written = published.read("video_velocity") if published else writers.read_parquet_or_none(spark, path)
        written = written if rows is not None else None
        merged = set(applied) | {(r, d) for r, d in silver_days if d in dates}
        all_days = {d for _, d in silver_days}
        # All days of Silver and of the state: no other day is left to follow, and no video stays as it was.
        whole = rows is None or set(dates) >= all_days | {d for _, d in merged}
        done = set(dates) | (set() if whole else following_days(stats, written, dates))
        every = done >= all_days  # then no video need be picked out
        redup = single is None
        if not redup:  # earlier days as well: their keys are compared, no other column
            stats = single if set(dates) >= all_days else single_rows(stats)
        made = build_pairs(stats, cats, None if every else sorted(done), redup)
        new = refreshed_state(stats, None if whole else rows, dates, merged, redup)
    # growth is made behind the shuffle by region and day
    n = writers.write_partitions(made, path, GOLD_PARTITION_KEYS, "video_velocity", lambda rows: gold.velocity_of(rows, run_ts))
    counts = _written(spark, path, done)
    known = set(applied) | {(r, d) for r, d in silver_days if d in dates}
    version = state.commit(new, {k: counts.get(k, 0) if k[1] in done else applied[k] for k in known})
    named = {"state": version} if published else {}
    return n, named | {"mode": "late" if firsts is None and rows is not None else "first" if rows is None else "forward", "days": [str(d) for d in sorted(done)]}


def _written(spark: SparkSession, path: str, days: Collection[dt.date]) -> dict[tuple[str, dt.date], int]:
    table = writers.read_parquet_or_none(spark, path)
    if table is None:
        return {}
    counts = gold.restrict_dates(table, days).groupBy(*GOLD_PARTITION_KEYS).count().collect()  # bounded by the days
    return {(r.region, r.trending_date): r["count"] for r in counts}
