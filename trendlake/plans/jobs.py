"""Jobs: land -> silver -> gate -> gold, each a plain function returning a report.

No scheduler: ``run_medallion`` calls the stages in order and stops at the gate. Every
stage reads its inputs from the lake (so it can be retried on its own), writes with
dynamic partition overwrite (so a retry leaves the same rows) and returns counts taken
from ``Observation`` metrics on its writes.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendlake.operators import clean, dq, flatten, gold, incremental, landing
from trendlake.plans import lifetime, sketches, velocity
from trendlake.plans.gold import GOLD_BUILDERS, gold_facts, single_rows
from trendlake.plans.publish import PublishedGold
from trendlake.plans.silver import build_silver_categories, finish_statistics, latest_statistics, merge_silver
from trendlake.schemas import BRONZE_STATS, GOLD_PARTITION_KEYS, SILVER_CATS, SILVER_STATS, STATS_PARTITIONS
from trendlake.session import prepare_session
from trendlake.sinks import writers
from trendlake.sources import bronze, quarantine


@dataclass(frozen=True)
class LakePaths:
    root: str

    def _p(self, *parts: str) -> str:
        return os.path.join(self.root, *parts) if "://" not in self.root else "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze_stats(self) -> str:
        return self._p("bronze", "raw_statistics")

    @property
    def bronze_cats(self) -> str:
        return self._p("bronze", "raw_statistics_reference_data")

    @property
    def silver_stats(self) -> str:
        return self._p("silver", "statistics")

    @property
    def silver_cats(self) -> str:
        return self._p("silver", "reference_data")

    def quarantine(self, feed: str) -> str:
        return self._p("quarantine", feed)

    def gold(self, table: str) -> str:
        return self._p("gold", table)

    @property
    def published(self) -> str:
        return self._p("gold_published")

    def state(self, table: str) -> str:
        return self._p("state", table)


@dataclass
class RunResult:
    stage: str
    status: str  # ok | noop | failed | dq_failed
    metrics: dict = field(default_factory=dict)
    report: DataFrame | None = None


# ----------------------------------------------------------------------- landing (K1/K2)
def land(
    spark: SparkSession, paths: LakePaths, stats_rows: DataFrame, cat_rows: DataFrame | None = None, kept: bool = False
) -> RunResult:
    """Write flat snapshot rows as raw envelopes to Bronze (append). ``kept``: the rows are read from files as they are."""
    prepare_session(spark)
    pages = landing.statistics_pages(stats_rows, kept=kept, by_folder=True)
    writers.write_bronze(landing.statistics_documents(pages), paths.bronze_stats, list(landing.FOLDER), spread=False)
    if cat_rows is not None:
        writers.write_bronze(landing.category_envelopes(cat_rows, kept=kept), paths.bronze_cats, ["region", "date"])
    return RunResult("land", "ok")


# ----------------------------------------------------------------------- bronze -> silver
def bronze_to_silver(
    spark: SparkSession,
    paths: LakePaths,
    regions: tuple[str, ...],
    run_ts: dt.datetime,
    multi_line: bool = False,
    landing_dates: tuple | None = None,
    job_name: str = "bronze_to_silver",
) -> RunResult:
    """C1 + C2. Aborts only when no configured region yields rows (facts); the category
    part is non-fatal."""
    prepare_session(spark)
    if not writers.path_exists(spark, paths.bronze_stats):
        missing = bronze.report_from_metrics({}, regions)
        return RunResult("bronze_to_silver", "failed", {"regions": missing})
    raw = bronze.read_bronze_statistics(spark, paths.bronze_stats, regions, multi_line, landing_dates)
    if quarantine.batches(spark, paths.quarantine("statistics")):
        mended = quarantine.read_replayed(spark, paths.quarantine("statistics"), BRONZE_STATS, STATS_PARTITIONS, regions, landing_dates)
        raw = raw.unionByName(mended)
    # One parse of Bronze: the per-region report and the run's counts are observations on the
    # same plan that writes Silver.
    docs = Observation(f"bronze_report_{run_ts:%Y%m%d%H%M%S%f}")
    flat = flatten.flatten_statistics(raw.observe(docs, *bronze.report_exprs(regions)))
    counts = Observation(f"silver_counts_{run_ts:%Y%m%d%H%M%S%f}")
    raw_rows, no_id = F.count(F.lit(1)).alias("raw_rows"), F.count_if(~clean.has_video_id()).alias("null_id_dropped")
    flat = flat.observe(counts, raw_rows, no_id)
    warn = Observation(f"silver_warnings_{run_ts:%Y%m%d%H%M%S%f}")
    keys = ["region", "trending_date"]
    if landing_dates is None:
        def finish(latest: DataFrame) -> DataFrame:
            silver = finish_statistics(latest, run_ts, job_name)
            return silver.observe(warn, *dq.prewrite_warnings(silver))

        rows = writers.write_partitions(latest_statistics(flat), paths.silver_stats, keys, "silver_stats", finish)
    else:
        # Landing days bound what is read, not what a partition holds: what other days landed
        # for the touched partitions is in Silver, and competes with the new rows.
        rows = merge_silver(spark, flat, paths.silver_stats, run_ts, job_name, warn)
    per_region = bronze.report_from_metrics(writers.observed(docs), regions)
    for region in per_region.values():  # of Bronze itself, from its documents' own clocks
        region["stale"] = dq.is_stale(region["latest"], run_ts)
    bad = [region for region, m in per_region.items() if m["bad_documents"]]
    dead = quarantine.collect(spark, paths.bronze_stats, paths.quarantine("statistics"), BRONZE_STATS, STATS_PARTITIONS, bad, multi_line) if bad else 0
    if rows == 0 or all(m["failed"] for m in per_region.values()):
        # No region yielded rows: nothing was written (a zero-row dynamic overwrite
        # touches no partition), and the run fails like the reference's abort.
        return RunResult("bronze_to_silver", "failed", {"regions": per_region, "quarantined": dead})
    seen = writers.observed(counts)
    metrics = {"silver_rows": rows, "warnings": writers.observed(warn), "regions": per_region, "quarantined": dead, **seen}
    if landing_dates is None:
        metrics["duplicates_removed"] = seen["raw_rows"] - seen["null_id_dropped"] - rows

    try:
        # All category documents, whatever the landing days: a region's partition holds them all.
        cats_raw = bronze.read_bronze_categories(spark, paths.bronze_cats, regions, multi_line)
        cats = build_silver_categories(flatten.flatten_categories(cats_raw), run_ts)
        metrics["category_rows"] = writers.write_partitions(cats, paths.silver_cats, ["region"], "silver_cats")
    except Exception as e:  # noqa: BLE001 - categories are non-fatal (Gold reads Unknown)
        metrics["category_error"] = str(e)
    return RunResult("bronze_to_silver", "ok", metrics)


# ----------------------------------------------------------------------- DQ gate (C3/D12)
def quality_gate(
    spark: SparkSession,
    paths: LakePaths,
    config: dq.DQConfig,
    now: dt.datetime,
) -> RunResult:
    prepare_session(spark)
    tables = {}
    for name, path in ((dq.FACT_TABLE, paths.silver_stats), (dq.DIM_TABLE, paths.silver_cats)):
        try:
            tables[name] = writers.read_parquet_or_none(spark, path)
        except Exception as error:  # noqa: BLE001 - becomes the table's failed row
            tables[name] = error
    results = dq.run_checks(spark, tables, config, now)
    v = dq.verdict(results).first()
    status = "ok" if v["quality_passed"] else "dq_failed"
    return RunResult("quality_gate", status, v.asDict(), results)


# ----------------------------------------------------------------------- silver -> gold (C4)
def silver_to_gold(
    spark: SparkSession,
    paths: LakePaths,
    run_date: dt.date,
    run_ts: dt.datetime,
    dates_override=None,
    catalog: str | None = None,
    publish: bool = False,
) -> RunResult:
    """Gold's planned days. With ``catalog``, a prefix of table names, what Gold has is asked of the catalog, and its
    tables are registered, or refreshed, after they are written. With ``publish``, the run's tables come into view
    together (``plans.publish``), under ``paths.published`` instead of ``paths.gold``."""
    if publish and catalog is not None:
        raise ValueError("published tables are read through their manifest, not the catalog")
    prepare_session(spark)
    published = PublishedGold(spark, paths.published) if publish else None
    target = published.staged if published else paths.gold
    silver_days = incremental.partition_days(spark, paths.silver_stats)
    if not silver_days:
        return RunResult("silver_to_gold", "failed", {"error": "clean_statistics is empty"})
    if published:
        existing = {t: published.days(t) for t in GOLD_BUILDERS}
    elif catalog is None:
        existing = {t: incremental.partition_days(spark, paths.gold(t)) for t in GOLD_BUILDERS}
    else:
        existing = {t: incremental.catalog_days(spark, catalog + t) for t in GOLD_BUILDERS}
    existing |= {
        "channel_days": lifetime.merged_days(spark, paths.state("channel_days")),
        "daily_sketches": incremental.dated_regions(spark, paths.state("daily_sketches")),
    }
    plans = incremental.plan_date_sets(silver_days, existing, run_date, dates_override)
    if not any(plans.values()):
        return RunResult("silver_to_gold", "noop", {"planned": {}})
    metrics: dict = {"planned": {t: [str(d) for d in plans[t]] for t in GOLD_BUILDERS}}
    stats = spark.read.schema(SILVER_STATS).parquet(paths.silver_stats)
    cats = _dimension(spark, paths, metrics)

    written = metrics["rows_written"] = {}
    daily = {
        "trending_analytics": gold.trending_analytics,
        "channel_analytics": gold.channel_analytics,
        "category_analytics": gold.category_analytics,
    }
    dates = sorted({d for t in (*daily, "channel_days") for d in plans[t]})
    days = {d for t in GOLD_BUILDERS for d in plans[t]} | set(dates)
    single = single_rows(gold.restrict_dates(stats, sorted(days))) if days else None
    if dates:
        # Facts of the planned days are aggregated once, to the rows the daily builders roll up,
        # and kept as they were dealt: channels are rolled up and told apart in place.
        facts = gold_facts(gold.restrict_dates(single, dates), cats, redup=False)
        cube = writers.write_bucketed(gold.day_cube(facts), "day_cube", gold.CUBE_DEALT, gold.CUBE_DEALT)
        for table, build in daily.items():
            rows = build(facts, run_ts, cube=gold.restrict_dates(cube, plans[table]))
            written[table] = _write_gold(target(table), table, rows)
    written["video_velocity"], done = _run_velocity(spark, paths, stats, single, cats, plans["video_velocity"], existing["video_velocity"], silver_days, run_date, run_ts, dates_override, published)
    metrics |= {"velocity": done} if done else {}
    if published:
        rebuilt = {t: set(plans[t]) for t in daily} | {"video_velocity": {dt.date.fromisoformat(d) for d in done.get("days", ())}}
        states = {velocity.STATE_NAME: done["state"]} if done else {}
        if done or any(rebuilt.values()):
            metrics["version"] = published.publish(rebuilt, states)
    # Beside Gold, and planned for themselves: days that a dead run hasn't merged are planned again.
    if dates:
        channels = gold.restrict_dates(cube, plans["channel_days"]).select("region", "trending_date", "channel_title").distinct()
        rebuilt = {(r, d) for r, d in silver_days if d in plans["channel_days"]}
        lifetime.merge_days(spark, paths.state("channel_days"), channels, rebuilt)
    if plans["daily_sketches"]:
        made = sketches.daily_sketches(gold.restrict_dates(stats, plans["daily_sketches"]))
        writers.write_partitions(made, paths.state("daily_sketches"), sketches.PARTITIONS, "daily_sketches")
    for table, rows in written.items() if catalog is not None else ():
        if rows:
            writers.register_table(spark, catalog + table, paths.gold(table))
    status = "ok" if any(written.values()) else "noop"
    return RunResult("silver_to_gold", status, metrics)


def _run_velocity(spark, paths, stats, single, cats, planned, existing, silver_days, run_date, run_ts, dates_override, published) -> tuple[int, dict]:
    path = published.staged("video_velocity") if published else paths.gold("video_velocity")
    # A published state has a folder of its own: its versions are the manifest's to name.
    state_path = f"{paths.published}/{velocity.STATE_NAME}" if published else paths.state(velocity.STATE_NAME)
    state = velocity.snapshot_state(spark, state_path, published and published.state_version(velocity.STATE_NAME))
    forced = planned if dates_override is not None else {run_date}
    todo = velocity.plan_velocity(planned, silver_days, state.applied(), existing, forced)
    if not todo:
        return 0, {}
    return velocity.run_velocity(spark, path, state_path, stats, cats, todo, silver_days, run_ts, published, single)


def _dimension(spark: SparkSession, paths: LakePaths, metrics: dict) -> DataFrame | None:
    """The category columns that Gold reads, copied out so that a file that can't be read
    shows here: without the dimension, categories are Unknown and the run goes on."""
    try:
        cats = writers.read_parquet_or_none(spark, paths.silver_cats, SILVER_CATS)
        if cats is None:
            return None
        return writers.write_scratch(cats.select("category_id", "category_name", "ingestion_timestamp", "region"), "categories")
    except Exception as e:  # noqa: BLE001 - any failure to read is non-fatal
        metrics["category_error"] = str(e)
        return None


def _write_gold(path: str, table: str, df: DataFrame) -> int:
    # An empty frame writes nothing and leaves every partition as it was.
    # Channels come from a global sort by region and day, and are written in it.
    return writers.write_partitions(df, path, GOLD_PARTITION_KEYS, table, spread=table != "channel_analytics")


# ----------------------------------------------------------------------- whole run (C5)
def run_medallion(
    spark: SparkSession,
    paths: LakePaths,
    regions: tuple[str, ...],
    run_ts: dt.datetime,
    dq_config: dq.DQConfig | None = None,
    multi_line: bool = False,
    landing_dates: tuple | None = None,
    dates_override=None,
) -> list[RunResult]:
    """Silver, gate, Gold in order; stops at the first failure or a closed gate. A backfill
    gives the landing days to read, the dates to rebuild, or both."""
    out = [bronze_to_silver(spark, paths, regions, run_ts, multi_line, landing_dates)]
    if out[-1].status != "ok":
        return out
    cfg = dq_config or dq.DQConfig(valid_regions=tuple(regions))
    out.append(quality_gate(spark, paths, cfg, run_ts))
    if out[-1].status != "ok":
        return out
    out.append(silver_to_gold(spark, paths, run_ts.date(), run_ts, dates_override))
    return out
