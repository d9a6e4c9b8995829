"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each runs the library's own operators over the whole driver tables through the adapter
(``sources.tpch_adapter``). Provenance columns (run clock, job name) are left out of the
returned frames, and array columns are returned as sorted, comma-joined text, so that
the result can be compared value for value with an independent SQL engine.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.functions.metrics import TIER_NAMES
from trendlake.operators import clean, dedup, dq, evolution, flatten, gold, incremental, landing, lookup, sampling
from trendlake.plans import analyst, jobs, lifetime, sketches, velocity
from trendlake.plans.gold import GOLD_BUILDERS, GOLD_INPUT_COLUMNS, build_gold, build_velocity, gold_facts
from trendlake.plans.publish import PublishedGold
from trendlake.plans.silver import build_silver_categories, build_silver_statistics, silver_run_metrics
from trendlake.schemas import (
    BRONZE_STATS,
    CATEGORY_COLUMNS,
    PROVENANCE_COLUMNS,
    SILVER_CATS,
    SILVER_CATS_COLUMNS,
    SILVER_STATS,
    SILVER_STATS_COLUMNS,
    STATS_PARTITIONS,
    TRENDING_COLUMNS,
    VELOCITY_COLUMNS,
)
from trendlake.session import prepare_session, scratch_dir
from trendlake.sinks import writers
from trendlake.sources import bronze, quarantine
from trendlake.sources import tpch_adapter as adapter

Query = Callable[[SparkSession, str], DataFrame]


def _public(df: DataFrame) -> DataFrame:
    """Drop provenance columns; arrays -> joined text."""
    cols = []
    for f in df.schema.fields:
        if f.name in PROVENANCE_COLUMNS:
            continue
        if f.dataType.typeName() == "array":
            cols.append(F.array_join(F.array_sort(F.col(f.name)), ",").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ shared stages
def raw_stats(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    prepare_session(spark)
    return adapter.raw_statistics(spark, sf, lines)


def raw_cats(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    prepare_session(spark)
    return adapter.raw_categories(spark, sf, lines)


def silver_stats(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return build_silver_statistics(raw_stats(spark, sf, lines))


def silver_cats(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return build_silver_categories(raw_cats(spark, sf, lines))


def lines_once(spark: SparkSession, sf: str) -> DataFrame:
    """The adapter's joined lines, written by video, for what reads them more than once: as statistics and as categories,
    or for a count and for the rows."""
    prepare_session(spark)
    lines = adapter.snapshot_lines(spark, sf).select(*adapter.LINE_COLUMNS)
    return writers.write_bucketed(lines, "lines", "video_id", ("video_id",))


def dimension(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """The category columns that Gold reads, written as the job does: the lookup's size is then
    known when facts join it, and they aren't shuffled to its few ids."""
    cats = silver_cats(spark, sf, lines).select("category_id", "category_name", "ingestion_timestamp", "region")
    return writers.write_scratch(cats, "categories")


def facts(spark: SparkSession, sf: str) -> DataFrame:
    lines = lines_once(spark, sf)
    return gold_facts(silver_stats(spark, sf, lines), dimension(spark, sf, lines))


class GoldTables(dict):
    """Gold tables over the adapter's Silver, each built when it is first asked for."""

    def __init__(self, spark: SparkSession, sf: str) -> None:
        super().__init__()
        self.facts = facts(spark, sf)

    def __missing__(self, table: str) -> DataFrame:
        self[table] = build_gold(self.facts, tables=[table])[table]
        return self[table]


# ------------------------------------------------------------------ silver
def q_silver_clean(spark, sf):
    return clean.clean_statistics(raw_stats(spark, sf))


def q_derived_metrics(spark, sf):
    df = clean.add_metrics(clean.clean_statistics(raw_stats(spark, sf)))
    return df.select(
        "video_id", "region", "trending_date", "ingestion_id", "views", "likes",
        "comment_count", "like_ratio", "engagement_rate", "views_tier",
    )


def q_views_tier(spark, sf):
    return (
        silver_stats(spark, sf)
        .groupBy("views_tier")
        .agg(
            F.count(F.lit(1)).alias("videos"),
            F.min("views").alias("min_views"),
            F.max("views").alias("max_views"),
        )
    )


def q_dedup_latest(spark, sf):
    return _public(silver_stats(spark, sf))


def q_dedup_category(spark, sf):
    return _public(silver_cats(spark, sf))


def q_silver_run_metrics(spark, sf):
    return silver_run_metrics(raw_stats(spark, sf))


# ------------------------------------------------------------------ lookup / join
def q_category_lookup(spark, sf):
    return lookup.category_lookup(silver_cats(spark, sf))


def q_category_join_unknown(spark, sf):
    return facts(spark, sf).select(
        "video_id", "region", "trending_date", "category_id", "category_name"
    )


# ------------------------------------------------------------------ gold
def q_trending_analytics(spark, sf):
    return _public(gold.trending_analytics(facts(spark, sf)))


def q_channel_analytics(spark, sf):
    return _public(gold.channel_analytics(facts(spark, sf)))


def q_channel_rank(spark, sf):
    return gold.channel_analytics(facts(spark, sf)).select(
        "channel_title", "region", "trending_date", "total_views", "rank_in_region"
    )


def q_channel_lifetime(spark, sf):
    return gold.channel_lifetime(facts(spark, sf))


def q_channel_primary_tier(spark, sf):
    return gold.channel_aggregates(facts(spark, sf)).select(
        "channel_title", "region", "trending_date", "primary_views_tier"
    )


def q_channel_categories(spark, sf):
    return _public(
        gold.channel_aggregates(facts(spark, sf)).select(
            "channel_title", "region", "trending_date", "categories"
        )
    )


def q_category_analytics(spark, sf):
    return _public(gold.category_analytics(facts(spark, sf)))


def q_category_share(spark, sf):
    return gold.category_analytics(facts(spark, sf)).select(
        "category_name", "category_id", "region", "trending_date", "total_views", "view_share_pct"
    )


def q_category_rank(spark, sf):
    return gold.category_analytics(facts(spark, sf)).select(
        "category_name", "category_id", "region", "trending_date", "total_views", "rank_on_day"
    )


def q_video_velocity(spark, sf):
    return _public(gold.video_velocity(facts(spark, sf)))


def q_momentum(spark, sf):
    v = gold.video_velocity(facts(spark, sf))
    return v.groupBy("momentum").agg(
        F.count(F.lit(1)).alias("videos"),
        F.min("view_growth_pct").alias("min_growth_pct"),
        F.max("view_growth_pct").alias("max_growth_pct"),
    )


# ------------------------------------------------------------------ bronze
# The five TPC-H region names are the adapter's configured regions.
ADAPTER_REGIONS = ("africa", "america", "asia", "europe", "middle east")
# Run clock of the registered DQ checks (fixed, so results are reproducible).
CHECK_CLOCK = "2001-11-05 00:00:00"
RUN_TS = dt.datetime(2001, 11, 5)
LATE_REGION = "asia"


def q_flatten_stats(spark, sf):
    env = landing.statistics_envelopes(raw_stats(spark, sf, lines_once(spark, sf)), kept=True)
    return flatten.flatten_statistics(env)


def q_flatten_categories(spark, sf):
    env = landing.category_envelopes(raw_cats(spark, sf))
    return flatten.flatten_categories(env)


def q_land_roundtrip(spark, sf):
    """Land envelopes as JSON under the shared scratch folder, read the root back under
    the explicit schema, flatten and clean: must equal the adapter rows (with
    trending_date now derived from the ingestion day, as Bronze carries no month)."""
    root = scratch_dir(spark, "bronze")
    pages = landing.statistics_pages(raw_stats(spark, sf, lines_once(spark, sf)), kept=True, by_folder=True)
    writers.write_bronze(landing.statistics_documents(pages), root, list(landing.FOLDER), spread=False)
    back = bronze.read_bronze_statistics(spark, root, ADAPTER_REGIONS, multi_line=False)
    return clean.clean_statistics(flatten.flatten_statistics(back))


# ------------------------------------------------------------------ incremental
def _scenario(f):
    """Earlier state of the facts ``f``: built when Silver held every month up to three months
    before the latest, plus the first half of the latest month (a stale "today")."""
    latest = f.agg(F.max("trending_date")).first()[0]
    cutoff = F.add_months(F.lit(latest), -3)
    early = f.where(
        (F.col("trending_date") < cutoff)
        | ((F.col("trending_date") == F.lit(latest))
           & (F.col("ingestion_timestamp") < F.date_add(F.lit(latest), 14).cast("timestamp")))
    )
    return early, latest


def _silver_once(spark, sf):
    """Silver and the category columns as scratch tables, and facts over them, for what reads them more than once. Silver
    lies by video, so that its dedup and joins move no rows; metrics and provenance are made again when it is read."""
    lines = lines_once(spark, sf)
    narrow = silver_stats(spark, sf, lines).drop(*clean.METRIC_COLUMNS, *PROVENANCE_COLUMNS)
    full = clean.add_metrics(writers.write_bucketed(narrow, "full", "video_id", dedup.STATS_KEYS))
    cats = writers.write_scratch(silver_cats(spark, sf, lines), "cats")
    return full, cats, gold_facts(full, cats)


def q_incremental_dates(spark, sf):
    _, _, f = _silver_once(spark, sf)
    early, latest = _scenario(f)
    plan = incremental.plan_dates(
        incremental.distinct_dates(f), incremental.distinct_dates(early), latest
    )
    return plan


def _lake(spark, sf, stats, cats):
    """A lake in the shared scratch folder whose Silver the real writers have written."""
    paths = jobs.LakePaths(scratch_dir(spark, "lake"))
    _write_silver(paths, stats)
    writers.write_partitions(clean.add_provenance(cats, RUN_TS).select(*SILVER_CATS_COLUMNS), paths.silver_cats, ["region"], "silver_cats")
    return paths


def _write_silver(paths, stats):
    """Silver by the real writer; metrics and provenance are made behind its shuffle."""
    def finish(rows):
        return clean.add_provenance(clean.add_metrics(rows), RUN_TS, "catalog").select(*SILVER_STATS_COLUMNS)

    narrow = stats.drop(*clean.METRIC_COLUMNS, "_processed_at", "_job_name")
    return writers.write_partitions(narrow, paths.silver_stats, ["region", "trending_date"], "silver_stats", finish)


def q_silver_write(spark, sf):
    """Silver facts as the writer left them: partitions, column types and rows (K3, S5)."""
    paths = _lake(spark, sf, silver_stats(spark, sf), silver_cats(spark, sf))
    return _public(spark.read.schema(SILVER_STATS).parquet(paths.silver_stats))


def q_category_write(spark, sf):
    """The dimension through Bronze JSON, the reader and the writer (S2, K4, C2)."""
    root = scratch_dir(spark, "bronze-cats")
    writers.write_bronze(landing.category_envelopes(raw_cats(spark, sf)), root, ["region", "date"])
    flat = flatten.flatten_categories(bronze.read_bronze_categories(spark, root, ADAPTER_REGIONS, multi_line=False))
    path = scratch_dir(spark, "silver-cats")
    writers.write_partitions(build_silver_categories(flat, RUN_TS), path, ["region"], "silver_cats")
    return _public(spark.read.schema(SILVER_CATS).parquet(path))


def _two_runs(spark, sf, catalog=None, publish=False):
    """Gold after two runs of the job: the first over the earlier state of Silver, the second
    when all of it is there and the first's "today" has grown."""
    full, cats, f = _silver_once(spark, sf)
    early, latest = _scenario(f)
    keys = ["video_id", "region", "trending_date"]
    paths = _lake(spark, sf, full.join(early.select(*keys), keys, "left_semi"), cats)
    jobs.silver_to_gold(spark, paths, latest, RUN_TS, catalog=catalog, publish=publish)
    _write_silver(paths, full)
    second = jobs.silver_to_gold(spark, paths, latest, RUN_TS, catalog=catalog, publish=publish)
    return paths, second


def q_incremental_gold(spark, sf):
    """trending_analytics after the second run, read back: planned dates are new, the others
    are as the first run wrote them (K5, C4, I2)."""
    paths, _ = _two_runs(spark, sf)
    return _public(spark.read.parquet(paths.gold("trending_analytics")).select(*TRENDING_COLUMNS))


def q_incremental_velocity(spark, sf):
    """Velocity for the planned dates only, built as the job does: the look back reads the
    histories of the videos that trended on them (I8)."""
    full, cats, f = _silver_once(spark, sf)
    early, latest = _scenario(f)
    plan = incremental.plan_dates(incremental.distinct_dates(f), incremental.distinct_dates(early), latest)
    return _public(build_velocity(full, cats, incremental.collect_dates(plan)))


def q_late_region(spark, sf):
    """A region that arrives after its dates were built is built by the next run, which reads
    the partitions of both sides (region, date by region, date)."""
    full, cats, _ = _silver_once(spark, sf)
    paths = _lake(spark, sf, full.where(F.col("region") != LATE_REGION), cats)
    latest = max(d for _, d in incremental.partition_days(spark, paths.silver_stats))
    jobs.silver_to_gold(spark, paths, latest, RUN_TS)
    _write_silver(paths, full.where(F.col("region") == LATE_REGION))
    jobs.silver_to_gold(spark, paths, latest, RUN_TS)
    return _public(spark.read.parquet(paths.gold("category_analytics")).select(*CATEGORY_COLUMNS))


def q_gold_by_name(spark, sf):
    """The same two runs planned from the catalog's partitions of registered tables, Gold read by its name (K8, I2)."""
    prefix = f"gold_{uuid.uuid4().hex[:8]}_"
    _two_runs(spark, sf, prefix)
    return _public(spark.table(f"{prefix}trending_analytics").select(*TRENDING_COLUMNS))


def q_gold_published(spark, sf):
    """The same two runs, each published as one: both versions of the four tables, as their readers see them, by
    region and day (K5, C5)."""
    paths, _ = _two_runs(spark, sf, publish=True)
    out = []
    for version in (1, 2):
        tables = PublishedGold(spark, paths.published, version)
        for table, measure in (("trending_analytics", "total_views"), ("channel_analytics", "total_views"),
                               ("category_analytics", "total_views"), ("video_velocity", "view_delta")):
            rows = tables.read(table).groupBy("region", "trending_date")
            out.append(rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(measure).cast("long").alias("total")).withColumns(
                {"version": F.lit(version), "table_name": F.lit(table)}))
    return functools.reduce(DataFrame.unionByName, out)


def _velocity_stats(spark, sf):
    """The columns of Silver that Gold reads, written once, by video: each run groups them so. Metrics are made again
    from the counters."""
    narrow = silver_stats(spark, sf).select(*GOLD_INPUT_COLUMNS).drop(*clean.METRIC_COLUMNS)
    return clean.add_metrics(writers.write_bucketed(narrow, "full", "video_id", dedup.STATS_KEYS)).select(*GOLD_INPUT_COLUMNS)


def _velocity_runs(spark, sf, states):
    """Velocity as written after a run for each of ``states`` of Silver, given its latest day (a filter on its full
    rows, and the planned days)."""
    full, cats = _velocity_stats(spark, sf), dimension(spark, sf)
    latest = full.agg(F.max("trending_date")).first()[0]
    gold_path, state_path = scratch_dir(spark, "velocity"), scratch_dir(spark, "snapshots")
    for held, planned in states(latest):
        stats = full.where(held)
        pairs = {(r.region, r.trending_date) for r in stats.select("region", "trending_date").distinct().collect()}  # bounded by the days
        days = sorted({d for _, d in pairs if planned(d)})
        velocity.run_velocity(spark, gold_path, state_path, stats, cats, days, pairs, RUN_TS)
    return _public(spark.read.parquet(gold_path).select(*VELOCITY_COLUMNS))


def _latest(spark, sf):
    return raw_stats(spark, sf).agg(F.max("trending_date")).first()[0]


def q_velocity_daily(spark, sf):
    """Velocity after the latest day came to an earlier state, by the last-snapshot table: the run
    reads that day only (I8, W7)."""
    return _velocity_runs(spark, sf, lambda latest: (
        (F.col("trending_date") < F.lit(latest), lambda d: True), (F.lit(True), lambda d: d == latest)))


def q_velocity_late_day(spark, sf):
    """The same when a day in the middle arrives last, after the days that look back to it."""
    def states(latest):
        late = (latest.replace(day=1) - dt.timedelta(days=62)).replace(day=1)
        return (F.col("trending_date") != F.lit(late), lambda d: True), (F.lit(True), lambda d: d == late)

    return _velocity_runs(spark, sf, states)


def q_channel_with_lifetime(spark, sf):
    """channel_analytics with its lifetime columns, from the day bitmaps of three runs: all days but
    two, then a late one, then the latest (A13)."""
    rows = writers.write_scratch(gold.channel_analytics(facts(spark, sf)), "channels")
    held = rows.select("region", "trending_date", "channel_title")
    days = sorted({r.trending_date for r in rows.select("trending_date").distinct().collect()})  # bounded by the days
    late, path = days[len(days) // 2], scratch_dir(spark, "channel-days")
    for part in ([d for d in days if d not in (late, days[-1])], [late], [days[-1]]):
        some = held.where(F.col("trending_date").isin(part))
        pairs = {(r.region, r.trending_date) for r in some.select("region", "trending_date").distinct().collect()}
        lifetime.merge_days(spark, path, some, pairs)
    return _public(lifetime.with_lifetime(rows, spark.read.schema(lifetime.STATE).parquet(path)))


def q_distinct_over_days(spark, sf):
    """Distinct channels and videos per region over the last year, from daily sketches alone, each
    with whether it is within four standard errors of the exact count, which is given (A8, A16)."""
    stats, latest = silver_stats(spark, sf), _latest(spark, sf)
    path = scratch_dir(spark, "sketches")
    writers.write_partitions(sketches.daily_sketches(stats), path, sketches.PARTITIONS, "daily_sketches")
    since = F.col("trending_date") > F.add_months(F.lit(latest), -12)
    counted = sketches.distinct_over(spark.read.parquet(path).where(since))
    exact = stats.where(since).groupBy("region").agg(F.count_distinct("channel_title").alias("channels"), F.count_distinct("video_id").alias("videos"))
    near = [(F.abs(F.col(f"unique_{c}") - F.col(c)) <= F.greatest(F.lit(1.0), 4 * sketches.RELATIVE_ERROR * F.col(c))).alias(f"{c}_within") for c in sketches.COUNTED]
    return counted.join(exact, "region").select("region", *sketches.COUNTED, *near)


def q_backfill_dates(spark, sf):
    """Parametrised backfill (I9): the override replaces the plan; dates Silver does not
    have are dropped. Override here: the first and last month, and the month before the
    first (absent from Silver)."""
    f = facts(spark, sf)
    lo, hi = f.agg(F.min("trending_date"), F.max("trending_date")).first()
    before = (lo.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    return incremental.plan_dates(incremental.distinct_dates(f), None, None, [before, lo, hi])


# ------------------------------------------------------------------ runs from Bronze
def _coarse_envelopes(rows):
    """Statistics envelopes of written rows, in one landing folder per region and year (the data spans 2,500 days)."""
    return landing.statistics_envelopes(rows, kept=True).withColumns({"date": F.trunc("date", "year"), "hour": F.lit(0)})


def q_quarantine_replay(spark, sf):
    """Good and broken documents in one root: a tenth of the orders lost its last character, a tenth
    came as an error body. Rows, videos and dead letters per region before and after a replay that
    mends the first kind, run twice (S1, S3, S4)."""
    root, path = scratch_dir(spark, "bronze-broken"), scratch_dir(spark, "dead")
    env = _coarse_envelopes(raw_stats(spark, sf, lines_once(spark, sf)))
    doc, name = F.to_json(F.struct("items", "_pipeline_metadata")), F.col("_pipeline_metadata.ingestion_id")
    kind = F.substring_index(name, "_", -1).cast("long") % 10
    body = F.concat(F.lit('{"error": {"code": 403}, "id": "'), name, F.lit('"}'))
    text = F.when(kind == 0, F.substr(doc, F.lit(1), F.length(doc) - 1)).when(kind == 1, body).otherwise(doc)
    env.select(text.alias("value"), "region", "date", "hour").write.option("compression", "gzip").partitionBy("region", "date", "hour").text(root)
    quarantine.collect(spark, root, path, BRONZE_STATS, STATS_PARTITIONS, ADAPTER_REGIONS, multi_line=False)

    def state(stage):
        docs = bronze.read_bronze_statistics(spark, root, ADAPTER_REGIONS, multi_line=False)
        docs = docs.unionByName(quarantine.read_replayed(spark, path, BRONZE_STATS, STATS_PARTITIONS, ADAPTER_REGIONS))
        rows = flatten.flatten_statistics(docs).groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("video_id").alias("n_videos"))
        dead = quarantine.outstanding(spark, path).groupBy("region").agg(F.count(F.lit(1)).alias("n_dead"))
        both = rows.join(dead, "region", "left").select(F.lit(stage).alias("stage"), "region", "n_rows", "n_videos", F.coalesce("n_dead", F.lit(0).cast("long")).alias("n_dead"))
        return writers.write_scratch(both, "replay-state")

    before = state("before")
    for _ in range(2):
        quarantine.replay(spark, path, BRONZE_STATS, lambda raw, reason: F.when(reason == quarantine.MALFORMED, F.concat(raw, F.lit("}"))))
    return before.union(state("after"))


def q_schema_versions(spark, sf):
    """Silver rows from one root with two versions of its documents: until 1994 counters were 32-bit
    numbers and details and favourites missing, later documents have tags (U1)."""
    root = scratch_dir(spark, "bronze-versions")
    raw = raw_stats(spark, sf, lines_once(spark, sf))
    old = F.transform("items", lambda x: x.dropFields("contentDetails", "statistics.favoriteCount").withField(
        "statistics.viewCount", x["statistics"]["viewCount"].cast("int")).withField("statistics.likeCount", x["statistics"]["likeCount"].cast("int")))
    new = F.transform("items", lambda x: x.withField("snippet.tags", F.array(x["snippet"]["title"])))
    landed = F.to_date("ingestion_timestamp")  # the same for all of a batch
    first = _coarse_envelopes(raw.where(landed < "1995-01-01")).drop("hour").withColumn("items", old)
    later = _coarse_envelopes(raw.where(landed >= "1995-01-01")).withColumn("items", new)
    for version, env in enumerate((first, later), 1):
        env.write.option("compression", "zstd").parquet(f"{root}/version={version}")
    wanted = T.StructType([f for f in BRONZE_STATS.fields if f.name != "_corrupt_record"] + list(STATS_PARTITIONS.fields))
    return clean.clean_statistics(flatten.flatten_statistics(evolution.read_versions(spark, root, wanted)))


def _monthly(df):
    """Landing times as minutes of the month's first day, in the order of their days."""
    ts = F.col("ingestion_timestamp")
    return df.withColumn("ingestion_timestamp", F.date_trunc("month", ts) + F.make_dt_interval(mins=F.dayofmonth(ts) - 1))


def q_whole_run(spark, sf):
    """Bronze to Gold by the job, with broken documents and a missing region, then what else a run
    can end in: item, name and value of each report and of the tables read back (C1, C5, S3, S4, S9, K6, I6, D12)."""
    paths = jobs.LakePaths(scratch_dir(spark, "whole-run"))
    lines = lines_once(spark, sf)
    raw = raw_stats(spark, sf, lines)
    jobs.land(spark, paths, _monthly(raw), _monthly(raw_cats(spark, sf, lines)), kept=True)
    names = spark.createDataFrame([(r,) for r in ADAPTER_REGIONS], "region string")
    bodies = F.explode(F.array(F.concat(F.lit("{not json, of "), "region"), F.concat(F.lit('{"error": {"code": 403}, "of": "'), "region", F.lit('"}'))))
    broken = names.select(bodies.alias("value"), "region", F.lit(dt.date(1992, 1, 1)).alias("date"), F.lit(0).alias("hour"))
    broken.write.mode("append").partitionBy("region", "date", "hour").text(paths.bronze_stats)

    latest = raw.agg(F.max("trending_date")).first()[0]
    run_ts = dt.datetime(latest.year, latest.month, 1, 6)
    config = dq.DQConfig(valid_regions=ADAPTER_REGIONS)
    silver, gate, made = jobs.run_medallion(spark, paths, (*ADAPTER_REGIONS, "atlantis"), run_ts, config)
    rows = [("silver", k, silver.metrics[k]) for k in ("raw_rows", "null_id_dropped", "duplicates_removed", "silver_rows", "quarantined")]
    for region, report in silver.metrics["regions"].items():
        rows += [(f"region {region}", k, int(report[k])) for k in ("documents", "bad_documents", "items", "missing", "failed")]
    rows += [("gate", "open", int(gate.status == "ok")), ("gold", "ok", int(made.status == "ok"))]
    for table, column in (("trending_analytics", "total_views"), ("channel_analytics", "total_views"), ("category_analytics", "total_views"), ("video_velocity", "view_delta")):
        n, total = spark.read.parquet(paths.gold(table)).agg(F.count(F.lit(1)), F.sum(column)).first()
        rows += [(table, "rows", n), (table, column, total), (table, "written", made.metrics["rows_written"][table])]
    again = jobs.silver_to_gold(spark, paths, dt.date(2030, 1, 1), run_ts)
    rows.append(("second run", "noop", int(again.status == "noop")))
    closed = jobs.quality_gate(spark, paths, dq.DQConfig(valid_regions=ADAPTER_REGIONS[:4]), run_ts)
    rows.append(("gate without a region", "open", int(closed.status == "ok")))
    unread = jobs.quality_gate(spark, jobs.LakePaths(paths.root + "/none"), config, run_ts).report
    rows.append(("gate without tables", "unread", unread.where("check = 'read_table' and not passed").count()))
    stats = spark.read.schema(SILVER_STATS).parquet(paths.silver_stats)
    first = min(d for _, d in incremental.partition_days(spark, paths.silver_stats))
    empty = writers.write_partitions(build_velocity(stats, None, [first]), scratch_dir(spark, "empty"), ["region", "trending_date"])
    rows.append(("velocity of the first day", "rows", empty))
    return spark.createDataFrame(rows, "item string, name string, value long")


# ------------------------------------------------------------------ data quality
def _dq_results(spark, sf):
    cfg = dq.DQConfig(valid_regions=ADAPTER_REGIONS)
    tables = {dq.FACT_TABLE: silver_stats(spark, sf), dq.DIM_TABLE: silver_cats(spark, sf)}
    return dq.run_checks(spark, tables, cfg, CHECK_CLOCK)


def _dq(where):
    def run(spark, sf):
        r = _dq_results(spark, sf)
        return r.where(where()).drop("message")

    return run


def q_dq_verdict(spark, sf):
    return dq.verdict(_dq_results(spark, sf))


def q_dq_invalid_values(spark, sf):
    """Values outside the enums, with two of the five regions configured."""
    cfg = dq.DQConfig(valid_regions=ADAPTER_REGIONS[:2])
    return dq.invalid_values(silver_stats(spark, sf), dq.FACT_TABLE, cfg)


def q_dq_sampled(spark, sf):
    """Counts of rows with some properties: exact, and whether the interval from a seeded stratified
    sample (a tenth of the rows of all but small region-days) covers them (S8)."""
    stats = writers.write_scratch(silver_stats(spark, sf).select(*sampling.KEY, "title", "views", "definition", "views_tier"), "sampled")
    made = {f"null_{c}": F.col(c).isNull() for c in ("video_id", "title", "views")} | {"zero_views": F.col("views") == 0, "hd": F.col("definition") == "hd"}
    made |= {f"tier_{t}": F.col("views_tier") == t for t in TIER_NAMES}
    exact = stats.agg(*[F.count_if(p).alias(k) for k, p in made.items()]).unpivot([], list(made), "name", "n_exact")
    found = sampling.sampled_counts(stats, made, 0.1, 50).join(exact, "name")
    return found.select("name", "n_rows", "n_exact", F.col("n_exact").between(F.col("low"), F.col("high")).alias("covered"))


def q_dq_prewrite(spark, sf):
    s = silver_stats(spark, sf)
    return s.agg(*dq.prewrite_warnings(s))


def q_dq_staleness(spark, sf):
    return dq.bronze_staleness(silver_stats(spark, sf), CHECK_CLOCK, 6)


# ------------------------------------------------------------------ analyst queries
def _analyst(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _public(analyst.DATAFRAME[name](GoldTables(spark, sf)))

    run.__name__ = f"q_{name}"
    return run


def _analyst_sql(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        made = GoldTables(spark, sf)
        analyst.register_gold_views(spark, {t: made[t] for t in GOLD_BUILDERS if t in analyst.SQL[name]})
        return _public(analyst.run_sql(spark, name))

    run.__name__ = f"q_{name}_sql"
    return run


def registry() -> dict[str, Query]:
    reg: dict[str, Query] = {
        "silver_clean": q_silver_clean,
        "derived_metrics": q_derived_metrics,
        "views_tier": q_views_tier,
        "dedup_latest": q_dedup_latest,
        "dedup_category": q_dedup_category,
        "silver_run_metrics": q_silver_run_metrics,
        "category_lookup": q_category_lookup,
        "category_join_unknown": q_category_join_unknown,
        "trending_analytics": q_trending_analytics,
        "channel_analytics": q_channel_analytics,
        "channel_rank": q_channel_rank,
        "channel_lifetime": q_channel_lifetime,
        "channel_primary_tier": q_channel_primary_tier,
        "channel_categories": q_channel_categories,
        "category_analytics": q_category_analytics,
        "category_share": q_category_share,
        "category_rank": q_category_rank,
        "video_velocity": q_video_velocity,
        "momentum": q_momentum,
        "flatten_stats": q_flatten_stats,
        "flatten_categories": q_flatten_categories,
        "land_roundtrip": q_land_roundtrip,
        "incremental_dates": q_incremental_dates,
        "silver_write": q_silver_write,
        "category_write": q_category_write,
        "incremental_gold": q_incremental_gold,
        "late_region": q_late_region,
        "incremental_velocity": q_incremental_velocity,
        "backfill_dates": q_backfill_dates,
        "gold_by_name": q_gold_by_name,
        "gold_published": q_gold_published,
        "quarantine_replay": q_quarantine_replay,
        "schema_versions": q_schema_versions,
        "whole_run": q_whole_run,
        "velocity_daily": q_velocity_daily,
        "velocity_late_day": q_velocity_late_day,
        "channel_with_lifetime": q_channel_with_lifetime,
        "distinct_over_days": q_distinct_over_days,
        "dq_row_count": _dq(lambda: F.col("check") == "row_count"),
        "dq_null_pct": _dq(lambda: F.col("check") == "null_pct"),
        "dq_schema": _dq(lambda: F.col("check") == "schema"),
        "dq_ranges": _dq(lambda: (F.col("check") == "value_range")
                         & F.col("column_name").isin("views", "engagement_rate", "like_ratio")),
        "dq_enums": _dq(lambda: (F.col("check") == "value_range")
                        & F.col("column_name").isin("views_tier", "region")),
        "dq_freshness": _dq(lambda: F.col("check") == "freshness"),
        "dq_verdict": q_dq_verdict,
        "dq_invalid_values": q_dq_invalid_values,
        "dq_prewrite": q_dq_prewrite,
        "dq_sampled": q_dq_sampled,
        "dq_staleness": q_dq_staleness,
    }
    for i in range(1, 9):
        reg[f"q{i}"] = _analyst(f"q{i}")
        reg[f"q{i}_sql"] = _analyst_sql(f"q{i}")
    return reg
