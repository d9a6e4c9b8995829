"""Lifetime bitmaps, last-snapshot velocity and sketches against what the whole history gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.test_jobs import FLAT, write_silver
from trendlake.operators import gold
from trendlake.plans import jobs, lifetime, sketches, velocity
from trendlake.plans.gold import build_velocity, gold_facts
from trendlake.plans.silver import build_silver_statistics
from trendlake.sinks import writers
from trendlake.sinks.state import VersionedState

DAYS = [dt.date(2026, 4, 28) + dt.timedelta(days=i) for i in range(7)]
TS = dt.datetime(2026, 5, 9)


def day_rows(day, seed, n=14, regions=("us", "gb")):
    """Some of n videos of some channels on a day."""
    rnd = random.Random(f"{day}{seed}")
    ts = dt.datetime(day.year, day.month, day.day, 6 + seed)
    return [
        (f"v{i}", region, f"title {i}", None if i == 5 else f"ch{i % 4}", 10 + i % 2, None, "d", "en", 1000 * rnd.randrange(1, 90), 10 * rnd.randrange(9), 0, i, 0, "PT1M", "hd", ts, f"{ts:%Y%m%d_%H%M%S}")
        for region in regions for i in range(n) if rnd.random() < 0.6
    ]


def put(spark, paths, rows):
    silver = build_silver_statistics(spark.createDataFrame(rows, FLAT), TS)
    writers.write_partitions(silver, paths.silver_stats, ["region", "trending_date"])


def rows_of(df):
    return sorted(map(str, df.drop("_aggregated_at").collect()))


def check(spark, paths):
    """Everything that the runs keep equals what one pass over Silver gives."""
    stats = spark.read.parquet(paths.silver_stats)
    facts = gold_facts(stats, None)
    written = spark.read.parquet(paths.gold("video_velocity"))
    assert rows_of(written.select(sorted(written.columns))) == rows_of(build_velocity(stats, None).select(sorted(written.columns)))
    channels = lifetime.read_channels(spark, paths.gold("channel_analytics"), paths.state("channel_days"))
    life = {(r.region, r.channel_title): (r.times_trending, r.first_trending_date, r.last_trending_date) for r in gold.channel_lifetime(facts).collect()}
    found = channels.select("region", "channel_title", *lifetime.LIFETIME_COLUMNS).distinct().collect()
    assert {(r[0], r[1]): tuple(r[2:]) for r in found} == life
    state = velocity.snapshot_state(spark, paths.state("last_snapshots")).rows()
    have = {(r.video_id, r.region): (r.last, r.before) for r in state.collect()}
    want = {(r.video_id, r.region): (r.last, r.before) for r in velocity.last_two(facts).collect()}
    latest = {r.region: r.d for r in facts.groupBy("region").agg(F.max("trending_date").alias("d")).collect()}
    assert have.keys() == want.keys()
    for key, (last, before) in want.items():  # the one before is needed where the last one's day may be built again
        assert have[key] == (last, before) or (have[key] == (last, None) and last.trending_date < latest[key[1]])
    exact = {r.region: (r.c, r.v) for r in facts.groupBy("region").agg(F.count_distinct("channel_title").alias("c"), F.count_distinct("video_id").alias("v")).collect()}
    got = sketches.distinct_over(spark.read.parquet(paths.state("daily_sketches"))).collect()
    assert {r.region: (r.unique_channels, r.unique_videos) for r in got} == exact


def test_days_in_order_late_rebuilt_and_repeated(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    rows = {d: day_rows(d, 0) for d in DAYS}

    def run(*days):
        put(spark, paths, [r for d in days for r in rows[d]])
        return jobs.silver_to_gold(spark, paths, days[-1], TS).metrics

    assert run(*DAYS[:3])["velocity"]["mode"] == "first"
    check(spark, paths)
    assert run(DAYS[3])["velocity"] == {"mode": "forward", "days": [str(DAYS[3])]}
    check(spark, paths)
    rows[DAYS[3]] = day_rows(DAYS[3], 1)  # the latest day again: videos and channels come and go
    assert run(DAYS[3])["velocity"]["mode"] == "forward"
    check(spark, paths)
    late = run(DAYS[6])["velocity"]
    assert late["mode"] == "forward"
    late = run(DAYS[5])["velocity"]  # a late day: the one after it looks back to it now
    assert late == {"mode": "late", "days": [str(d) for d in DAYS[5:7]]}
    check(spark, paths)
    rows[DAYS[1]] = day_rows(DAYS[1], 2, n=10)  # an old day rebuilt without some videos and channels
    put(spark, paths, rows[DAYS[1]])
    assert jobs.silver_to_gold(spark, paths, DAYS[6], TS, [DAYS[1]]).metrics["velocity"]["mode"] == "late"
    check(spark, paths)
    assert jobs.silver_to_gold(spark, paths, dt.date(2026, 6, 1), TS).metrics.get("velocity") is None  # nothing left to do


def test_a_late_region_and_a_lost_commit(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    put(spark, paths, [r for d in DAYS[:3] for r in day_rows(d, 0, regions=("us",))])
    jobs.silver_to_gold(spark, paths, DAYS[2], TS)
    put(spark, paths, [r for d in DAYS[:2] for r in day_rows(d, 0, regions=("gb",))])
    jobs.silver_to_gold(spark, paths, DAYS[2], TS)
    check(spark, paths)
    state = velocity.snapshot_state(spark, paths.state("last_snapshots"))
    before = state.versions()
    # a run that dies before its state's marker: the version isn't seen, and its days are merged again
    put(spark, paths, day_rows(DAYS[3], 0))
    dead = VersionedState(spark, state.path, state.schema)
    dead.rows().limit(1).write.parquet(dead._folder(before[-1] + 1, "rows"))
    assert dead.versions() == before
    jobs.silver_to_gold(spark, paths, DAYS[3], TS)
    check(spark, paths)
    assert state.versions() == [before[-1], before[-1] + 1]  # two are kept


def test_a_region_late_on_all_days_leaves_none_to_follow(spark, tmp_lake, monkeypatch):
    paths = jobs.LakePaths(tmp_lake)
    monkeypatch.setattr(velocity, "following_days", lambda *a: pytest.fail("all days are built"))
    for region in ("us", "gb"):
        put(spark, paths, [r for d in DAYS[:3] for r in day_rows(d, 0, regions=(region,))])
        done = jobs.silver_to_gold(spark, paths, DAYS[2], TS).metrics["velocity"]
    assert done == {"mode": "late", "days": [str(d) for d in DAYS[:3]]}
    check(spark, paths)


def test_a_daily_run_reads_its_days_only(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    write_silver(spark, paths, DAYS[:3])
    jobs.silver_to_gold(spark, paths, DAYS[2], TS)
    stats = spark.read.parquet(paths.silver_stats)
    state = velocity.snapshot_state(spark, paths.state("last_snapshots")).rows()
    facts = gold_facts(gold.restrict_dates(stats, [DAYS[2]]), None)
    made = velocity.forward_pairs(facts, state, {"us": DAYS[2], "gb": DAYS[2]})
    plan = spark._jvm.PythonSQLUtils.explainString(made._jdf.queryExecution(), "formatted")
    scans = [part for part in plan.split("\n\n") if "Scan parquet" in part and "Batched" in part]
    assert len(scans) == 2 and sum("PartitionFilters" in s and f"= {DAYS[2]})" in s for s in scans) == 1 and str(DAYS[1]) not in plan


def test_lifetime_of_rebuilt_days(spark, tmp_lake):
    path = f"{tmp_lake}/days"
    a, b, c = DAYS[2], DAYS[3], dt.date(2026, 5, 31)

    def merge(rows, days):
        lifetime.merge_days(spark, path, spark.createDataFrame(rows, "region string, trending_date date, channel_title string"), days)
        found = lifetime.lifetimes(spark.read.schema(lifetime._schema()).parquet(path)).collect()
        return {(r.region, r.channel_title): tuple(r[2:]) for r in found}

    assert merge([("us", a, "x"), ("us", b, "x"), ("us", b, None), ("gb", c, "x")], {("us", a), ("us", b), ("gb", c)}) == {
        ("us", "x"): (2, a, b), ("us", None): (1, b, b), ("gb", "x"): (1, c, c)}
    assert merge([("us", b, "y")], {("us", b)}) == {("us", "x"): (1, a, a), ("us", "y"): (1, b, b), ("gb", "x"): (1, c, c)}
    assert lifetime.merged_days(spark, path) == {("us", a), ("us", b), ("gb", c)}
    assert merge([], {("gb", c)}) == {("us", "x"): (1, a, a), ("us", "y"): (1, b, b)}
    assert lifetime.merged_days(spark, path) == {("us", a), ("us", b), ("gb", c)}  # an empty day is merged too


@pytest.mark.parametrize("n", [100, 200_000])
def test_sketches_are_within_their_error(spark, n):
    rows = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "us").otherwise("gb").alias("region"), F.date_add(F.lit("2026-05-01").cast("date"), (F.col("id") % 5).cast("int")).alias("trending_date"),
        (F.col("id") % (n // 4)).cast("string").alias("channel_title"), F.col("id").cast("string").alias("video_id"),
    )
    made = sketches.daily_sketches(rows.union(rows))
    days = [dt.date(2026, 5, 1), dt.date(2026, 5, 2), dt.date(2026, 5, 4)]
    got = sketches.distinct_over(made, (), days).first()
    chosen = rows.where(F.col("trending_date").isin(days))
    exact = chosen.agg(F.count_distinct("channel_title"), F.count_distinct("video_id")).first()
    for estimate, value in zip((got.unique_channels, got.unique_videos), exact):
        assert abs(estimate - value) <= max(1, 4 * sketches.RELATIVE_ERROR * value)
