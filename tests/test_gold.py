"""Hand-written rows for dedup, lookup, the four Gold builders and ranking."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendlake.operators import dedup, gold, lookup, ranking
from trendlake.plans.gold import build_gold, gold_facts

D18, D19, D20 = dt.date(2026, 5, 18), dt.date(2026, 5, 19), dt.date(2026, 5, 20)

FACT_SCHEMA = (
    "video_id string, region string, trending_date date, title string, channel_title string, "
    "category_id long, category_name string, views long, likes long, comment_count long, "
    "like_ratio double, engagement_rate double, views_tier string, definition string, "
    "ingestion_timestamp timestamp, ingestion_id string"
)


def fact(video, region, day, views, likes=0, channel="c1", cat=10, tier="emerging", hour=12,
         definition="hd", lr=0.0, er=0.0, name="Music"):
    ts = dt.datetime.combine(day, dt.time(hour))
    return (video, region, day, f"t-{video}", channel, cat, name, views, likes, 0, lr, er, tier,
            definition, ts, ts.strftime("%Y%m%d_%H%M%S"))


def test_dedup_keeps_latest_snapshot(spark):
    rows = [fact("v1", "us", D18, 100, hour=6), fact("v1", "us", D18, 150, hour=12),
            fact("v1", "gb", D18, 7, hour=6)]
    df = spark.createDataFrame(rows, FACT_SCHEMA)
    out = {(r.region, r.views) for r in dedup.dedup_statistics(df).collect()}
    assert out == {("us", 150), ("gb", 7)}


def test_dedup_ties_are_deterministic(spark):
    a = fact("v1", "us", D18, 100)
    b = fact("v1", "us", D18, 200)  # same timestamp and ingestion id
    for rows in ([a, b], [b, a]):
        df = spark.createDataFrame(rows, FACT_SCHEMA).repartition(3)
        assert [r.views for r in dedup.dedup_statistics(df).collect()] == [200]


def test_lookup_and_unknown(spark):
    cats = spark.createDataFrame(
        [(10, "Music", "us", dt.datetime(2026, 5, 1)), (10, "Musique", "ca", dt.datetime(2026, 5, 2)),
         (20, "Gaming", "us", dt.datetime(2026, 5, 1))],
        "category_id long, category_name string, region string, ingestion_timestamp timestamp",
    )
    lk = {r.category_id: r.category_name for r in lookup.category_lookup(cats).collect()}
    assert lk == {10: "Musique", 20: "Gaming"}
    facts = spark.createDataFrame([("v1", 10), ("v2", 99), ("v3", None)], "video_id string, category_id long")
    joined = lookup.join_categories(facts, lookup.category_lookup(cats))
    assert {r.video_id: r.category_name for r in joined.collect()} == {
        "v1": "Musique", "v2": "Unknown", "v3": "Unknown"}
    assert {r.category_name for r in lookup.join_categories(facts, None).collect()} == {"Unknown"}


def test_velocity_growth_and_first_appearance(spark):
    rows = [fact("v1", "us", D18, 100), fact("v1", "us", D20, 130), fact("v2", "us", D18, 0),
            fact("v2", "us", D19, 500)]
    v = gold.video_velocity(spark.createDataFrame(rows, FACT_SCHEMA))
    got = {r.video_id: r for r in v.collect()}
    assert set(got) == {"v1", "v2"}
    r = got["v1"]
    assert (r.view_delta, r.days_since_prev, r.view_growth_pct, r.views_per_day, r.momentum) == (
        30, 2, 30.0, 15.0, "surging")
    assert r.prev_trending_date == D18
    assert (got["v2"].view_growth_pct, got["v2"].momentum) == (0.0, "stable")


def test_velocity_filter_after_lag(spark):
    rows = [fact("v1", "us", D18, 100), fact("v1", "us", D19, 110)]
    v = gold.video_velocity(spark.createDataFrame(rows, FACT_SCHEMA), dates=[D19])
    assert [(r.trending_date, r.prev_views) for r in v.collect()] == [(D19, 100)]


def test_category_share_and_rank(spark):
    rows = [fact("v1", "us", D18, 75, cat=10, name="Music"), fact("v2", "us", D18, 25, cat=20, name="Gaming")]
    c = gold.category_analytics(spark.createDataFrame(rows, FACT_SCHEMA))
    got = {r.category_name: (r.view_share_pct, r.rank_on_day) for r in c.collect()}
    assert got == {"Music": (75.0, 1), "Gaming": (25.0, 2)}


def test_channel_mode_ties_to_smallest_tier(spark):
    rows = [fact("v1", "us", D18, 5, tier="viral"), fact("v2", "us", D18, 5, tier="mega"),
            fact("v3", "us", D18, 5, tier="viral"), fact("v4", "us", D18, 5, tier="mega")]
    ch = gold.channel_analytics(spark.createDataFrame(rows, FACT_SCHEMA)).first()
    assert ch.primary_views_tier == "mega"
    assert ch.total_videos == 4 and ch.times_trending == 1 and ch.categories == ["Music"]


def test_trending_measures(spark):
    rows = [fact("v1", "us", D18, 100, likes=10, channel="a", definition="hd", tier="emerging", lr=10.0),
            fact("v2", "us", D18, 300, likes=30, channel="b", definition="sd", tier="emerging", lr=10.0)]
    t = gold.trending_analytics(spark.createDataFrame(rows, FACT_SCHEMA)).first()
    assert (t.total_videos, t.total_views, t.avg_views_per_video, t.max_views) == (2, 400, 200.0, 300)
    assert (t.unique_channels, t.hd_percentage, t.emerging_count, t.mega_count) == (2, 50.0, 2, 0)
    assert t.avg_like_ratio == 10.0


def test_distributed_rank_equals_window_rank(spark):
    # Many channels on one day (a hot group) plus ties on total views.
    rows = [(f"ch{i:04d}", "us", D18, (i * 37) % 101) for i in range(3000)]
    rows += [(f"ch{i:04d}", "gb", D19, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "channel_title string, region string, trending_date date, total_views long")
    order = [F.col("total_views").desc(), F.col("channel_title").asc()]
    keys = ["region", "trending_date"]
    w = df.withColumn("rk", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).collect()
    d = ranking.distributed_row_number(df.repartition(5), keys, order, "rk").collect()
    assert sorted(tuple(r) for r in w) == sorted(tuple(r) for r in d)
    d2 = ranking.distributed_row_number(df, keys, order, "rk", num_partitions=13).collect()
    assert sorted(tuple(r) for r in w) == sorted(tuple(r) for r in d2)


def test_build_gold_restricts_dates_but_velocity_sees_history(spark):
    rows = [fact("v1", "us", D18, 100), fact("v1", "us", D19, 120)]
    stats = spark.createDataFrame(rows, FACT_SCHEMA).drop("category_name")
    f = gold_facts(stats, None)
    g = build_gold(f, [D19])
    assert [r.trending_date for r in g["trending_analytics"].collect()] == [D19]
    assert [r.prev_views for r in g["video_velocity"].collect()] == [100]
