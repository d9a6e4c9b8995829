"""Incremental scenario on a temporary lake (FIXTURES section 3, runs 1-4), retries and
the whole land -> silver -> gate -> gold run."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from trendlake.operators import dq
from trendlake.plans import jobs
from trendlake.plans.silver import build_silver_categories, build_silver_statistics
from trendlake.sinks import writers

FLAT = (
    "video_id string, region string, title string, channel_title string, category_id long, "
    "publish_time timestamp, description string, audio_language string, views long, likes long, "
    "dislikes long, comment_count long, favorite_count long, duration string, definition string, "
    "ingestion_timestamp timestamp, ingestion_id string"
)


def flat_rows(day, views_boost=0, n=12):
    out = []
    for i in range(n):
        for hour in (6, 12):
            ts = dt.datetime(day.year, day.month, day.day, hour)
            out.append((f"v{i}", "us" if i % 2 else "gb", f"title {i}", f"ch{i % 3}", 10 + i % 2, None, "d", "en",
                        1000 * (i + 1) + hour + views_boost, 10 * i, 0, i, 0, "PT1M", "hd", ts,
                        ts.strftime("%Y%m%d_%H%M%S")))
    return out


def write_silver(spark, paths, days, boost=0):
    rows = [r for d in days for r in flat_rows(d, boost)]
    flat = spark.createDataFrame(rows, FLAT)
    run_ts = dt.datetime(2026, 5, 20)
    writers.write_partitions(build_silver_statistics(flat, run_ts), paths.silver_stats, ["region", "trending_date"])
    cats = spark.createDataFrame(
        [(10, "Music", True, "e", "us", dt.datetime(2026, 5, 1)), (11, "Gaming", True, "e", "gb", dt.datetime(2026, 5, 1))],
        "category_id long, category_name string, assignable boolean, etag string, region string, "
        "ingestion_timestamp timestamp")
    writers.write_partitions(build_silver_categories(cats, run_ts), paths.silver_cats, ["region"])


def gold_files(paths, table, day):
    return sorted(glob.glob(os.path.join(paths.gold(table), "region=*", f"trending_date={day}", "*.parquet")))


def test_incremental_runs(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    d18, d19, d20 = dt.date(2026, 5, 18), dt.date(2026, 5, 19), dt.date(2026, 5, 20)
    ts = dt.datetime(2026, 5, 18, 23)

    write_silver(spark, paths, [d18])
    r1 = jobs.silver_to_gold(spark, paths, d18, ts)
    assert r1.status == "ok" and r1.metrics["planned"]["trending_analytics"] == ["2026-05-18"]
    assert r1.metrics["rows_written"]["video_velocity"] == 0  # day one: no predecessor
    files18 = gold_files(paths, "trending_analytics", d18)
    mtimes = [os.path.getmtime(f) for f in files18]

    write_silver(spark, paths, [d18, d19])
    r2 = jobs.silver_to_gold(spark, paths, d19, ts)
    assert r2.metrics["planned"]["trending_analytics"] == ["2026-05-19"]
    assert r2.metrics["planned"]["video_velocity"] == ["2026-05-18", "2026-05-19"]  # 18 never written
    assert [os.path.getmtime(f) for f in gold_files(paths, "trending_analytics", d18)] == mtimes

    write_silver(spark, paths, [d18, d19], boost=500)  # fresher counts for today
    r3 = jobs.silver_to_gold(spark, paths, d19, ts)
    assert r3.metrics["planned"]["trending_analytics"] == ["2026-05-19"]
    t = spark.read.parquet(paths.gold("trending_analytics"))
    assert t.groupBy("region", "trending_date").count().where("count > 1").count() == 0
    gb19 = t.where((F.col("region") == "gb") & (F.col("trending_date") == d19)).first()
    gb18 = t.where((F.col("region") == "gb") & (F.col("trending_date") == d18)).first()
    assert gb19.max_views > gb18.max_views + 400  # refreshed; history untouched
    v = spark.read.parquet(paths.gold("video_velocity"))
    assert v.where(F.col("trending_date") == d19).count() == 12

    r4 = jobs.silver_to_gold(spark, paths, d20, ts)
    assert r4.status == "noop"


def test_retry_after_partial_failure_replans_missing_tables(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    d18, d19 = dt.date(2026, 5, 18), dt.date(2026, 5, 19)
    write_silver(spark, paths, [d18, d19])
    jobs.silver_to_gold(spark, paths, d19, dt.datetime(2026, 5, 19, 23))
    # simulate a run that died after trending_analytics: channel table lost 2026-05-18
    import shutil
    for d in glob.glob(os.path.join(paths.gold("channel_analytics"), "region=*", "trending_date=2026-05-18")):
        shutil.rmtree(d)
    r = jobs.silver_to_gold(spark, paths, dt.date(2026, 5, 25), dt.datetime(2026, 5, 25))
    assert r.metrics["planned"]["channel_analytics"] == ["2026-05-18"]
    assert r.metrics["planned"]["trending_analytics"] == []
    assert spark.read.parquet(paths.gold("channel_analytics")).where(F.col("trending_date") == d18).count() > 0


def test_whole_run_from_bronze(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    d18, d19 = dt.date(2026, 5, 18), dt.date(2026, 5, 19)
    rows = spark.createDataFrame(flat_rows(d18) + flat_rows(d19, 100), FLAT)
    names = ["Music", "Gaming"] + [f"Cat{i}" for i in range(12, 20)]  # >= 10 rows: DQ minimum
    cats = spark.createDataFrame(
        [(10 + i, n, True, "e", "us" if i % 2 else "gb", dt.datetime(2026, 5, 18, 6)) for i, n in enumerate(names)],
        "category_id long, category_name string, assignable boolean, etag string, region string, "
        "ingestion_timestamp timestamp")
    jobs.land(spark, paths, rows, cats)
    run_ts = dt.datetime(2026, 5, 19, 18)
    res = jobs.run_medallion(spark, paths, ("us", "gb"), run_ts, dq.DQConfig(valid_regions=("us", "gb")))
    assert [r.status for r in res] == ["ok", "ok", "ok"], [(r.stage, r.status, r.metrics) for r in res]
    assert res[0].metrics["silver_rows"] == 24
    g = spark.read.parquet(paths.gold("category_analytics"))
    assert {r.category_name for r in g.collect()} == {"Music", "Gaming"}
    writers.register_table(spark, "trending_analytics_t", paths.gold("trending_analytics"))
    assert spark.sql("SELECT COUNT(*) FROM trending_analytics_t").first()[0] == 4
    # gate closed: regions outside the configured list
    res = jobs.run_medallion(spark, paths, ("us", "gb"), run_ts, dq.DQConfig(valid_regions=("us",)))
    assert [r.status for r in res] == ["ok", "dq_failed"]


def test_bronze_to_silver_region_isolation(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    run_ts = dt.datetime(2026, 5, 18, 18)
    # nothing landed at all: the run fails and writes nothing
    r = jobs.bronze_to_silver(spark, paths, ("us", "gb"), run_ts)
    assert r.status == "failed" and r.metrics["regions"]["us"]["missing"]
    # only gb lands; kr is configured but missing: the run goes on without it
    rows = [x for x in flat_rows(dt.date(2026, 5, 18)) if x[1] == "gb"]
    jobs.land(spark, paths, spark.createDataFrame(rows, FLAT))
    r = jobs.bronze_to_silver(spark, paths, ("gb", "kr"), run_ts)
    assert r.status == "ok", r.metrics
    assert r.metrics["regions"]["gb"]["items"] == 12 and r.metrics["regions"]["gb"]["documents"] == 2
    assert r.metrics["regions"]["kr"]["missing"] and r.metrics["regions"]["kr"]["failed"]
    assert r.metrics["silver_rows"] == 6
    assert "category_error" in r.metrics  # no category feed landed: non-fatal
    # every configured region missing -> failed, Silver untouched
    r = jobs.bronze_to_silver(spark, paths, ("kr",), run_ts)
    assert r.status == "failed"
    assert spark.read.parquet(paths.silver_stats).count() == 6


def categories(spark, ids, day):
    rows = [(i, f"Cat{i}", True, "e", "us", dt.datetime(day.year, day.month, day.day, 6)) for i in ids]
    return spark.createDataFrame(rows, "category_id long, category_name string, assignable boolean, etag string, region string, ingestion_timestamp timestamp")


def test_bounded_landing_days_lose_nothing(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    d18, d19 = dt.date(2026, 5, 18), dt.date(2026, 5, 19)
    jobs.land(spark, paths, spark.createDataFrame(flat_rows(d18), FLAT), categories(spark, [10, 11], d18))
    jobs.bronze_to_silver(spark, paths, ("us", "gb"), dt.datetime(2026, 5, 18, 18))
    # half of the 18th's videos land again a day later, under the next landing day
    late = [r[:8] + (r[8] + 5,) + r[9:] for r in flat_rows(d18, n=6)]
    jobs.land(spark, paths, spark.createDataFrame(flat_rows(d19) + late, FLAT), categories(spark, [12], d19))
    r = jobs.bronze_to_silver(spark, paths, ("us", "gb"), dt.datetime(2026, 5, 19, 18), landing_dates=(d19, d19))
    assert r.status == "ok" and not r.metrics["regions"]["us"]["stale"]
    silver = spark.read.parquet(paths.silver_stats)
    assert silver.groupBy("trending_date").count().orderBy("trending_date").collect()[0]["count"] == 12
    cats = spark.read.parquet(paths.silver_cats)
    assert sorted(c.category_id for c in cats.collect()) == [10, 11, 12]


def test_run_metrics(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    rows = flat_rows(dt.date(2026, 5, 18))
    rows.append((None, *rows[0][1:]))
    jobs.land(spark, paths, spark.createDataFrame(rows, FLAT))
    r = jobs.bronze_to_silver(spark, paths, ("us", "gb"), dt.datetime(2026, 5, 20))
    assert {k: r.metrics[k] for k in ("raw_rows", "null_id_dropped", "duplicates_removed", "silver_rows")} == {
        "raw_rows": 25, "null_id_dropped": 1, "duplicates_removed": 12, "silver_rows": 12}
    assert r.metrics["regions"]["us"]["stale"]


def test_a_late_region_is_built(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    d18, d19, ts = dt.date(2026, 5, 18), dt.date(2026, 5, 19), dt.datetime(2026, 5, 19)
    def write(region):
        rows = [r for d in (d18, d19) for r in flat_rows(d) if r[1] == region]
        writers.write_partitions(build_silver_statistics(spark.createDataFrame(rows, FLAT), ts), paths.silver_stats, ["region", "trending_date"])
    write("us")
    jobs.silver_to_gold(spark, paths, d19, ts)
    write("gb")
    r = jobs.silver_to_gold(spark, paths, dt.date(2026, 5, 25), ts)
    assert r.metrics["planned"]["trending_analytics"] == ["2026-05-18", "2026-05-19"]
    days = spark.read.parquet(paths.gold("trending_analytics")).select("region", "trending_date").collect()
    assert len(days) == 4 and len(set(days)) == 4


def test_gold_without_a_readable_dimension_is_unknown(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    d18 = dt.date(2026, 5, 18)
    write_silver(spark, paths, [d18])
    for part in glob.glob(os.path.join(paths.silver_cats, "region=*", "part-*")):
        with open(part, "wb") as f:
            f.write(b"no parquet here")
        os.unlink(os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc"))
    r = jobs.silver_to_gold(spark, paths, d18, dt.datetime(2026, 5, 18, 23))
    assert r.status == "ok" and r.metrics["category_error"]
    assert {c.category_name for c in spark.read.parquet(paths.gold("category_analytics")).collect()} == {"Unknown"}
    gate = jobs.quality_gate(spark, paths, dq.DQConfig(valid_regions=("us", "gb")), dt.datetime(2026, 5, 18, 23))
    assert gate.status == "dq_failed"
    assert [x.table_name for x in gate.report.where("check = 'read_table'").collect()] == [dq.DIM_TABLE]
