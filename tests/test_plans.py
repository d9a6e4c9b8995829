"""Physical-plan properties the design relies on (checked on the optimized plan)."""

import datetime as dt
import time

from pyspark.sql import functions as F

from trendlake.operators import gold, landing
from trendlake.plans import catalog, jobs, velocity
from trendlake.plans.gold import GOLD_INPUT_COLUMNS, build_pairs, build_velocity, gold_facts, single_rows
from trendlake.plans.silver import build_silver_statistics
from trendlake.sinks import writers

from tests.test_jobs import FLAT, flat_rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _silver(spark, tmp_path):
    rows = flat_rows(dt.date(2026, 5, 18)) + flat_rows(dt.date(2026, 5, 19))
    path = str(tmp_path / "silver")
    writers.write_partitions(build_silver_statistics(spark.createDataFrame(rows, FLAT)), path,
                             ["region", "trending_date"])
    return spark.read.parquet(path)


def test_gold_day_filter_prunes_partitions_and_columns(spark, tmp_path):
    facts = gold_facts(_silver(spark, tmp_path), None)
    plan = _plan(gold.trending_analytics(gold.restrict_dates(facts, [dt.date(2026, 5, 19)])))
    assert "PartitionFilters: [isnotnull(trending_date" in plan and "2026-05-19" in plan
    assert "description" not in plan and "publish_time" not in plan  # pruned at the scan
    assert "WindowGroupLimit" in plan  # dedup is a partial + final top-1


def test_daily_velocity_cuts_histories_below_the_dedup(spark, tmp_path):
    plan = _plan(build_velocity(_silver(spark, tmp_path), None, [dt.date(2026, 5, 19)]))
    tops = [i for i, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line]
    semi = next(i for i, line in enumerate(plan.splitlines()) if "LeftSemi" in line)
    assert len(tops) == 2 and max(tops) < semi  # partial and final; the tree prints parents first
    assert "(trending_date" in plan and "<= 2026-05-19" in plan


def test_daily_builders_read_facts_once_without_distinct_or_objects(spark, tmp_path):
    facts = gold_facts(_silver(spark, tmp_path), None)
    plan = _plan(gold.day_cube(facts))
    assert "Expand" not in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert "Expand" not in _plan(gold.trending_analytics(facts))


def test_metrics_are_not_shuffled_for_the_dedup(spark, tmp_path):
    rows = flat_rows(dt.date(2026, 5, 18))
    plan = _plan(build_silver_statistics(spark.createDataFrame(rows, FLAT)).select("video_id", "engagement_rate"))
    lines = plan.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)  # the tree prints parents first
    assert any("engagement_rate" in line for line in lines[:exchange]) and not any("engagement_rate" in line for line in lines[exchange:])


def test_facts_are_not_shuffled_by_category(spark):
    plan = _plan(catalog.facts(spark, "/root/testdata/sf0.001"))
    assert "SortMergeJoin [category_id" not in plan and "BroadcastHashJoin [category_id" in plan


def test_channels_are_rolled_up_where_the_cube_was_made(spark, tmp_path):
    plan = _plan(gold.channel_aggregates(gold_facts(_silver(spark, tmp_path), None)))
    assert plan.count("Exchange hashpartitioning") == 2  # for the dedup, then by channel and day


def test_scenarios_evaluate_silver_once(spark, monkeypatch):
    made, real = [], catalog.silver_stats
    monkeypatch.setattr(catalog, "silver_stats", lambda *a: made.append(a) or real(*a))
    plan = _plan(catalog.q_incremental_velocity(spark, "/root/testdata/sf0.001"))
    assert len(made) == 1 and "lineitem.parquet" not in plan  # the rest reads what was written


def test_envelopes_run_their_source_once_and_sort_its_rows_once(spark):
    plan = _plan(catalog.q_flatten_stats(spark, "/root/testdata/sf0.001"))
    assert "lineitem.parquet" not in plan  # counted and gathered from what was written
    assert plan.count("SortAggregate") == 1 and plan.count("Sort [") == 1 and "ObjectHashAggregate" not in plan
    raw = writers.write_scratch(catalog.raw_stats(spark, "/root/testdata/sf0.001"), "raw")
    assert landing.statistics_pages(raw, kept=True).inputFiles() == raw.inputFiles()  # not written again


def test_scenarios_find_silver_by_video_and_join_their_source_once(spark):
    full, cats, f = catalog._silver_once(spark, "/root/testdata/sf0.001")
    assert "Exchange hashpartitioning" not in _plan(f.select("trending_date", "video_id"))  # deduplicated where it lies
    early, _ = catalog._scenario(f)
    keys = ["video_id", "region", "trending_date"]
    assert "Exchange hashpartitioning" not in _plan(full.join(early.select(*keys).hint("merge"), keys, "left_semi"))
    plan = _plan(catalog.facts(spark, "/root/testdata/sf0.001"))
    assert "lineitem.parquet" not in plan and "Exchange hashpartitioning(video_id" not in plan


def test_silver_job_makes_metrics_behind_the_writers_shuffle(spark, tmp_lake, monkeypatch):
    made, real = {}, writers.write_partitions
    monkeypatch.setattr(writers, "write_partitions", lambda df, path, cols, name, *finish: made.update({name: df}) or real(df, path, cols, name, *finish))
    paths = jobs.LakePaths(tmp_lake)
    jobs.land(spark, paths, spark.createDataFrame(flat_rows(dt.date(2026, 5, 18)), FLAT))
    result = jobs.bronze_to_silver(spark, paths, ("us", "gb"), dt.datetime(2026, 5, 18, 18))
    assert result.status == "ok" and set(result.metrics["warnings"])
    assert not {"like_ratio", "engagement_rate", "views_tier", "_job_name"} & set(made["silver_stats"].columns)


def test_late_days_compare_the_keys_of_earlier_ones_alone(spark, tmp_path, monkeypatch):
    stats, made, real = _silver(spark, tmp_path), {}, writers.write_partitions
    monkeypatch.setattr(writers, "write_partitions", lambda df, path, cols, name, *finish: made.update({name: df}) or real(df, path, cols, name, *finish))
    late, later = dt.date(2026, 5, 18), dt.date(2026, 5, 19)
    pairs = {(r.region, r.trending_date) for r in stats.select("region", "trending_date").distinct().collect()}
    for day, held in ((later, {p for p in pairs if p[1] == later}), (late, pairs)):
        now = stats.where(F.col("trending_date").isin([d for _, d in held]))
        done = velocity.run_velocity(spark, str(tmp_path / "velocity"), str(tmp_path / "state"), now, None, [day], held, dt.datetime(2026, 5, 20),
                                     single=single_rows(gold.restrict_dates(now, [day])))
    assert done[1]["mode"] == "late" and done[0] == spark.read.parquet(str(tmp_path / "velocity")).count() > 0
    assert "LeftAnti" in _plan(made["video_velocity"])  # those of several rows, found by their keys, aside


def test_a_querys_shuffle_files_go_when_it_ends(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        blocks = disk.getAllBlocks()
        return {blocks.apply(i).name() for i in range(blocks.size()) if blocks.apply(i).isShuffle()}

    before = held()
    made = writers.write_scratch(spark.range(1000).repartition(4).groupBy((F.col("id") % 10).alias("k")).count(), "counted")
    end = time.time() + 20
    while held() - before and time.time() < end:
        time.sleep(0.2)
    assert not held() - before and made.count() == 10


def test_silver_is_deduplicated_where_parts_were_joined(spark):
    plan = _plan(catalog.silver_stats(spark, "/root/testdata/sf0.001"))
    # orders and customers, both by customer; they and line items by order; line items and parts by video
    assert plan.count("Exchange hashpartitioning") == 6 and plan.count("hashpartitioning(video_id") == 1
    assert "SortMergeJoin [video_id" in plan  # at any size


def test_metrics_are_made_behind_the_writers_shuffle(spark, monkeypatch):
    made, real = {}, writers.write_partitions
    monkeypatch.setattr(writers, "write_partitions", lambda df, path, cols, name, *finish: made.update({name: (df, *finish)}) or real(df, path, cols, name, *finish))
    back = catalog.q_silver_write(spark, "/root/testdata/sf0.001")
    narrow, _ = made["silver_stats"]
    assert not {"like_ratio", "engagement_rate", "views_tier", "_job_name"} & set(narrow.columns)
    assert {"like_ratio", "engagement_rate", "views_tier"} <= set(back.columns) and back.where("views > 0 and likes > 0 and like_ratio is null").count() == 0


def test_velocity_runs_find_videos_in_place(spark):
    stats = catalog._velocity_stats(spark, "/root/testdata/sf0.001")
    days = {r[0] for r in stats.select("trending_date").distinct().collect()}
    assert "Exchange" not in _plan(build_pairs(stats, None))
    late = _plan(build_pairs(stats, None, [max(days)]).hint("rebalance"))
    assert "LeftSemi" in late and "hashpartitioning(video_id" not in late
    assert "Exchange" not in _plan(velocity.last_two(gold_facts(stats, None)))
    assert stats.columns == list(GOLD_INPUT_COLUMNS)


def test_velocity_makes_growth_behind_the_writers_shuffle(spark, tmp_path, monkeypatch):
    stats, made, real = _silver(spark, tmp_path), {}, writers.write_partitions
    monkeypatch.setattr(writers, "write_partitions", lambda df, path, cols, name, *finish: made.update({name: df}) or real(df, path, cols, name, *finish))
    pairs = {(r.region, r.trending_date) for r in stats.select("region", "trending_date").distinct().collect()}
    n, _ = velocity.run_velocity(spark, str(tmp_path / "velocity"), str(tmp_path / "state"), stats, None, sorted({d for _, d in pairs}), pairs, dt.datetime(2026, 5, 20))
    assert n == spark.read.parquet(str(tmp_path / "velocity")).count() > 0
    assert not {"momentum", "view_growth_pct", "views_per_day"} & set(made["video_velocity"].columns) and "LeftSemi" not in _plan(made["video_velocity"])


def test_rows_of_a_run_are_deduplicated_where_they_lie(spark, tmp_path):
    stats = _silver(spark, tmp_path)
    rows = stats.unionByName(stats.where("video_id = 'v1'").withColumns({"views": F.col("views") + 1, "ingestion_id": F.lit("z")}))
    rows = rows.unionByName(stats.limit(1).withColumn("region", F.lit(None).cast("string"))).unionByName(stats.limit(2))
    single = single_rows(rows)
    want = gold_facts(rows, None)
    assert sorted(map(str, gold_facts(single, None, redup=False).select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert want.count() < rows.count()
    plan = _plan(single_rows(stats))
    assert plan.index("LeftAnti") < plan.index("Window") and plan.count("Exchange hashpartitioning") == 1  # for repeated rows alone


def test_a_run_keeps_its_cube_dealt_by_channel(spark, tmp_path, monkeypatch):
    seen, real = {}, gold.channel_analytics
    monkeypatch.setattr(gold, "channel_analytics", lambda facts, run_ts, cube: seen.update(cube=cube) or real(facts, run_ts, cube))
    paths = jobs.LakePaths(str(tmp_path))
    rows = spark.createDataFrame(flat_rows(dt.date(2026, 5, 18)), FLAT)
    writers.write_partitions(build_silver_statistics(rows), paths.silver_stats, ["region", "trending_date"])
    jobs.silver_to_gold(spark, paths, dt.date(2026, 5, 18), dt.datetime(2026, 5, 20))
    assert "Exchange" not in _plan(gold.channel_aggregates(None, seen["cube"]))
