"""Streaming Bronze -> Silver equals the batch build, and a later snapshot of the same day
replaces the earlier one."""

import datetime as dt
import os

from trendlake.operators import flatten
from trendlake.plans import jobs
from trendlake.plans.silver import build_silver_statistics, merge_silver
from trendlake.sources import bronze
from trendlake.streaming.bronze_stream import start_bronze_stream

from tests.test_jobs import FLAT, flat_rows


def _run(spark, paths, ckpt):
    q = start_bronze_stream(spark, paths.bronze_stats, paths.silver_stats, ckpt, run_ts=dt.datetime(2026, 5, 20))
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_matches_batch(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    ckpt = os.path.join(tmp_lake, "_ckpt")
    d18, d19 = dt.date(2026, 5, 18), dt.date(2026, 5, 19)
    jobs.land(spark, paths, spark.createDataFrame(flat_rows(d18), FLAT))
    _run(spark, paths, ckpt)
    first = spark.read.parquet(paths.silver_stats).count()
    assert first == 12

    # second landing: a fresher snapshot of the 18th and a new day
    later = [r[:15] + (r[15] + dt.timedelta(hours=6), r[16] + "x") for r in flat_rows(d18, 7)]
    jobs.land(spark, paths, spark.createDataFrame(later + flat_rows(d19), FLAT))
    _run(spark, paths, ckpt)

    silver = spark.read.parquet(paths.silver_stats)
    raw = bronze.read_bronze_statistics(spark, paths.bronze_stats, multi_line=False)
    batch = build_silver_statistics(flatten.flatten_statistics(raw))
    cols = [c for c in silver.columns if not c.startswith("_")]
    assert silver.count() == 24
    assert sorted(map(tuple, silver.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
    # nothing new: the checkpoint remembers the files, Silver is unchanged
    _run(spark, paths, ckpt)
    assert spark.read.parquet(paths.silver_stats).count() == 24


def test_stream_keeps_rows_without_a_date_as_the_batch_does(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    rows = [r[:15] + (None, r[16]) if r[0] == "v1" else r for r in flat_rows(dt.date(2026, 5, 18), n=3)]
    flat = spark.createDataFrame(rows, FLAT)
    want = build_silver_statistics(flat)
    merge_silver(spark, flat, paths.silver_stats, dt.datetime(2026, 5, 20), "t")
    merge_silver(spark, flat, paths.silver_stats, dt.datetime(2026, 5, 20), "t")
    got = spark.read.parquet(paths.silver_stats)
    cols = [c for c in want.columns if not c.startswith("_")]
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(map(key, got.select(*cols).collect())) == sorted(map(key, want.select(*cols).collect()))
    assert got.where("trending_date is null").count() == 1
