"""Gold published as one: a run that dies anywhere leaves the earlier version, and the next run is as if it had never been."""

import datetime as dt
import glob
import os
import subprocess
import sys

import pytest

from trendlake.operators import gold
from trendlake.plans import jobs, velocity
from trendlake.plans.gold import GOLD_BUILDERS, build_gold, gold_facts
from trendlake.plans.publish import PublishedGold
from trendlake.schemas import PROVENANCE_COLUMNS, SILVER_CATS, SILVER_STATS

from tests.test_jobs import write_silver

D18, D19, D20 = (dt.date(2026, 5, d) for d in (18, 19, 20))
TS = dt.datetime(2026, 5, 20, 23)
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(spark, paths, day, **more):
    return jobs.silver_to_gold(spark, paths, day, TS, publish=True, **more)


def rows(df):
    if df is None:
        return []
    cols = sorted(c for c in df.columns if c not in PROVENANCE_COLUMNS)
    return sorted(map(str, df.select(*cols).collect()))


def seen(spark, paths, version=None):
    tables = PublishedGold(spark, paths.published, version)
    return {t: rows(tables.read(t)) for t in GOLD_BUILDERS}


def rebuilt(spark, paths):
    """Gold of all of Silver, by the plain builders."""
    facts = gold_facts(spark.read.schema(SILVER_STATS).parquet(paths.silver_stats), spark.read.schema(SILVER_CATS).parquet(paths.silver_cats))
    return {t: rows(df) for t, df in build_gold(facts).items()}


def test_versions_and_a_run_that_dies_between_tables(spark, tmp_lake, monkeypatch):
    paths = jobs.LakePaths(tmp_lake)
    assert seen(spark, paths) == {t: [] for t in GOLD_BUILDERS}
    write_silver(spark, paths, [D18])
    assert run(spark, paths, D18).metrics["version"] == 1
    first = seen(spark, paths)
    assert first == rebuilt(spark, paths) and first["trending_analytics"] and not first["video_velocity"]

    write_silver(spark, paths, [D18, D19], boost=500)
    def die(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:  # before the third table
        m.setattr(gold, "category_analytics", die)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, paths, D19)
    assert glob.glob(os.path.join(paths.published, "trending_analytics", "run=*", "region=*", "trending_date=2026-05-19"))
    assert seen(spark, paths) == first
    with monkeypatch.context() as m:  # all tables and the velocity state written, nothing published
        m.setattr(PublishedGold, "publish", die)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, paths, D19)
    assert seen(spark, paths) == first
    assert PublishedGold(spark, paths.published).state_version(velocity.STATE_NAME) == 1

    write_silver(spark, paths, [D20], boost=900)  # the lost day and a new one: velocity looks back through both
    r = run(spark, paths, D20, dates_override=[D18, D19, D20])
    assert r.status == "ok" and r.metrics["version"] == 2
    assert seen(spark, paths) == rebuilt(spark, paths)
    assert seen(spark, paths, 1) == first

    held = len(glob.glob(os.path.join(paths.published, "*", "run=*", "region=*", "trending_date=*")))
    gone = PublishedGold(spark, paths.published).vacuum(GOLD_BUILDERS)
    assert 0 < gone < held  # what the two dead runs left
    assert seen(spark, paths, 1) == first and seen(spark, paths) == rebuilt(spark, paths)
    assert PublishedGold(spark, paths.published).vacuum(GOLD_BUILDERS) == 0


def test_days_beside_gold_lost_after_publishing_are_planned_again(spark, tmp_lake, monkeypatch):
    paths = jobs.LakePaths(tmp_lake)
    write_silver(spark, paths, [D18, D19])
    with monkeypatch.context() as m:
        m.setattr(jobs.lifetime, "merge_days", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, paths, D19)
    assert seen(spark, paths) == rebuilt(spark, paths)
    run(spark, paths, dt.date(2026, 5, 25))
    assert jobs.lifetime.merged_days(spark, paths.state("channel_days")) == {(r, d) for r in ("us", "gb") for d in (D18, D19)}


def test_daily_runs_read_the_published_state(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    modes = []
    for day in (D18, D20, D19):  # the 19th comes late
        write_silver(spark, paths, [day], boost=day.day)
        modes.append(run(spark, paths, day).metrics["velocity"]["mode"])
        assert seen(spark, paths) == rebuilt(spark, paths)
    assert modes == ["first", "forward", "late"]
    assert run(spark, paths, dt.date(2026, 5, 25)).status == "noop"
    assert max(PublishedGold(spark, paths.published).manifest.versions()) == 3


def test_a_second_writer_publishes_nothing(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    write_silver(spark, paths, [D18])
    run(spark, paths, D18)
    slow = PublishedGold(spark, paths.published)
    assert slow.days("trending_analytics") == {("us", D18), ("gb", D18)}
    run(spark, paths, D18)
    with pytest.raises(RuntimeError, match="another run"):
        slow.publish({"trending_analytics": [D18]}, {})
    assert seen(spark, paths) == rebuilt(spark, paths)


def test_a_rebuilt_day_is_replaced_whole(spark, tmp_lake):
    import shutil

    paths = jobs.LakePaths(tmp_lake)
    write_silver(spark, paths, [D18, D19])
    run(spark, paths, D19)
    shutil.rmtree(os.path.join(paths.silver_stats, "region=gb", "trending_date=2026-05-19"))
    run(spark, paths, D19)
    assert seen(spark, paths) == rebuilt(spark, paths)


def test_partitions_of_other_runs_are_pruned(spark, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    write_silver(spark, paths, [D18, D19])
    run(spark, paths, D19)
    write_silver(spark, paths, [D19], boost=9)
    run(spark, paths, D19)
    plan = PublishedGold(spark, paths.published).read("category_analytics")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower(), plan


KILLED = """
import datetime as dt, os, sys
from trendlake.operators import gold
from trendlake.plans import jobs
from trendlake.session import get_spark
spark = get_spark(app_name="killed", master="local[2]", shuffle_partitions=4, extra_conf={"spark.checkpoint.dir": sys.argv[2]})
gold.category_analytics = lambda *a, **k: os._exit(9)
jobs.silver_to_gold(spark, jobs.LakePaths(sys.argv[1]), dt.date(2026, 5, 19), dt.datetime(2026, 5, 20), publish=True)
"""


def test_a_killed_process(spark, tmp_lake, tmp_path):
    paths = jobs.LakePaths(tmp_lake)
    write_silver(spark, paths, [D18])
    run(spark, paths, D18)
    first = seen(spark, paths)
    write_silver(spark, paths, [D18, D19], boost=500)
    done = subprocess.run([sys.executable, "-c", KILLED, tmp_lake, str(tmp_path / "scratch")], cwd=ROOT, timeout=300, capture_output=True)
    assert done.returncode == 9, done.stderr[-2000:]
    assert seen(spark, paths) == first
    run(spark, paths, D19, dates_override=[D18, D19])
    assert seen(spark, paths) == rebuilt(spark, paths)
