"""The driver-side planner (partition listings) and the DataFrame planner agree."""

import datetime as dt
import random

from trendlake.operators import incremental


def _df(spark, dates):
    return spark.createDataFrame([(d,) for d in sorted(dates)], "trending_date date")


def test_set_planner_matches_dataframe_planner(spark):
    rnd = random.Random(7)
    days = [dt.date(2026, 5, 1) + dt.timedelta(days=i) for i in range(12)]
    for _ in range(6):
        silver = set(rnd.sample(days, 8))
        gold = set(rnd.sample(days, 5))
        run = rnd.choice(days)
        want = sorted(r.trending_date for r in incremental.plan_dates(_df(spark, silver), _df(spark, gold), run).collect())
        as_days = lambda dates: {(r, d) for d in dates for r in ("us", "gb")}
        got = incremental.plan_date_sets(as_days(silver), {"t": as_days(gold)}, run)["t"]
        assert got == want
        over = rnd.sample(days, 3)
        want = sorted(r.trending_date for r in incremental.plan_dates(_df(spark, silver), None, None, over).collect())
        assert incremental.plan_date_sets(as_days(silver), {"t": as_days(gold)}, run, over)["t"] == want


def test_a_missing_region_makes_its_date_new():
    d = dt.date(2026, 5, 18)
    assert incremental.plan_date_sets({("us", d), ("gb", d)}, {"t": {("us", d)}}, None) == {"t": [d]}
    assert incremental.plan_date_sets({("us", d)}, {"t": {("us", d)}}, None) == {"t": []}


def test_partition_listing(spark, tmp_path):
    root = tmp_path / "t"
    for r, d in (("us", "2026-05-18"), ("middle%20east", "2026-05-19"), ("gb", "__HIVE_DEFAULT_PARTITION__"), ("kr", "2026-05-20")):
        folder = root / f"region={r}" / f"trending_date={d}"
        folder.mkdir(parents=True)
        if r != "kr":  # an empty folder is no partition
            (folder / "part-0.parquet").write_bytes(b"")
    assert incremental.partition_days(spark, str(root)) == {("us", dt.date(2026, 5, 18)), ("middle east", dt.date(2026, 5, 19))}
    assert incremental.partition_days(spark, str(tmp_path / "missing")) == set()
