"""Benchmark: the pipeline's headline stages on the driver tables.

Runs on local[$BENCH_CPUS] against $BENCH_SF_DIR (default /root/testdata/sf0.1) and prints
ONE JSON line. Each stage is timed as the median of three warm runs (after one warm-up).
Query stages execute their full plan into Spark's ``noop`` sink (no output I/O); the
Silver and Gold stages write Parquet like the real jobs do.

Stages
* silver_build      adapter -> clean -> metrics -> dedup -> Silver parquet (widest shuffle)
* gold_<table>      each Gold builder over Silver parquet (all dates)
* gold_full_job     planner + four builders + writes, empty Gold (full rebuild)
* gold_incremental  same job, Gold up to date: only "today" is rebuilt (partition pruning)
* dq_full           every DQ check on both Silver tables (one aggregate per table)
* q1..q8            analyst SQL over Gold parquet
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trendlake.operators import dq, gold  # noqa: E402
from trendlake.plans import analyst, jobs  # noqa: E402
from trendlake.plans.gold import gold_facts  # noqa: E402
from trendlake.plans.silver import build_silver_categories, build_silver_statistics  # noqa: E402
from trendlake.session import get_spark  # noqa: E402
from trendlake.sinks import writers  # noqa: E402
from trendlake.sources import tpch_adapter as adapter  # noqa: E402

RUN_TS = dt.datetime(2001, 11, 5)


def timed(fn, runs=3):
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="trendlake-bench-")
    spark = get_spark(
        app_name="trendlake-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        extra_conf={
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = jobs.LakePaths(os.path.join(scratch, "lake"))
    q: dict[str, float] = {}

    def silver_build():
        lines = adapter.snapshot_lines(spark, sf_dir)
        writers.write_partitions(
            build_silver_statistics(adapter.raw_statistics(spark, sf_dir, lines), RUN_TS),
            lake.silver_stats, ["region", "trending_date"], "silver")
        writers.write_partitions(
            build_silver_categories(adapter.raw_categories(spark, sf_dir, lines), RUN_TS),
            lake.silver_cats, ["region"], "cats")

    q["silver_build"] = timed(silver_build)

    stats = spark.read.parquet(lake.silver_stats)
    cats = spark.read.parquet(lake.silver_cats)
    facts = gold_facts(stats, cats)
    q["gold_trending_analytics"] = timed(lambda: noop(gold.trending_analytics(facts, RUN_TS)))
    q["gold_channel_analytics"] = timed(lambda: noop(gold.channel_analytics(facts, RUN_TS)))
    q["gold_category_analytics"] = timed(lambda: noop(gold.category_analytics(facts, RUN_TS)))
    q["gold_video_velocity"] = timed(lambda: noop(gold.video_velocity(facts, None, RUN_TS)))

    latest = stats.agg({"trending_date": "max"}).first()[0]
    counter = iter(range(1000))

    def full_job():
        fresh = jobs.LakePaths(lake.root)
        root = os.path.join(scratch, f"gold-{next(counter)}")
        paths = _Paths(fresh, root)
        jobs.silver_to_gold(spark, paths, latest, RUN_TS)

    q["gold_full_job"] = timed(full_job)
    inc_paths = _Paths(lake, os.path.join(scratch, "gold-inc"))
    jobs.silver_to_gold(spark, inc_paths, latest, RUN_TS)
    q["gold_incremental"] = timed(lambda: jobs.silver_to_gold(spark, inc_paths, latest, RUN_TS))

    cfg = dq.DQConfig(valid_regions=("africa", "america", "asia", "europe", "middle east"))
    q["dq_full"] = timed(lambda: dq.run_checks(
        spark, {dq.FACT_TABLE: stats, dq.DIM_TABLE: cats}, cfg, RUN_TS).collect())

    gold_tables = {t: spark.read.parquet(inc_paths.gold(t)) for t in jobs.GOLD_BUILDERS}
    analyst.register_gold_views(spark, gold_tables)
    for name in sorted(analyst.SQL):
        q[name] = timed(lambda n=name: analyst.run_sql(spark, n).collect())

    total = round(sum(q.values()), 3)
    print(json.dumps({
        "metric": "pipeline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": q,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
    }))
    spark.stop()


class _Paths(jobs.LakePaths):
    """Silver from ``base``; Gold under its own root."""

    def __init__(self, base: jobs.LakePaths, gold_root: str):
        object.__setattr__(self, "root", base.root)
        object.__setattr__(self, "_gold_root", gold_root)

    def gold(self, table: str) -> str:
        return os.path.join(self._gold_root, table)


if __name__ == "__main__":
    main()
