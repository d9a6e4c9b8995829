"""Incremental date planning.

``to_process = (silver_dates - gold_dates) UNION ({run_date} if run_date in silver)``,
planned for each Gold table against its own partitions, so a run that died between two
tables re-plans the tables it did not finish. ``dates_override`` replaces the plan
(parametrised backfill). Dates are ``DateType`` throughout (no string round trips), and
null trending dates are never planned.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.sinks.writers import path_exists

DATE = "trending_date"


def distinct_dates(df: DataFrame) -> DataFrame:
    """Distinct non-null trending dates (a partial-aggregated distinct)."""
    return df.select(F.col(DATE).cast("date").alias(DATE)).where(F.col(DATE).isNotNull()).distinct()


def partition_values(path: str, levels: int) -> list[str]:
    """Values in the last ``levels`` parts of a path of ``column=value`` folders; a file's name gives ''."""
    return [unquote(part.partition("=")[2]) for part in path.split("/")[-levels:]]


def partition_days(spark: SparkSession, path: str) -> set[tuple[str, dt.date]]:
    """(region, date) partitions with data files in a table partitioned by (region,
    trending_date). The files are the ground truth, as in the key listing the reference
    did: one glob through the table's Hadoop FileSystem, no Spark job and no Parquet footer
    read. A missing table has none, an empty directory counts as none, and the null-date
    partition is never planned."""
    if not path_exists(spark, path):
        return set()
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + f"/region=*/{DATE}=*/part-*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = set()
    for status in fs.globStatus(pattern) or []:
        region, day, _ = partition_values(str(status.getPath()), 3)
        try:
            found.add((region, dt.date.fromisoformat(day)))
        except ValueError:  # __HIVE_DEFAULT_PARTITION__ (null date)
            continue
    return found


def catalog_days(spark: SparkSession, table: str) -> set[tuple[str, dt.date]]:
    """(region, date) partitions of a table as its catalog has them; none for an unknown table. No file is
    listed, so what was written since the table's last refresh isn't seen (and planned again)."""
    if not spark.catalog.tableExists(table):
        return set()
    found = set()
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table}").collect():  # bounded by the days
        values = dict(unquote(part).split("=", 1) for part in spec.split("/"))
        try:
            found.add((values["region"], dt.date.fromisoformat(values[DATE])))
        except ValueError:  # the null date
            continue
    return found


def dated_regions(spark: SparkSession, path: str) -> set[tuple[str, dt.date]]:
    """(region, date) pairs in a table of a row per pair, partitioned by trending_date alone."""
    if not path_exists(spark, path):
        return set()
    pairs = spark.read.parquet(path).select("region", DATE).distinct().collect()  # bounded by the days
    return {(r["region"], r[DATE]) for r in pairs}


def plan_dates(
    silver_dates: DataFrame,
    gold_dates: DataFrame,
    run_date: dt.date | str | None,
    dates_override: Iterable | None = None,
) -> DataFrame:
    """Dates to (re)build: columns trending_date, is_new, is_today."""
    if dates_override is not None:
        spark = silver_dates.sparkSession
        rows = [(dt.date.fromisoformat(str(d)),) for d in dates_override]
        forced = spark.createDataFrame(rows, f"{DATE} date").distinct()
        return forced.join(silver_dates, DATE, "left_semi").select(
            DATE, F.lit(False).alias("is_new"), F.lit(False).alias("is_today")
        )
    new = silver_dates.join(gold_dates, DATE, "left_anti").select(
        DATE, F.lit(True).alias("is_new"), F.lit(False).alias("is_today")
    )
    if run_date is None:
        return new
    today = silver_dates.where(F.col(DATE) == F.lit(str(run_date)).cast("date")).select(
        DATE, F.lit(False).alias("is_new"), F.lit(True).alias("is_today")
    )
    return new.unionByName(today).groupBy(DATE).agg(
        F.max("is_new").alias("is_new"), F.max("is_today").alias("is_today")
    )


def plan_date_sets(
    silver_days: set[tuple[str, dt.date]],
    existing: dict[str, set[tuple[str, dt.date]]],
    run_date: dt.date | str | None,
    dates_override: Iterable | None = None,
) -> dict[str, list[dt.date]]:
    """``plan_dates`` for every table when both sides are partition listings (small
    driver-side sets bounded by the number of region-days): same rules, no Spark job.

    A date is new to a table while any of its regions is: a region that arrives after its
    date was built, or was lost with a run that died, is planned again.
    """
    have_dates = {d for _, d in silver_days}
    if dates_override is not None:
        forced = {dt.date.fromisoformat(str(d)) for d in dates_override} & have_dates
        return {t: sorted(forced) for t in existing}
    today = dt.date.fromisoformat(str(run_date)) if run_date is not None else None
    todays = {today} & have_dates if today else set()
    return {t: sorted({d for _, d in silver_days - have} | todays) for t, have in existing.items()}


def collect_dates(plan: DataFrame) -> list[dt.date]:
    """The planned dates as a sorted Python list (bounded by the number of days in
    Silver), used as an ``IN`` list so the Parquet scan prunes partitions."""
    return sorted(r[DATE] for r in plan.select(DATE).collect())
