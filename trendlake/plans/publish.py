"""Gold's four tables published as one.

A run writes its partitions into folders of its own (``<table>/run=<run>/region=/trending_date=``),
where no reader looks. A manifest then names, for every (table, region, day), the run whose
partition counts, and for the velocity state the version that belongs to it. Its next version is
written whole and marked last, so readers see all tables of a run or none of them: a run that dies
anywhere before the mark leaves the earlier version as it was, state included, and its days are
planned again. A rebuilt day is replaced whole: a region left without rows there goes.

The manifest has a row per table, region and day, so the driver may hold it. One writer at a time;
a run that finds a later version than the one it began with publishes nothing. Readers of an
earlier version can go on until ``vacuum``, which deletes what the last two versions don't name.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.operators import incremental
from trendlake.sinks.state import VersionedState

MANIFEST = "table_name string, region string, trending_date date, run string"
NULL_REGION = "__HIVE_DEFAULT_PARTITION__"  # a null region's folder name

Days = set[tuple[str, dt.date]]


class PublishedGold:
    """The tables under ``root`` as of manifest ``version`` (by default the latest when first asked)."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.manifest = VersionedState(spark, f"{self.root}/manifest", MANIFEST)
        self.run = f"r{uuid.uuid4().hex}"
        if version is not None:
            self.version = version

    @cached_property
    def version(self) -> int:
        return max(self.manifest.versions(), default=0)

    @cached_property
    def entries(self) -> dict[tuple, str]:
        """(table, region, day) -> run (or a state's version); bounded by the days."""
        if not self.version:
            return {}
        rows = self.manifest.rows(self.version).collect()
        return {(r.table_name, r.region, r.trending_date): r.run for r in rows}

    def days(self, table: str) -> Days:
        """(region, day) partitions of ``table``, as ``incremental.partition_days`` lists a folder's."""
        return {(NULL_REGION if r is None else r, d) for t, r, d in self.entries if t == table}

    def state_version(self, state: str) -> int:
        return int(self.entries.get((state, None, None), 0))

    def read(self, table: str) -> DataFrame | None:
        """The published rows of ``table``; None if it has none.

        The manifest's rows join the files by partition columns only, so partitions of other runs
        are pruned when the query runs.
        """
        runs = sorted({run for (t, _, day), run in self.entries.items() if t == table and day is not None})
        if not runs:
            return None
        base = f"{self.root}/{table}"
        found = self.spark.read.option("basePath", base).parquet(*[f"{base}/run={run}" for run in runs]).alias("found")
        live = self.manifest.rows(self.version).where(F.col("table_name") == table).alias("live")
        same = F.col("found.region").eqNullSafe(F.col("live.region"))
        for key in ("trending_date", "run"):
            same &= F.col(f"found.{key}") == F.col(f"live.{key}")
        return found.join(live, same, "left_semi").drop("run")

    def staged(self, table: str) -> str:
        """Where this object's run writes its partitions of ``table``."""
        return f"{self.root}/{table}/run={self.run}"

    def publish(self, rebuilt: Mapping[str, Collection[dt.date]], states: Mapping[str, int]) -> int:
        """Commit the staged partitions of the tables' days ``rebuilt``, and the states' versions. Returns the manifest's."""
        if max(self.manifest.versions(), default=0) != self.version:
            raise RuntimeError(f"{self.root} has been published by another run since version {self.version}")
        new = {key: run for key, run in self.entries.items() if key[2] is None or key[2] not in rebuilt.get(key[0], ())}
        for table in rebuilt:
            for region, day in incremental.partition_days(self.spark, self.staged(table)):
                new[table, None if region == NULL_REGION else region, day] = self.run
        new |= {(state, None, None): str(version) for state, version in states.items()}
        rows = self.spark.createDataFrame([(*key, run) for key, run in new.items()], MANIFEST)
        return self.manifest.commit(rows.coalesce(1), {})

    def vacuum(self, tables: Collection[str]) -> int:
        """Delete partitions of ``tables`` that no kept manifest names, those of dead runs included. Not while a run
        writes. Returns the folders deleted."""
        kept = set()
        for version in self.manifest.versions():
            kept |= {(*key, run) for key, run in PublishedGold(self.spark, self.root, version).entries.items()}
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        gone = 0
        for table in tables:
            pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}/run=*/region=*/trending_date=*")
            fs = pattern.getFileSystem(conf)
            for status in fs.globStatus(pattern) or []:
                run, region, day = incremental.partition_values(str(status.getPath()), 3)
                region = None if region == NULL_REGION else region
                if (table, region, dt.date.fromisoformat(day), run) not in kept:
                    gone += bool(fs.delete(status.getPath(), True))
        return gone
