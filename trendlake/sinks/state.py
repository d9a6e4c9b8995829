"""Versioned state tables: what a run carries to the next beside the Gold tables.

A version is a folder that is written whole, its rows first, then the (region, day) pairs that
are merged into it, then a marker. Readers take the latest marked version, so a run that dies
while it writes leaves the earlier one as it was, and the days that it didn't mark are planned
again. Nothing is overwritten in place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from trendlake.sinks.writers import path_exists

APPLIED = "region string, trending_date date, n long"


class VersionedState:
    """The table under ``path`` with rows of ``schema``.

    With ``upto``, versions after it don't count: they are what a run left that hasn't published them.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, upto: int | None = None) -> None:
        self.spark, self.path, self.schema, self.upto = spark, path.rstrip("/"), schema, upto

    def versions(self) -> list[int]:
        """Marked versions, ascending."""
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/version=*/marked/_SUCCESS")
        fs = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = (fs.globStatus(pattern) or []) if path_exists(self.spark, self.path) else []
        numbers = sorted(int(str(s.getPath()).split("/")[-3].partition("=")[2]) for s in found)
        return [n for n in numbers if self.upto is None or n <= self.upto]

    def _folder(self, version: int, part: str) -> str:
        return f"{self.path}/version={version}/{part}"

    def rows(self, version: int | None = None) -> DataFrame | None:
        """Rows of ``version``, or of the latest one; None before the first."""
        found = [version] if version is not None else self.versions()
        return self.spark.read.schema(self.schema).parquet(self._folder(found[-1], "rows")) if found else None

    def applied(self) -> dict[tuple[str, dt.date], int]:
        """(region, day) pairs that the latest version holds, with the rows each gave (bounded by the days)."""
        found = self.versions()
        if not found:
            return {}
        marked = self.spark.read.schema(APPLIED).parquet(self._folder(found[-1], "marked")).collect()
        return {(r.region, r.trending_date): r.n for r in marked}

    def commit(self, rows: DataFrame, applied: dict[tuple[str, dt.date], int], keep: int = 2) -> int:
        """Write the next version; versions before the last ``keep`` go. Returns its number."""
        found = self.versions()
        version = found[-1] + 1 if found else 1
        rows.write.mode("overwrite").parquet(self._folder(version, "rows"))  # over what a dead run may have left
        marks = self.spark.createDataFrame([(r, d, n) for (r, d), n in sorted(applied.items())], APPLIED)
        marks.coalesce(1).write.mode("overwrite").parquet(self._folder(version, "marked"))
        jvm = self.spark.sparkContext._jvm
        for old in found[: max(0, len(found) + 1 - keep)]:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/version={old}")
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        return version
