"""Writers: Bronze landing, Silver/Gold partitioned Parquet, catalog registration.

All Parquet writes are dynamic partition overwrites set as a writer option (not global
session state): only the partitions present in the frame are replaced, every other
partition stays untouched, and re-running a write leaves the same rows (idempotent; a
retried append would have duplicated them). Row counts come from an ``Observation`` on
the write itself, not from an extra ``count()`` job.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from trendlake.session import scratch_dir


def write_bronze(
    envelopes: DataFrame, root: str, partition_cols: Sequence[str], spread: bool = True
) -> None:
    """Append envelopes as JSON Lines under ``root/region=/date=[/hour=]``.

    Appending is deliberate: re-landing the same hour adds a document and Silver's
    deduplication absorbs it. UTF-8 text is written as is (non-ASCII preserved).
    ``REBALANCE`` clusters by directory and lets AQE split a hot hour across tasks. Documents
    repeat their field names, so files are gzipped; readers tell by the file's name. Envelopes
    that lie by directory already (``landing.statistics_pages``) are written as they lie with ``spread=False``.
    """
    (
        (envelopes.hint("rebalance", *partition_cols) if spread else envelopes)
        .write.mode("append")
        .partitionBy(*partition_cols)
        .option("compression", "gzip")
        .json(root)
    )


def write_partitions(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    name: str = "rows",
    finish: Callable[[DataFrame], DataFrame] | None = None,
    spread: bool = True,
) -> int:
    """Dynamic-overwrite ``df`` into ``path`` partitioned by ``partition_cols``.

    Returns the number of rows written (0 means nothing was written and no partition was
    touched). Rows are clustered by the partition columns with a ``REBALANCE`` hint: each
    output directory gets files from few tasks (no small-file explosion), while AQE splits
    a skewed partition (a hot region-day) into advisory-size pieces instead of giving it
    to one task. ``finish`` makes what follows from a row's own columns behind that shuffle,
    so that it needn't travel. Rows that lie by the partition columns already, as a global sort
    leaves them, are written as they lie with ``spread=False``.
    """
    obs = Observation(f"write_{name}_{uuid.uuid4().hex[:8]}")  # names must be unique
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    dealt = observed.hint("rebalance", *partition_cols) if spread else observed
    (
        (finish(dealt) if finish else dealt)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
    return observed_rows(obs)


def observed(obs: Observation) -> dict:
    """Values of an observation; none if no rows flowed. When AQE finds an upstream stage
    empty at run time it replaces the rest of the plan, metrics node included, with an empty
    relation, and the observation comes back with an empty row."""
    row = obs._jo.getRow() if obs._jo is not None else None
    return dict(obs.get) if row is not None and row.length() else {}


def observed_rows(obs: Observation, key: str = "rows") -> int:
    return int(observed(obs).get(key) or 0)


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: one evaluation, no lineage."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """``write_scratch`` in as many buckets of ``key`` (a column or several) as a shuffle has partitions, sorted by ``order``.

    What groups or joins the rows by the key finds them in place, however often they are read.
    The table is external, of a name of its own, in the scratch folder.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").bucketBy(buckets, *([key] if isinstance(key, str) else key)).sortBy(*order).option("path", scratch_dir(spark, name)).saveAsTable(table, format="parquet")
    return spark.table(table)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def read_parquet_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """Read a Parquet table; ``None`` when the path does not exist yet."""
    if not path_exists(spark, path):
        return None
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(path)
        df.schema  # noqa: B018 - forces the path check at analysis time
        return df
    except AnalysisException:
        return None


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Make a partitioned Parquet folder queryable by name and register its partitions
    (the catalog-crawler step). Schema and partition columns are taken from the files;
    partitions written later stay invisible to the table until this runs again."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
