"""Session helpers.

The pipeline needs the session time zone pinned to UTC (trending dates and the run
clock are UTC). Scratch output (checkpoints, landing round trips) goes under the shared
folder the cluster names in ``spark.checkpoint.dir``; a temp folder is created only for a
local session without that setting, as in tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    app_name: str = "trendlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session configured for the pipeline."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the settings every builder relies on (idempotent, cheap)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # joins by video and region take rows where they lie by video
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    # rows that lie sorted by their groups are aggregated as they come, not sorted again
    spark.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")
    # a query's shuffle files go when it ends, not when the driver happens to collect its garbage
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """Return a fresh sub-folder of the shared folder named by ``spark.checkpoint.dir``.

    The setting is only read. Where it is unset, a folder set with ``setCheckpointDir`` is used;
    failing that, a local session (driver and executors in one process) gets a temp folder of
    its own, and any other master is refused, since its executors would not share that folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    set_dir = context._jsc.sc().getCheckpointDir()
    if not root and set_dir.isDefined():
        root = set_dir.get()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="trendlake-ckpt-")
    if not set_dir.isDefined():
        context.setCheckpointDir(root)
    leaf = f"{name or 'scratch'}-{uuid.uuid4().hex[:12]}"
    return root.rstrip("/") + "/" + leaf if "://" in root else os.path.join(root, leaf)
