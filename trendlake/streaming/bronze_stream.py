"""Bronze -> Silver as a Structured Streaming job over the landing folder.

The batch job re-reads all of Bronze every run. This job reads each landed file once:
a file stream source (explicit schema, partition columns from the directory names)
with ``trigger(availableNow=True)`` processes whatever arrived since the last run and
stops, and its checkpoint remembers which files were done (exactly-once across runs and
restarts; a lost executor just re-runs its tasks).

Each micro-batch:
1. flattens and cleans the new documents;
2. finds the (region, trending_date) partitions it touches (bounded by regions x days in
   the batch) and reads the existing Silver rows of exactly those partitions
   (partition-pruned);
3. deduplicates new and existing rows together (a snapshot that arrives later in the day
   still competes with the one already in Silver);
4. writes the result to the shared scratch folder (the write replaces files it was read
   from) and from there with
   dynamic partition overwrite, so replaying an epoch leaves the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendlake.operators import flatten
from trendlake.plans.silver import merge_silver
from trendlake.schemas import BRONZE_STATS, STATS_PARTITIONS
from trendlake.session import prepare_session, scratch_dir
from trendlake.sources.bronze import _with_partitions

def start_bronze_stream(
    spark: SparkSession,
    bronze_root: str,
    silver_path: str,
    checkpoint_location: str | None = None,
    regions: Sequence[str] | None = None,
    multi_line: bool = False,
    run_ts: dt.datetime | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream with ``availableNow`` (process the backlog, then stop)."""
    prepare_session(spark)
    schema = _with_partitions(BRONZE_STATS, STATS_PARTITIONS)
    reader = (
        spark.readStream.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.json(bronze_root)
    if regions:
        docs = docs.where(F.col("region").isin(list(regions)))

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        merge_silver(batch.sparkSession, flatten.flatten_statistics(batch), silver_path, ts, "bronze_to_silver_stream")

    return (
        docs.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint_location or scratch_dir(spark, "bronze-stream"))
        .trigger(availableNow=True)
        .start()
    )
