"""Row numbers within groups, including groups too large for one task.

``row_number() OVER (PARTITION BY g ORDER BY k)`` sends a whole group to one task. That
is fine when a group is bounded (categories per day), but channels per (region, day) grow
with the data, at any size. ``distributed_row_number`` computes the same numbers with a global sort:

1. ``orderBy(g..., k...)`` range-partitions on the *full* composite key, so one hot group
   is spread over many partitions (the sampler sees its rows like any others);
2. each row gets its partition id and a per-partition consecutive id, and the result is
   written to the shared scratch folder (stable ids, lineage cut, survives executor loss);
3. a tiny table of (group, partition) -> row count and first id gives each partition's
   offset inside its group (running sum over partitions);
4. row_number = offset + (id - first id in partition) + 1, joined back (a table of at most
   #partitions + #groups rows, written first, so that Spark decides by its real size how).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.sinks.writers import write_scratch


def distributed_row_number(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column],
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact ``row_number`` per group without putting a group in one task.

    ``order_cols`` must be a total order within a group (ties give arbitrary numbers,
    exactly like a window ``row_number``).
    """
    keys = [F.col(c).asc_nulls_first() for c in group_cols] + list(order_cols)
    ordered = df.repartitionByRange(num_partitions, *keys) if num_partitions else df
    ordered = ordered.orderBy(*keys) if not num_partitions else ordered.sortWithinPartitions(*keys)
    tagged = ordered.withColumns({
        "_rn_pid": F.spark_partition_id(),
        "_rn_mid": F.monotonically_increasing_id(),
    })
    tagged = write_scratch(tagged, "ranked")

    before = Window.partitionBy(*group_cols).orderBy("_rn_pid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    spans = (
        tagged.groupBy(*group_cols, "_rn_pid")
        .agg(F.count(F.lit(1)).alias("_rn_n"), F.min("_rn_mid").alias("_rn_m0"))
        .withColumn("_rn_off", F.coalesce(F.sum("_rn_n").over(before), F.lit(0)))
        .drop("_rn_n")
    )
    t, s = tagged.alias("_t"), write_scratch(spans, "spans").alias("_s")
    cond = [F.col(f"_t.{c}").eqNullSafe(F.col(f"_s.{c}")) for c in group_cols]
    cond.append(F.col("_t._rn_pid") == F.col("_s._rn_pid"))
    joined = t.join(s, on=cond, how="inner").select(
        "_t.*", F.col("_s._rn_off"), F.col("_s._rn_m0")
    )
    rn = (F.col("_rn_off") + (F.col("_rn_mid") - F.col("_rn_m0")) + 1).cast("int")
    return joined.withColumn(out_col, rn).drop("_rn_pid", "_rn_mid", "_rn_m0", "_rn_off")
