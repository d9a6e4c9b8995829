"""Helpers shared by the training-data operators.

Every operator takes whole tables, reads only the columns it names and returns frames of its
own columns, so extra input columns never clash with working ones. A document row is identified
by ``doc_id`` and the hash of its text (``TEXT_HASH``): repeated rows then share one decision,
and rows that share only an id keep their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.session import scratch_dir

TEXT_HASH = "__text_hash"

# The ASCII letters, which alone are lower-cased.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Tables of at most this many rows may be broadcast by hint; larger ones are left to Spark.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    This cuts the lineage: after an executor is lost, later stages reread the files.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_hash(column: str = "text") -> Column:
    return F.xxhash64(whole_text(column))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` would touch other letters too, so it serves pure ASCII."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows, by a count."""
    return df.count() <= rows


def hash_set(hashes: DataFrame, bits: int) -> Column:
    """The hashes in column h as an array literal, a set of ``bits`` bits (a power of two).

    What reaches the driver and every task is of this fixed size, however many hashes there
    are; a full set only lets more through to the join that must follow.
    """
    slots = bits // 64
    slot = F.shiftright("h", 6).bitwiseAND(F.lit(slots - 1))
    found = {
        r["slot"]: r["set"]
        for r in hashes.groupBy(slot.alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("set")).collect()
    }
    return F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(slots))), ",").cast("array<bigint>")


def may_be_in(hash_: Column, set_: Column, bits: int) -> Column:
    """Whether ``hash_`` can be in the set; true for all that are."""
    word = set_[F.shiftright(hash_, 6).bitwiseAND(F.lit(bits // 64 - 1)).cast("int")]
    return F.call_function("shiftright", word, hash_.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def same_row(left: str, right: str) -> Column:
    """Join condition: the same document row in two aliased frames."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (
        F.col(f"{left}.{TEXT_HASH}") == F.col(f"{right}.{TEXT_HASH}")
    )


def keep_rows(docs: DataFrame, decided: DataFrame, how: str) -> DataFrame:
    """``docs`` with (``left_semi``) or without (``left_anti``) the rows that ``decided`` names."""
    left = docs.withColumn(TEXT_HASH, text_hash()).alias("d")
    right = decided.select("doc_id", TEXT_HASH).alias("k")
    return left.join(right, same_row("d", "k"), how).select(*[F.col(f"d.`{c}`") for c in docs.columns])
