"""Union by name over schema versions, also inside nested structs and arrays of structs.

``unionByName(allowMissingColumns=True)`` fills fields that are missing in structs, but neither
in structs within arrays nor where a type was widened. ``conform`` gives a frame the columns of a
target schema: missing fields are null, further ones go, and others are cast, at any depth.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.sinks.writers import path_exists

# Widths of numbers that the next of them holds.
WIDER = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def _conformed(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        held = {f.name: f.dataType for f in have.fields}
        fields = [
            (_conformed(value.getField(f.name), held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: _conformed(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(value, lambda _, x: _conformed(x, have.valueType, want.valueType))
    return value.try_cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the fields of ``schema``, by name, at every depth."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (_conformed(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields
    ])


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, _wider(a.valueType, b.valueType))
    if a in WIDER and b in WIDER:
        return WIDER[max(WIDER.index(a), WIDER.index(b))]
    numbers = (*WIDER, T.FloatType(), T.DoubleType())
    return T.DoubleType() if a in numbers and b in numbers else T.StringType()


def merged(schemas: Sequence[T.StructType]) -> T.StructType:
    """All fields of the schemas, in order of first appearance; of two types the wider, text where nothing else holds both."""
    fields: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            fields[f.name] = _wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def union_evolved(frames: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """The rows of all frames under ``schema``, or under all their fields."""
    schema = schema or merged([f.schema for f in frames])
    return reduce(DataFrame.union, [conform(f, schema) for f in frames])


def read_versions(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet documents under ``root/version=*``, whose files differ in schema from version to version only."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/version=*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = sorted(str(s.getPath()) for s in fs.globStatus(pattern) or []) if path_exists(spark, root) else []
    if not folders:
        return spark.createDataFrame([], schema or T.StructType([]))
    return union_evolved([spark.read.parquet(f) for f in folders], schema)
