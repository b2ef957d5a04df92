"""Output of micro-batches: one folder per batch, newest version per key at read time.

A batch overwrites its own folder, so a batch repeated after a failure leaves the same files.
A small file beside the folders holds the schema of all batches together, so that a read opens no
file for it.  Batches may differ: a field that any of them has is a column, NULL where a batch lacks
it, and a field that was a whole number or a float first and a wider one later has the wider type.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlark.sources import files

# Types that can be read as a wider one without a loss.
_WIDER = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("tinyint", "double"),
    ("smallint", "int"), ("smallint", "bigint"), ("smallint", "double"),
    ("int", "bigint"), ("int", "double"), ("float", "double"),
}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds all values of both."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widened(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    names = a.simpleString(), b.simpleString()
    if names in _WIDER:
        return b
    if names[::-1] in _WIDER or names[1] == "void":
        return a
    if names[0] == "void":
        return b
    raise ValueError(f"a field cannot be both {names[0]} and {names[1]}")


def widened(known: T.StructType, new: T.StructType, last: Sequence[str] = ()) -> T.StructType:
    """Fields of both schemas; those named in ``last`` stand at the end."""
    fields = {f.name: f.dataType for f in known}
    for f in new:
        fields[f.name] = wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
    names = [n for n in fields if n not in last] + [n for n in last if n in fields]
    return T.StructType([T.StructField(n, fields[n]) for n in names])


def _schema_file(path: str) -> str:
    return f"{path}/_schema"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of all batches below a path; None if none was written by ``write_batch``."""
    name = _schema_file(path)
    if "*" in path or not files.system(spark, name).exists(files.path(spark, name)):
        return None
    return T.StructType.fromJson(json.loads(files.read_text(spark, name)))


def write_batch(rows: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """With partition columns, AQE first gathers each partition's rows into few tasks (and splits
    a partition that is too big for one), so a batch does not leave one file per task and folder."""
    spark, last = rows.sparkSession, ["batch_id", *partition_by]
    known = stored_schema(spark, path)
    own = rows.withColumn("batch_id", F.lit(0)).schema
    schema = widened(known, own, last) if known else widened(T.StructType([]), own, last)
    if schema != known:
        files.write_text(spark, _schema_file(path), schema.json())
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All batches of a log, with their stored schema or a given one.  Folders that others wrote
    have none: their files are asked."""
    if schema is None:
        schema = stored_schema(spark, path)
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    if "batch_id" not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def newest_version(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    by_batch = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return log.withColumn("_age", F.rank().over(by_batch)).where("_age = 1").drop("_age", "batch_id")
