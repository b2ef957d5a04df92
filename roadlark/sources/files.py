"""File listings and the clustered table layout."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, pattern: str = "*.jpg", depth_from: str | None = None) -> DataFrame:
    """Name, size and change time of matching files.  File contents are never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    base = (depth_from or path).rstrip("/") + "/"
    return files.load(path).select(
        F.regexp_replace("path", "^(file:)?/*" + base.lstrip("/"), "").alias("relative_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def write_clustered(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by event date, each file sorted by vehicle and event time.

    Range partitioning on (date, vehicle, time) gives every task an equal share of rows even when
    one vehicle or one day holds most of them.  A filter on the date prunes folders, a filter on
    the vehicle skips files and row groups by their min/max values.
    """
    dated = rows.withColumn("event_date", F.to_date("event_ts"))
    (
        dated.repartitionByRange("event_date", "vehicle_id", "event_ts")
        .sortWithinPartitions("event_date", "vehicle_id", "event_ts")
        .write.mode(mode)
        .partitionBy("event_date")
        .parquet(path)
    )


CURVE_BITS = 7


def along_curve(rows: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``rows`` with ``_place``, their place on a Z-order curve through several columns.

    Each column is cut into ``2**CURVE_BITS`` ranges of about equally many rows, at quantiles that a
    mergeable sketch gives (a subquery, when the plan runs); the range numbers' bits are interleaved.
    Missing values stand first.
    """
    steps = 1 << CURVE_BITS
    shares = [n / steps for n in range(1, steps)]
    values = rows.select(*[c.cast("double").alias(n) for n, c in columns.items()])
    cuts = {f"_cuts_{n}": values.select(F.percentile_approx(n, shares, steps * 100)).scalar() for n in columns}

    def number(name: str, column: Column) -> Column:
        value = F.coalesce(column.cast("double"), F.lit(float("-inf")))
        return F.size(F.filter(F.coalesce(f"_cuts_{name}", F.array().cast("array<double>")), lambda c: c < value))

    numbers = {f"_no_{n}": number(n, c) for n, c in columns.items()}
    place = F.lit(0).cast("long")
    for k, name in enumerate(columns):
        for bit in range(CURVE_BITS):
            one = F.shiftright(f"_no_{name}", bit).bitwiseAND(F.lit(1)).cast("long")
            place = place + F.shiftleft(one, bit * len(columns) + k)
    return rows.withColumns(cuts).withColumns(numbers).withColumn("_place", place).drop(*cuts, *numbers)


def write_curved(rows: DataFrame, path: str, columns: Mapping[str, Column], files: int) -> None:
    """Parquet in ``files`` files along a Z-order curve: a box over any of the columns (vehicle, time
    and place, say) meets few files, which their min/max values tell."""
    ordered = along_curve(rows, columns).repartitionByRange(files, "_place").sortWithinPartitions("_place")
    ordered.drop("_place").write.mode("overwrite").parquet(path)


# ---- small files beside a table's data, such as its schema --------------------------------------


def path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def system(spark: SparkSession, name: str):
    return path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """Write a small text file whole, over an old one."""
    stream = system(spark, name).create(path(spark, name), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, name: str) -> str:
    stream = system(spark, name).open(path(spark, name))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
