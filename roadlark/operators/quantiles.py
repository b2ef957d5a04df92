"""Exact quantiles per group without sorting or holding a whole group."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOX_PLOT = {"min_value": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max_value": 1.0}
ACCURACY = 10_000  # a sketch's rank is off by one in so many rows at most
MARGIN = 4 / ACCURACY
SMALL = 50_000  # rows of a group whose values are ordered as they are


def exact_quantiles(df: DataFrame, group: str, value: str, points: Mapping[str, float] = BOX_PLOT) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per ``group``, to four digits.

    A mergeable sketch per group gives bounds that hold each wanted rank for certain; rows below a
    bound are only counted, and no more than the values between the two bounds, about one in
    thousand, are put in order.  Counts of equal values come first, and every step is combined
    before its shuffle, so a group that owns all rows is spread over all tasks.
    """
    known = df.where(F.col(value).isNotNull()).select(F.struct(F.col(group).alias("key")).alias("g"), F.col(value).cast("double").alias("v"))
    names, shares = list(points), [float(p) for p in points.values()]
    low = [max(p - MARGIN, 0.0) for p in shares]
    high = [min(p + MARGIN, 1.0) for p in shares]
    sketches = known.groupBy("g").agg(
        F.count("*").alias("total"),
        F.min("v").alias("least"),
        F.max("v").alias("most"),
        F.percentile_approx("v", low, ACCURACY).alias("low"),
        F.percentile_approx("v", high, ACCURACY).alias("high"),
    )

    def bound(n: int, side: str, end: str, open_end: bool) -> Column:
        return F.when((F.col("total") <= SMALL) | F.lit(open_end), F.col(end)).otherwise(F.col(side)[n])

    bounds = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(p).alias("share"),
            bound(n, "low", "least", low[n] == 0).alias("low"),
            bound(n, "high", "most", high[n] == 1).alias("high"),
        )
        for n, (name, p) in enumerate(zip(names, shares, strict=True))
    ]
    wanted = sketches.select("g", "total", F.array(*bounds).alias("wanted"))
    counts = known.groupBy("g", "v").agg(F.count("*").alias("n"))
    # One row per wanted point that a value can still decide, and per group's task one for all that it cannot.
    asked = counts.join(wanted, "g").select("g", "total", "v", "n", F.inline("wanted"))
    asked = asked.where("v <= high")
    parts = asked.groupBy("g", "total", "name", "share", F.when(F.col("v") >= F.col("low"), F.col("v")).alias("v"))
    parts = parts.agg(F.sum("n").alias("n"))
    # Null, which stands for all values below the lower bound, comes first.
    order = Window.partitionBy("g", "name").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = parts.withColumn("upto", F.sum("n").over(order))
    position = (F.col("total") - 1) * F.col("share")

    def at(rank: Column) -> Column:
        """Value at a zero-based rank."""
        return F.min(F.when(F.col("upto") > rank, F.col("v")))

    rest = position - F.floor(position)
    picked = ranked.groupBy("g", "name").agg(
        F.max("total").alias("n"), at(F.floor(position)).alias("below"), at(F.ceil(position)).alias("above"), F.max(rest).alias("rest")
    )
    between = F.round(F.col("below") + (F.col("above") - F.col("below")) * F.col("rest"), 4)
    row = picked.groupBy("g").agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("name") == name, between)).alias(name) for name in names]
    )
    return row.select(F.col("g.key").alias(group), "n", *names)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts per equal-width bin between the smallest and largest value.

    The bounds are a scalar subquery, evaluated once and handed to every task as two numbers.
    """
    known = df.select(value).where(F.col(value).isNotNull())
    bounds = known.select(F.array(F.min(value), F.max(value))).scalar()
    low, high = bounds[0], bounds[1]
    share = F.try_divide((F.col(value) - low) * bins, high - low)
    bin_no = F.least(F.floor(F.coalesce(share, F.lit(0.0))) + 1, F.lit(bins).cast("bigint"))
    return known.groupBy(bin_no.alias("bin")).agg(
        F.count("*").alias("n"), F.min(value).alias("min_value"), F.max(value).alias("max_value")
    )
