"""Interval join: events of a key that fall between an interval's start and end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlark.functions.timing import epoch_seconds

# Cells of 1, 8, 64 ... seconds: each level's cells are eight of the level below.
FACTOR = 8
LEVELS = 14
_WIDTHS = [FACTOR**n for n in range(LEVELS)]


def level_of(seconds: Column) -> Column:
    """The finest level whose cells are longer than an interval: it then touches two at most."""
    return sum((seconds >= width).cast("int") for width in _WIDTHS[:-1])


def cell_at(seconds: Column, level: Column) -> Column:
    return F.floor(seconds / F.get(F.lit(_WIDTHS), level))


def interval_cells(intervals: DataFrame, start_ts: str, end_ts: str) -> DataFrame:
    """One row per interval and cell that it touches; empty intervals are left out."""
    start, end = epoch_seconds(F.col(start_ts)), epoch_seconds(F.col(end_ts))
    rows = intervals.where(F.col(start_ts) <= F.col(end_ts)).withColumn("_level", level_of(end - start))
    first, last = cell_at(start, F.col("_level")), cell_at(end, F.col("_level"))
    return rows.withColumn("_cell", F.explode(F.sequence(first, last)))


def interval_join(
    events: DataFrame, intervals: DataFrame, key: str, event_ts: str, start_ts: str, end_ts: str
) -> DataFrame:
    """Inner join on ``key`` and ``event_ts BETWEEN start_ts AND end_ts``.

    Joining on the key alone compares every event of a key with every interval of it.  Here time is
    a hierarchy of cells; an interval is listed at the level of its own length, in two cells at most,
    and an event looks into the cells around it, one for each level that some interval has (a
    subquery over the intervals tells which, when the join runs).  The join is on (key, level,
    cell): intervals of minutes and of years meet few events in vain, and a key that owns most
    events is spread over its cells.
    """
    pieces = interval_cells(intervals, start_ts, end_ts)
    used = pieces.select(F.sort_array(F.collect_set("_level"))).scalar()
    seconds = epoch_seconds(F.col(event_ts))
    known = events.where(F.col(event_ts).isNotNull()).withColumn("_used", used)
    located = known.select("*", F.explode("_used").alias("_level")).drop("_used")
    located = located.withColumn("_cell", cell_at(seconds, F.col("_level")))
    same = [c for c in intervals.columns if c in events.columns and c != key]
    joined = located.drop(*same).join(pieces, [key, "_level", "_cell"])
    return joined.where(F.col(event_ts).between(F.col(start_ts), F.col(end_ts))).drop("_level", "_cell")
