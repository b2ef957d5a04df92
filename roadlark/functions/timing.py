"""Time helpers on TIMESTAMP_NTZ columns.

Differences count unit *boundaries*, so they are differences of floored epoch values; Spark's
``timestampdiff`` counts whole elapsed units and would be off by one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def minutes_between(start: Column, end: Column) -> Column:
    def minute(ts: Column) -> Column:
        return F.floor(epoch_seconds(ts) / 60)

    return minute(end) - minute(start)


def day_start(ts: Column) -> Column:
    return F.date_trunc("DAY", ts).cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.date_trunc("MONTH", ts).cast("timestamp_ntz")


def as_ntz(ts: Column | str) -> Column:
    """A TIMESTAMP_NTZ value from an ISO string or a column."""
    return (F.lit(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def days_before(ts: Column, days: Column | int) -> Column:
    days = F.lit(days) if isinstance(days, int) else days
    return ts - F.make_dt_interval(days.cast("int"))
