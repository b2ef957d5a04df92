"""Raw deliveries to curated readings: late flag, signal split, keep-latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlark import schema
from roadlark.functions.rules import LATE_AFTER_SECONDS, arrived_late

READING_KEY = ["vehicle_id", "event_ts"]


def latest_first() -> list[Column]:
    """NULL ingest time sorts as the largest value; the log offset settles exact ties."""
    return [F.col("ingest_ts").desc_nulls_first(), F.col("record_metadata.offset").desc_nulls_last()]


def latest_readings(raw: DataFrame) -> DataFrame:
    """One row per (vehicle, event time): the delivery that was ingested last.

    ``row_number() = 1`` lets Spark cut every map task's output to one row per key before the
    shuffle, so a reading that was redelivered millions of times costs one row per task.
    """
    newest = Window.partitionBy(*READING_KEY).orderBy(*latest_first())
    return raw.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def signal_view(rows: DataFrame, signal: str, late_after: int = LATE_AFTER_SECONDS) -> DataFrame:
    """Keys, the columns of one signal group and the late flag.

    Late rows are flagged, never dropped, hence no watermark here: it works on streams too.
    """
    late = arrived_late(F.col("event_ts"), F.col("ingest_ts"), late_after)
    return rows.select(*schema.SIGNAL_KEYS, *schema.SIGNALS[signal], late.alias("arrived_late"))


def curated_signal(raw: DataFrame, signal: str, late_after: int = LATE_AFTER_SECONDS) -> DataFrame:
    return signal_view(latest_readings(raw), signal, late_after)


def align_signals(left: DataFrame, right: DataFrame, keys: Sequence[str] = READING_KEY) -> DataFrame:
    """Point-in-time join of two curated signal tables on vehicle and event time.

    Both sides come out of ``latest_readings`` partitioned on the same two keys, so the join
    adds no shuffle.
    """
    repeated = [c for c in right.columns if c in left.columns and c not in keys]
    return left.join(right.drop(*repeated), list(keys))
