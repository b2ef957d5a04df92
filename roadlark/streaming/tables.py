"""Continuously maintained tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlark import schema
from roadlark.functions.rules import LATE_AFTER_SECONDS, arrived_late
from roadlark.operators.curated import latest_readings
from roadlark.plans.refresh import IncrementalTables, shard
from roadlark.streaming.folders import FolderTables
from roadlark.streaming.ingest import FILES_PER_BATCH
from roadlark.streaming.log import write_batch

AVAILABLE_NOW = {"availableNow": True}


def landing_stream(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    return spark.readStream.schema(schema.LANDING).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _start(rows: DataFrame, save, checkpoint: str, mode: str, trigger: dict | None) -> StreamingQuery:
    writer = rows.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


class LatestReadings(FolderTables):
    """Keep-latest table: a batch is merged into the folders (date and shard of the vehicle) that hold
    its keys, and only those are rewritten.  No reading is ever too late to win, and reads rank nothing."""

    def __init__(self, spark: SparkSession, root: str, shards: int):
        super().__init__(spark, root, {"readings": ["event_date", "shard"]})
        self.shards = shards

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        self.recover()
        placed = {"event_date": F.to_date("event_ts"), "shard": shard(F.col("vehicle_id"), self.shards)}
        rows = latest_readings(batch).withColumns(placed)
        self.touch(rows, self.layout["readings"])
        if self.exists("readings"):
            rows = self.pruned("readings", self.layout["readings"]).unionByName(rows, allowMissingColumns=True)
        self.stage("readings", latest_readings(rows))
        self.ready()
        self.finish()

    def readings(self) -> DataFrame:
        return self.read("readings").drop("event_date", "shard")


def start_dedup(rows: DataFrame, kept: LatestReadings, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return _start(rows, kept.apply, checkpoint, "append", trigger)


def start_refresh(rows: DataFrame, tables: IncrementalTables, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Readings, daily facts and trip runs, kept equal to a full rebuild."""
    return _start(rows, tables.apply, checkpoint, "append", trigger)


def newest_state(rows: DataFrame) -> DataFrame:
    """Latest known state per vehicle; a plain aggregate that also runs incrementally."""
    state = ["event_ts", "customer_id", "gps_latitude", "gps_longitude", "tel_ignition_status", "tel_can_bus_health"]
    newest = F.max_by(F.struct(*state), F.struct("event_ts", "ingest_ts")).alias("s")
    return (
        rows.where("event_ts IS NOT NULL")
        .groupBy("vehicle_id")
        .agg(newest)
        .select(
            "vehicle_id",
            F.col("s.customer_id").alias("customer_id"),
            F.col("s.event_ts").alias("last_event_ts"),
            F.col("s.gps_latitude").alias("latest_lat"),
            F.col("s.gps_longitude").alias("latest_lon"),
            F.col("s.tel_ignition_status").alias("ignition_status"),
            F.col("s.tel_can_bus_health").alias("can_bus_health"),
        )
    )


def late_by_day(rows: DataFrame, late_after: int = LATE_AFTER_SECONDS) -> DataFrame:
    """Deliveries per day and late flag.  The state is a few rows per day, so it needs no watermark
    and late deliveries keep counting."""
    day = F.window(F.col("event_ts").cast("timestamp"), "1 day")
    late = arrived_late(F.col("event_ts"), F.col("ingest_ts"), late_after)
    return (
        rows.groupBy(day.alias("day"), late.alias("arrived_late"))
        .agg(F.count("*").alias("event_count"))
        .select(F.col("day.start").cast("timestamp_ntz").alias("metric_date"), "arrived_late", "event_count")
    )


def start_update(aggregate: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write the changed rows of a streaming aggregate; ``newest_version`` reads the table."""
    return _start(aggregate, lambda batch, i: write_batch(batch, path, i), checkpoint, "update", trigger)
