"""Incremental refresh: raw deliveries to curated readings, facts, dimensions, health and trips.

Late and repeated deliveries may change any past reading.  All tables lie in folders by date and
shard (a hash of the vehicle), by shard, or by date, and an increment rewrites exactly the folders
that it touches, in this order:

    deliveries        by batch and date: appended, for retention
    readings          by date and shard: the newest delivery of each reading
    daily, parts, runs  by date and shard: a vehicle day's facts, mergeable aggregates and trip runs
    vehicles, spans   by shard: all days of a vehicle merged, and its trips
    fleet             by date: all vehicles of a customer's day merged

So reads rank nothing and merge no history: a vehicle's status is one row of one folder.  The result
equals a full rebuild, whatever the order of the increments; rows without a vehicle or an event time
are keys like others.  See ``FolderTables`` for interrupted increments.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlark.functions import rules
from roadlark.operators import facts, retention, trips
from roadlark.operators.curated import latest_readings
from roadlark.streaming.folders import FolderTables, in_parallel
from roadlark.streaming.log import write_batch

SHARDS = 16
_CELL = ["event_date", "shard"]


def shard(vehicle: Column, shards: int) -> Column:
    return F.pmod(F.hash(vehicle), F.lit(shards))


class IncrementalTables(FolderTables):
    """``shards`` folders per date: about as many as a date's readings have gigabytes."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        bucket_seconds: int = trips.BUCKET_SECONDS,
        healthy: Collection[str] = rules.HEALTHY_CAN,
        shards: int = SHARDS,
    ):
        if 86400 % bucket_seconds:
            raise ValueError("a day must be a whole number of buckets")
        layout = {
            "deliveries": ["batch_id", "event_date"],
            **dict.fromkeys(("readings", "daily", "parts", "runs"), _CELL),
            "vehicles": ["shard"],
            "spans": ["shard"],
            "fleet": ["event_date"],
        }
        super().__init__(spark, root, layout)
        self.bucket_seconds = bucket_seconds
        self.healthy = healthy
        self.shards = shards

    # writing ---------------------------------------------------------------------------------

    def _placed(self, rows: DataFrame, date: Column) -> DataFrame:
        return rows.withColumns({"event_date": date, "shard": shard(F.col("vehicle_id"), self.shards)})

    def _add(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Write the increment's deliveries into its own folder; returns them as read back."""
        dated = batch.withColumn("event_date", F.to_date("event_ts"))
        write_batch(dated, f"{self.root}/deliveries", batch_id, ["event_date"])
        added = self.read("deliveries").where(F.col("batch_id") == batch_id).drop("batch_id")
        return self._placed(added, F.col("event_date"))

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Add one increment.  Repeating an increment under the same id changes nothing."""
        self.recover()
        rows = self._add(batch, batch_id)
        self.touch(rows, _CELL)
        if self.exists("readings"):
            rows = self.pruned("readings", _CELL).unionByName(rows, allowMissingColumns=True)
        self._change(latest_readings(rows))

    def load(self, rows: DataFrame, batch_id: int = 0) -> None:
        """First increment: there is nothing to merge it with."""
        self.apply(rows, batch_id)

    def _change(self, readings: DataFrame) -> None:
        """Replace the touched folders' readings, and all that follows from them."""
        self.stage("readings", readings)
        self._follow()
        self.ready()
        self.finish()

    def _follow(self) -> None:
        new = self.staged("readings")
        start = F.timestamp_seconds(F.col("bucket") * self.bucket_seconds)
        derived = {
            "daily": (facts.fact_vehicle_daily(new), F.to_date("metric_date")),
            "parts": (facts.day_parts(new, self.healthy), F.to_date("metric_date")),
            "runs": (trips.trip_runs(new, self.bucket_seconds), F.to_date(start)),
        }
        steps = [lambda n=n, r=r, d=d: self.stage(n, self._placed(r, d)) for n, (r, d) in derived.items()]
        in_parallel(self.spark, steps)
        for c in _CELL:
            self.narrow(_CELL, [c])

        def vehicles() -> None:
            parts = self.merged("parts", ["shard"])
            whole = facts.merged_parts(parts, "customer_id", "vehicle_id", "device_id")
            self.stage("vehicles", whole.withColumn("shard", shard(F.col("vehicle_id"), self.shards)))

        def spans() -> None:
            whole = trips.spans_of_runs(self.merged("runs", ["shard"]).drop(*_CELL))
            self.stage("spans", whole.withColumn("shard", shard(F.col("vehicle_id"), self.shards)))

        def fleet() -> None:
            whole = facts.fleet_from_parts(self.merged("parts", ["event_date"]))
            self.stage("fleet", whole.withColumn("event_date", F.to_date("metric_date")))

        in_parallel(self.spark, [vehicles, spans, fleet])

    def retain(self, policies: DataFrame, as_of: Column | str) -> int:
        """Delete deliveries beyond their customer's retention; returns how many.

        Folders that hold such deliveries are rewritten without them, and all that follows from
        those folders; nothing of a deleted delivery stays below the root.  An interrupted run is
        finished by the next call of any change: then this returns what it deletes beyond that.
        """
        self.recover()
        if not self.exists("deliveries"):
            return 0
        stored = self.read("deliveries")
        in_use = f"{self.root}/_stage/_policies"
        retention.policies_in_use(stored, policies).write.mode("overwrite").parquet(in_use)
        policies = self.spark.read.parquet(in_use)
        gone = retention.expired(stored, policies, as_of)
        counted = self._placed(gone, F.col("event_date")).groupBy("batch_id", *_CELL).count()
        counted.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_stage/_gone")
        hit = self.spark.read.parquet(f"{self.root}/_stage/_gone")
        total = hit.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        if not total:
            self._forget()
            return 0
        folders = self.layout["deliveries"]
        for columns in (folders, _CELL, ["event_date"]):
            self.touch(hit, columns)
        self.stage("deliveries", retention.retained(self.pruned("deliveries", folders), policies, as_of))
        # The touched readings come from all batches of their dates: rewritten folders and others.
        other = self.within(self.pruned("deliveries", ["event_date"]), folders, inside=False)
        rows = self._placed(other.unionByName(self.staged("deliveries")), F.col("event_date")).drop("batch_id")
        self._change(latest_readings(self.within(rows, _CELL)))
        return total

    # reading ---------------------------------------------------------------------------------

    def readings(self) -> DataFrame:
        return self.read("readings").drop(*_CELL)

    def fact_vehicle_daily(self) -> DataFrame:
        return self.read("daily").drop(*_CELL)

    def fact_customer_fleet(self) -> DataFrame:
        return self.read("fleet").drop("event_date")

    def dim_vehicle(self, policies: DataFrame) -> DataFrame:
        return facts.vehicles_from_parts(self.read("vehicles"), policies)

    def dim_customer(self, policies: DataFrame, as_of: Column | str) -> DataFrame:
        return facts.customers_from_parts(self.read("vehicles"), policies, as_of)

    def fleet_health(self, as_of: Column | str) -> DataFrame:
        return facts.health_from_parts(self.read("vehicles"), as_of)

    def fleet_status(self, vehicle_id: str | None = None) -> DataFrame:
        """Newest state of all vehicles, or of one, which is looked up in its shard's folder."""
        rows = self.read("vehicles")
        if vehicle_id is not None:
            here = F.col("shard") == shard(F.lit(vehicle_id), self.shards)
            rows = rows.where(here & (F.col("vehicle_id") == vehicle_id))
        return facts.status_from_parts(rows)

    def trip_summaries(self, fences: DataFrame) -> DataFrame:
        return trips.trips_from_spans(self.read("spans").drop("shard"), fences)
