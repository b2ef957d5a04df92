"""All tables of the telemetry model as lazily declared DataFrames."""

from __future__ import annotations

from collections.abc import Collection
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from roadlark.functions import rules
from roadlark.operators import curated, facts, reports, spatial, trips
from roadlark.sources.files import write_clustered


class FleetModel:
    """Raw deliveries and reference data in, curated and business tables out.

    Nothing runs until a table is used.  ``saved`` writes the readings and the costly business
    tables once, and returns a model that reads them; on a large cluster queries should run on
    such a model, so that deduplication and trip building are paid for once.
    """

    def __init__(
        self,
        raw: DataFrame,
        fences: DataFrame,
        policies: DataFrame,
        segments: DataFrame,
        as_of: str,
        healthy: Collection[str] = rules.HEALTHY_CAN,
    ):
        self.raw = raw
        self.fences = fences
        self.policies = policies
        self.segments = segments
        self.as_of = as_of
        self.healthy = healthy

    # curated -----------------------------------------------------------------------------

    @cached_property
    def readings(self) -> DataFrame:
        return curated.latest_readings(self.raw)

    def view(self, signal: str) -> DataFrame:
        """Signal columns and late flag of every delivery."""
        return curated.signal_view(self.raw, signal)

    def signal(self, signal: str) -> DataFrame:
        """Signal columns and late flag of the newest delivery of every reading."""
        return curated.signal_view(self.readings, signal)

    # business ------------------------------------------------------------------------------

    @cached_property
    def vehicle_daily(self) -> DataFrame:
        return facts.fact_vehicle_daily(self.readings)

    @cached_property
    def fleet_daily(self) -> DataFrame:
        return facts.fact_customer_fleet(self.readings)

    @cached_property
    def vehicles(self) -> DataFrame:
        return facts.dim_vehicle(self.readings, self.policies)

    @cached_property
    def customers(self) -> DataFrame:
        return facts.dim_customer(self.readings, self.policies, self.as_of)

    @cached_property
    def health(self) -> DataFrame:
        return facts.fleet_health(self.readings, self.as_of, self.healthy)

    @cached_property
    def trips(self) -> DataFrame:
        return trips.trip_summaries(self.readings, self.fences)

    @cached_property
    def status(self) -> DataFrame:
        return facts.realtime_fleet_status(self.readings, self.healthy)

    @cached_property
    def vehicle_360(self) -> DataFrame:
        return facts.vehicle_360(self.vehicles, self.vehicle_daily)

    @cached_property
    def customer_360(self) -> DataFrame:
        return facts.customer_360(self.customers, self.fleet_daily)

    @cached_property
    def segment_efficiency(self) -> DataFrame:
        return spatial.monthly_segment_efficiency(self.readings, self.segments)

    @cached_property
    def scorecard(self) -> DataFrame:
        return reports.driver_scorecard(self.trips, self.health)

    @cached_property
    def alerts(self) -> DataFrame:
        return reports.speed_alert_report(self.trips)

    # materialisation -----------------------------------------------------------------------

    SAVED = ("vehicle_daily", "fleet_daily", "vehicles", "customers", "health", "trips", "status")

    def saved(self, spark: SparkSession, root: str) -> FleetModel:
        write_clustered(self.readings, f"{root}/readings")
        copy = FleetModel(self.raw, self.fences, self.policies, self.segments, self.as_of, self.healthy)
        copy.readings = spark.read.parquet(f"{root}/readings")
        for name in self.SAVED:
            getattr(copy, name).write.mode("overwrite").parquet(f"{root}/{name}")
        for name in self.SAVED:
            setattr(copy, name, spark.read.parquet(f"{root}/{name}"))
        return copy
