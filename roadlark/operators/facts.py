"""Daily vehicle and fleet facts, dimensions, health and 360 views.

``readings`` is the output of ``latest_readings``: one row per vehicle and event time carrying
all signal groups.  The signal tables are projections of it, so one pass over one shuffle feeds
every aggregate and nothing has to be joined back on (vehicle, event time).
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlark.functions import rules
from roadlark.functions.timing import as_ntz, day_start, days_before, minutes_between


def _avg(column: str, digits: int) -> Column:
    return F.round(F.avg(column), digits)


def _max(column: str, digits: int) -> Column:
    return F.round(F.max(column), digits)


def _grown(column: str) -> Column:
    """Growth of a counter over the group.  Counter resets are not detected."""
    return F.round(F.max(column) - F.min(column), 2)


def _count_when(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def fact_vehicle_daily(readings: DataFrame) -> DataFrame:
    return readings.groupBy(
        "customer_id", "vehicle_id", day_start(F.col("event_ts")).alias("metric_date")
    ).agg(
        F.count("*").alias("total_readings"),
        _avg("j1939_vehicle_speed_kph", 1).alias("avg_speed_kph"),
        _max("j1939_vehicle_speed_kph", 1).alias("max_speed_kph"),
        _avg("j1939_engine_rpm", 0).alias("avg_engine_rpm"),
        _max("j1939_engine_rpm", 0).alias("max_engine_rpm"),
        _avg("j1939_engine_load_pct", 1).alias("avg_engine_load_pct"),
        _avg("j1939_fuel_rate_lph", 2).alias("avg_fuel_rate_lph"),
        _grown("j1939_total_fuel_used_l").alias("daily_fuel_consumed_l"),
        _grown("j1939_odometer_km").alias("daily_distance_km"),
        _avg("j1939_coolant_temp_c", 1).alias("avg_coolant_temp_c"),
        _max("j1939_coolant_temp_c", 1).alias("max_coolant_temp_c"),
        _avg("j1939_battery_voltage_v", 2).alias("avg_battery_v"),
        _grown("j1939_engine_hours").alias("daily_engine_hours"),
        _count_when(F.col("j1939_brake_switch")).alias("brake_events"),
        F.max("j1939_active_dtc_count").alias("max_dtc_count"),
        _avg("j1939_tyre_pressure_front_left_kpa", 1).alias("avg_tyre_fl_kpa"),
        _avg("j1939_tyre_pressure_front_right_kpa", 1).alias("avg_tyre_fr_kpa"),
        _avg("j1939_tyre_pressure_rear_left_kpa", 1).alias("avg_tyre_rl_kpa"),
        _avg("j1939_tyre_pressure_rear_right_kpa", 1).alias("avg_tyre_rr_kpa"),
        _avg("j1939_def_level_pct", 1).alias("avg_def_level_pct"),
    )


def fact_customer_fleet(readings: DataFrame) -> DataFrame:
    """``fleet_total_fuel_l`` adds up a running counter, as the table it reproduces does."""
    return readings.groupBy("customer_id", day_start(F.col("event_ts")).alias("metric_date")).agg(
        F.countDistinct("vehicle_id").alias("active_vehicles"),
        F.count("*").alias("total_readings"),
        _avg("j1939_vehicle_speed_kph", 1).alias("fleet_avg_speed_kph"),
        _avg("j1939_fuel_rate_lph", 2).alias("fleet_avg_fuel_rate_lph"),
        F.round(F.sum(F.coalesce("j1939_total_fuel_used_l", F.lit(0.0))), 0).alias("fleet_total_fuel_l"),
        _avg("j1939_engine_load_pct", 1).alias("fleet_avg_engine_load_pct"),
        _avg("j1939_coolant_temp_c", 1).alias("fleet_avg_coolant_temp_c"),
        _count_when(F.col("j1939_active_dtc_count") > 0).alias("readings_with_dtc"),
        _avg("j1939_battery_voltage_v", 2).alias("fleet_avg_battery_v"),
        _count_when(F.col("j1939_brake_switch")).alias("fleet_brake_events"),
        _avg("j1939_tyre_pressure_front_left_kpa", 1).alias("fleet_avg_tyre_fl_kpa"),
        _avg("j1939_def_level_pct", 1).alias("fleet_avg_def_level_pct"),
    )


def dim_vehicle(readings: DataFrame, policies: DataFrame) -> DataFrame:
    """Aggregate first: the policy join then sees one row per vehicle instead of every reading."""
    seen = readings.groupBy("vehicle_id", "customer_id", "device_id").agg(
        F.min("event_ts").alias("first_seen_ts"),
        F.max("event_ts").alias("last_seen_ts"),
        F.count("*").alias("total_gps_events"),
    )
    return _with_terms(seen, policies)


def _with_terms(seen: DataFrame, policies: DataFrame) -> DataFrame:
    terms = policies.select(
        "customer_id",
        "customer_name",
        "raw_retention_days",
        "curated_retention_days",
        "trip_retention_days",
        "tenant_isolation_enabled",
    )
    return seen.join(terms, "customer_id", "left").select(
        "vehicle_id", "customer_id", "device_id", *terms.columns[1:], *seen.columns[3:]
    )


def dim_customer(readings: DataFrame, policies: DataFrame, as_of: Column | str, active_days: int = 7) -> DataFrame:
    """Counting per vehicle first turns both distinct counts into plain sums."""
    vehicles = readings.groupBy("customer_id", "vehicle_id").agg(
        F.count("*").alias("events"), F.max("event_ts").alias("last_ts")
    )
    return _customers(vehicles, policies, as_of, active_days)


def _customers(vehicles: DataFrame, policies: DataFrame, as_of: Column | str, active_days: int = 7) -> DataFrame:
    is_active = F.col("vehicle_id").isNotNull() & (F.col("last_ts") >= days_before(as_ntz(as_of), active_days))
    fleets = vehicles.groupBy("customer_id").agg(
        F.count("vehicle_id").alias("fleet_size"),
        _count_when(is_active).alias("active_vehicles"),
        F.sum("events").alias("total_events"),
    )
    return policies.join(fleets, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "raw_retention_days",
        "curated_retention_days",
        "trip_retention_days",
        "video_retention_days",
        "tenant_isolation_enabled",
        "created_at",
        "fleet_size",
        "active_vehicles",
        "total_events",
    )


def telematics_health(readings: DataFrame, healthy: Collection[str] = rules.HEALTHY_CAN) -> DataFrame:
    return readings.groupBy("vehicle_id").agg(
        F.avg("tel_gsm_signal_dbm").alias("avg_gsm_signal_dbm"),
        F.max("tel_storage_queue_depth").alias("max_queue_depth"),
        F.bool_and(rules.can_is_healthy(F.col("tel_can_bus_health"), healthy)).alias("all_can_healthy"),
        F.bool_or(F.coalesce("tel_tamper_alert", F.lit(False))).alias("has_tamper_alert"),
    )


def fleet_health(
    readings: DataFrame, as_of: Column | str, healthy: Collection[str] = rules.HEALTHY_CAN
) -> DataFrame:
    """Engine figures per customer, vehicle and device; device figures per vehicle.

    The per-vehicle figures come from a window over the few aggregated rows of a vehicle, so the
    readings are aggregated once and never joined with themselves.
    """
    parts = readings.groupBy("customer_id", "vehicle_id", "device_id").agg(
        F.max("event_ts").alias("last_event_ts"),
        F.coalesce(F.max("j1939_active_dtc_count"), F.lit(0)).alias("max_dtc_count"),
        F.max("j1939_coolant_temp_c").alias("coolant"),
        F.min("j1939_battery_voltage_v").alias("battery"),
        F.max("j1939_odometer_km").alias("odometer"),
        F.max("j1939_engine_hours").alias("hours"),
        F.sum("tel_gsm_signal_dbm").alias("gsm_sum"),
        F.count("tel_gsm_signal_dbm").alias("gsm_count"),
        F.max("tel_storage_queue_depth").alias("queue"),
        F.bool_and(rules.can_is_healthy(F.col("tel_can_bus_health"), healthy)).alias("can_ok"),
        F.bool_or(F.coalesce("tel_tamper_alert", F.lit(False))).alias("tamper"),
    )
    return _health(parts, as_of)


def _health(parts: DataFrame, as_of: Column | str) -> DataFrame:
    vehicle = Window.partitionBy("vehicle_id")
    merged = parts.withColumns(
        {
            "can_healthy": F.bool_and("can_ok").over(vehicle),
            "has_tamper_alert": F.bool_or("tamper").over(vehicle),
            "max_queue_depth": F.max("queue").over(vehicle),
            "all_gsm": F.sum("gsm_sum").over(vehicle),
            "all_gsm_count": F.sum("gsm_count").over(vehicle),
        }
    )
    return merged.select(
        "customer_id",
        "vehicle_id",
        "device_id",
        "last_event_ts",
        minutes_between(F.col("last_event_ts"), as_ntz(as_of)).alias("minutes_since_last_event"),
        "max_dtc_count",
        (~F.col("can_healthy")).alias("has_can_bus_issues"),
        "has_tamper_alert",
        F.round("coolant", 1).alias("max_coolant_temp_c"),
        F.round("battery", 1).alias("min_battery_voltage_v"),
        F.round(F.try_divide("all_gsm", "all_gsm_count"), 1).alias("avg_gsm_signal_dbm"),
        "max_queue_depth",
        F.round("odometer", 0).alias("current_odometer_km"),
        F.round("hours", 0).alias("current_engine_hours"),
        rules.vehicle_health_status(
            F.col("max_dtc_count"),
            F.col("has_tamper_alert"),
            F.col("can_healthy"),
            F.col("coolant"),
            F.col("battery"),
        ).alias("health_status"),
    )


def vehicle_360(vehicles: DataFrame, daily: DataFrame) -> DataFrame:
    """Vehicle master data with its daily facts; one row per vehicle row and day."""
    facts = daily.drop("customer_id", "max_engine_rpm")
    joined = vehicles.select(
        "vehicle_id",
        "customer_id",
        "device_id",
        "customer_name",
        "first_seen_ts",
        "last_seen_ts",
        "total_gps_events",
    ).join(facts, "vehicle_id", "left")
    efficiency = rules.litres_per_100km(F.col("daily_fuel_consumed_l"), F.col("daily_distance_km"))
    return joined.withColumn("fuel_efficiency_l_per_100km", efficiency)


def customer_360(customers: DataFrame, fleet_daily: DataFrame) -> DataFrame:
    daily = fleet_daily.withColumnsRenamed(
        {"active_vehicles": "daily_active_vehicles", "total_readings": "daily_readings"}
    )
    return customers.select(
        "customer_id",
        "customer_name",
        "fleet_size",
        "active_vehicles",
        "total_events",
        "raw_retention_days",
        "curated_retention_days",
        "trip_retention_days",
        "tenant_isolation_enabled",
    ).join(daily, "customer_id", "left")


def realtime_fleet_status(readings: DataFrame, healthy: Collection[str] = rules.HEALTHY_CAN) -> DataFrame:
    """Newest state of every vehicle plus its running speed and fault figures."""
    newest = F.max_by(
        F.struct("event_ts", "customer_id", "gps_latitude", "gps_longitude", "tel_ignition_status", "tel_can_bus_health"),
        F.struct("event_ts", "ingest_ts"),
    )
    return _status(_vehicle_state(readings, newest, healthy))


def _vehicle_state(readings: DataFrame, newest: Column, healthy: Collection[str]) -> DataFrame:
    return readings.groupBy("vehicle_id").agg(
        newest.alias("newest"),
        F.round(F.avg("gps_speed_kph"), 1).alias("avg_speed_kph"),
        F.round(F.max("gps_speed_kph"), 1).alias("max_speed_kph"),
        F.coalesce(F.max("j1939_active_dtc_count"), F.lit(0)).alias("max_dtc_count"),
        F.bool_or(F.coalesce("tel_tamper_alert", F.lit(False))).alias("tamper"),
        F.bool_and(rules.can_is_healthy(F.col("tel_can_bus_health"), healthy)).alias("can_healthy"),
        F.max("j1939_coolant_temp_c").alias("coolant"),
        F.min("j1939_battery_voltage_v").alias("battery"),
    )


def _status(state: DataFrame) -> DataFrame:
    return state.select(
        "vehicle_id",
        F.col("newest.customer_id").alias("customer_id"),
        F.col("newest.event_ts").alias("last_event_ts"),
        F.col("newest.gps_latitude").alias("latest_lat"),
        F.col("newest.gps_longitude").alias("latest_lon"),
        "avg_speed_kph",
        "max_speed_kph",
        F.col("newest.tel_ignition_status").alias("ignition_status"),
        rules.vehicle_health_status(
            F.col("max_dtc_count"), F.col("tamper"), F.col("can_healthy"), F.col("coolant"), F.col("battery")
        ).alias("health_status"),
        "max_dtc_count",
        F.col("newest.tel_can_bus_health").alias("can_bus_health"),
    )


# ---- the same tables from partial aggregates per vehicle and day -----------------------------

_MEANS = {
    "speed": "j1939_vehicle_speed_kph",
    "fuel_rate": "j1939_fuel_rate_lph",
    "load": "j1939_engine_load_pct",
    "coolant": "j1939_coolant_temp_c",
    "battery": "j1939_battery_voltage_v",
    "tyre": "j1939_tyre_pressure_front_left_kpa",
    "def": "j1939_def_level_pct",
    "gsm": "tel_gsm_signal_dbm",
    "gps": "gps_speed_kph",
}
_MAXIMA = {
    "coolant": "j1939_coolant_temp_c",
    "dtc": "j1939_active_dtc_count",
    "odometer": "j1939_odometer_km",
    "hours": "j1939_engine_hours",
    "queue": "tel_storage_queue_depth",
    "gps": "gps_speed_kph",
}
_STATE = ("event_ts", "customer_id", "gps_latitude", "gps_longitude", "tel_ignition_status", "tel_can_bus_health")


def day_parts(readings: DataFrame, healthy: Collection[str] = rules.HEALTHY_CAN) -> DataFrame:
    """What fleet facts, dimensions, health and status need of a vehicle's day, in one row.

    All columns can be merged over days, so after late data only the touched days are computed
    again and the tables are rolled up from these few rows.
    """
    return readings.groupBy(
        "customer_id", "vehicle_id", "device_id", day_start(F.col("event_ts")).alias("metric_date")
    ).agg(
        F.count("*").alias("n"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        *[F.sum(c).alias(f"{m}_sum") for m, c in _MEANS.items()],
        *[F.count(c).alias(f"{m}_n") for m, c in _MEANS.items()],
        *[F.max(c).alias(f"{m}_max") for m, c in _MAXIMA.items()],
        F.min("j1939_battery_voltage_v").alias("battery_min"),
        F.sum(F.coalesce("j1939_total_fuel_used_l", F.lit(0.0))).alias("counter_sum"),
        _count_when(F.col("j1939_active_dtc_count") > 0).alias("dtc_readings"),
        _count_when(F.col("j1939_brake_switch")).alias("brakes"),
        F.bool_and(rules.can_is_healthy(F.col("tel_can_bus_health"), healthy)).alias("can_ok"),
        F.bool_or(F.coalesce("tel_tamper_alert", F.lit(False))).alias("tamper"),
        F.max_by(F.struct(*_STATE), _order()).alias("newest"),
        F.max(_order()).alias("newest_order"),
    )


def _order() -> Column:
    return F.struct("event_ts", "ingest_ts", F.col("record_metadata.offset").alias("offset"))


SKETCH_LG_K = 12
#: Relative error that a distinct-count sketch of this size keeps with a probability of 99.7 %.
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_LG_K / 2)


def distinct_sketches(readings: DataFrame) -> DataFrame:
    """Mergeable sketches of the vehicles and devices per customer and day, a few kilobytes each.

    Unlike exact distinct counts they add up: days to months, batches to tables, without a look at
    the readings again (see ``distinct_estimates``)."""
    return readings.groupBy("customer_id", day_start(F.col("event_ts")).alias("metric_date")).agg(
        F.hll_sketch_agg("vehicle_id", SKETCH_LG_K).alias("vehicles"),
        F.hll_sketch_agg("device_id", SKETCH_LG_K).alias("devices"),
    )


def distinct_estimates(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct vehicles and devices per key, from sketches of finer keys."""
    names = ("vehicles", "devices")
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names])


def merged_parts(parts: DataFrame, *keys: str) -> DataFrame:
    """Day parts of all days as one row per key, with the same columns but the day."""
    added = ["n", *[f"{m}_{k}" for m in _MEANS for k in ("sum", "n")], "counter_sum", "dtc_readings", "brakes"]
    return parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in added],
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        *[F.max(f"{m}_max").alias(f"{m}_max") for m in _MAXIMA],
        F.min("battery_min").alias("battery_min"),
        F.bool_and("can_ok").alias("can_ok"),
        F.bool_or("tamper").alias("tamper"),
        F.max_by("newest", "newest_order").alias("newest"),
        F.max("newest_order").alias("newest_order"),
    )


def _mean(name: str, digits: int) -> Column:
    return F.round(F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")), digits)


def fleet_from_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("customer_id", "metric_date").agg(
        F.countDistinct("vehicle_id").alias("active_vehicles"),
        F.sum("n").alias("total_readings"),
        _mean("speed", 1).alias("fleet_avg_speed_kph"),
        _mean("fuel_rate", 2).alias("fleet_avg_fuel_rate_lph"),
        F.round(F.sum("counter_sum"), 0).alias("fleet_total_fuel_l"),
        _mean("load", 1).alias("fleet_avg_engine_load_pct"),
        _mean("coolant", 1).alias("fleet_avg_coolant_temp_c"),
        F.sum("dtc_readings").alias("readings_with_dtc"),
        _mean("battery", 2).alias("fleet_avg_battery_v"),
        F.sum("brakes").alias("fleet_brake_events"),
        _mean("tyre", 1).alias("fleet_avg_tyre_fl_kpa"),
        _mean("def", 1).alias("fleet_avg_def_level_pct"),
    )


def vehicles_from_parts(parts: DataFrame, policies: DataFrame) -> DataFrame:
    seen = parts.groupBy("vehicle_id", "customer_id", "device_id").agg(
        F.min("first_ts").alias("first_seen_ts"),
        F.max("last_ts").alias("last_seen_ts"),
        F.sum("n").alias("total_gps_events"),
    )
    return _with_terms(seen, policies)


def customers_from_parts(parts: DataFrame, policies: DataFrame, as_of: Column | str) -> DataFrame:
    vehicles = parts.groupBy("customer_id", "vehicle_id").agg(
        F.sum("n").alias("events"), F.max("last_ts").alias("last_ts")
    )
    return _customers(vehicles, policies, as_of)


def health_from_parts(parts: DataFrame, as_of: Column | str) -> DataFrame:
    merged = parts.groupBy("customer_id", "vehicle_id", "device_id").agg(
        F.max("last_ts").alias("last_event_ts"),
        F.coalesce(F.max("dtc_max"), F.lit(0)).alias("max_dtc_count"),
        F.max("coolant_max").alias("coolant"),
        F.min("battery_min").alias("battery"),
        F.max("odometer_max").alias("odometer"),
        F.max("hours_max").alias("hours"),
        F.sum("gsm_sum").alias("gsm_sum"),
        F.sum("gsm_n").alias("gsm_count"),
        F.max("queue_max").alias("queue"),
        F.bool_and("can_ok").alias("can_ok"),
        F.bool_or("tamper").alias("tamper"),
    )
    return _health(merged, as_of)


def status_from_parts(parts: DataFrame) -> DataFrame:
    state = parts.groupBy("vehicle_id").agg(
        F.max_by("newest", "newest_order").alias("newest"),
        _mean("gps", 1).alias("avg_speed_kph"),
        F.round(F.max("gps_max"), 1).alias("max_speed_kph"),
        F.coalesce(F.max("dtc_max"), F.lit(0)).alias("max_dtc_count"),
        F.bool_or("tamper").alias("tamper"),
        F.bool_and("can_ok").alias("can_healthy"),
        F.max("coolant_max").alias("coolant"),
        F.min("battery_min").alias("battery"),
    )
    return _status(state)
