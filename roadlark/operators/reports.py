"""Scorecards, alerts, top lists and dashboard data built on the business tables.

Descending orders put missing values first unless stated otherwise, and every top list ends with
its key columns so that its rows are fully determined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlark.functions import rules


def _desc(column: str) -> Column:
    return F.desc_nulls_first(column)


def _total(column: str) -> Column:
    """Sum of values that carry at most two digits.  Adding them as decimals makes the result
    independent of the order in which tasks add."""
    return F.sum(F.col(column).cast("decimal(28,2)")).cast("double")


def _mean(column: str) -> Column:
    return F.try_divide(_total(column), F.count(column))


def for_customer(df: DataFrame, customer_id: str | None) -> DataFrame:
    """Dashboard filter; ``None`` means all customers."""
    return df if customer_id is None else df.where(F.col("customer_id") == customer_id)


# ---- driver scorecard ----------------------------------------------------------------------


def driver_scorecard(trips: DataFrame, health: DataFrame) -> DataFrame:
    """Trips summed per vehicle, joined with its health rows.

    Summing first gives the same groups as joining first, because a health row repeats all trips
    of its vehicle alike; rows that agree in status and fault count fall into one group.
    """
    per_vehicle = trips.groupBy("customer_id", "vehicle_id").agg(
        F.count("*").alias("trips"),
        _mean("fuel_efficiency_l_per_100km").alias("efficiency"),
        _mean("avg_speed_kph").alias("speed"),
        F.max("max_speed_kph").alias("top"),
        _total("distance_km").alias("km"),
        _total("fuel_consumed_l").alias("fuel"),
    )
    status = health.groupBy("customer_id", "vehicle_id", "health_status", "max_dtc_count").agg(
        F.count("*").alias("repeats")
    )
    times = F.coalesce("repeats", F.lit(1))
    return per_vehicle.join(status, ["customer_id", "vehicle_id"], "left").select(
        "customer_id",
        "vehicle_id",
        (F.col("trips") * times).alias("total_trips"),
        F.round("efficiency", 2).alias("avg_fuel_eff"),
        F.round("speed", 1).alias("avg_speed"),
        F.round("top", 1).alias("top_speed"),
        F.round(F.col("km") * times, 1).alias("total_km"),
        F.round(F.col("fuel") * times, 1).alias("total_fuel_l"),
        "health_status",
        "max_dtc_count",
        rules.driver_grade(F.col("efficiency"), F.col("max_dtc_count")).alias("driver_grade"),
    )


def scorecard_top(scorecard: DataFrame, n: int = 20) -> DataFrame:
    return scorecard.orderBy("driver_grade", _desc("total_km"), "customer_id", "vehicle_id").limit(n)


def worst_efficiency(scorecard: DataFrame, n: int = 10) -> DataFrame:
    return scorecard.orderBy(F.desc_nulls_last("avg_fuel_eff"), "customer_id", "vehicle_id").limit(n)


def efficiency_by_grade(scorecard: DataFrame) -> DataFrame:
    return scorecard.groupBy("driver_grade").agg(F.round(_mean("avg_fuel_eff"), 2).alias("avg_fuel_eff"))


def customer_fleet_report(scorecard: DataFrame, customer_id: str) -> DataFrame:
    return (
        for_customer(scorecard, customer_id)
        .select(
            "vehicle_id",
            "total_trips",
            F.col("total_km").alias("total_distance_km"),
            "total_fuel_l",
            F.col("avg_fuel_eff").alias("avg_fuel_efficiency"),
            "top_speed",
            "health_status",
            "driver_grade",
        )
        .orderBy(_desc("total_distance_km"), "vehicle_id")
    )


# ---- speed -----------------------------------------------------------------------------------


def speed_alert_report(trips: DataFrame) -> DataFrame:
    return trips.where("max_speed_kph > 60").select(
        "customer_id",
        "vehicle_id",
        "trip_num",
        "trip_start_ts",
        "start_geofence",
        "end_geofence",
        F.round("max_speed_kph", 1).alias("max_speed_kph"),
        F.round("avg_speed_kph", 1).alias("avg_speed_kph"),
        F.round("distance_km", 1).alias("distance_km"),
        F.round("duration_min", 1).alias("duration_min"),
        rules.speed_alert_level(F.col("max_speed_kph")).alias("speed_alert_level"),
    )


def top_speed_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    return alerts.orderBy(_desc("max_speed_kph"), "vehicle_id", "trip_num").limit(n)


def speed_violations(trips: DataFrame, customer_id: str, threshold: float) -> DataFrame:
    return (
        for_customer(trips, customer_id)
        .where(F.col("max_speed_kph") > threshold)
        .select(
            "vehicle_id",
            "trip_num",
            "trip_start_ts",
            F.round("max_speed_kph", 1).alias("max_speed_kph"),
            "start_geofence",
            "end_geofence",
        )
        .orderBy(_desc("max_speed_kph"), "vehicle_id", "trip_num")
    )


def violations_by_customer(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("customer_id").agg(
        F.count("*").alias("violations"),
        F.count_if(F.col("speed_alert_level") == "CRITICAL").alias("critical_violations"),
    )


# ---- trips -----------------------------------------------------------------------------------


def top_trips(trips: DataFrame, n: int = 20) -> DataFrame:
    return (
        trips.orderBy(_desc("distance_km"), "vehicle_id", "trip_num")
        .limit(n)
        .select(
            "customer_id",
            "vehicle_id",
            "trip_num",
            "trip_start_ts",
            "trip_end_ts",
            F.round("duration_min", 1).alias("duration_min"),
            F.round("distance_km", 1).alias("distance_km"),
            F.round("fuel_consumed_l", 1).alias("fuel_l"),
            F.round("fuel_efficiency_l_per_100km", 2).alias("fuel_eff"),
            F.round("avg_speed_kph", 1).alias("avg_speed"),
            F.round("max_speed_kph", 1).alias("max_speed"),
            "start_geofence",
            "end_geofence",
        )
    )


def longest_trips(trips: DataFrame, n: int = 10) -> DataFrame:
    return top_trips(trips, n).select(
        "vehicle_id",
        "customer_id",
        "trip_num",
        F.col("distance_km").alias("km"),
        F.col("duration_min").alias("mins"),
        "fuel_eff",
        "start_geofence",
        "end_geofence",
    )


def top_routes(trips: DataFrame, n: int = 10) -> DataFrame:
    """Trips per start and end fence; a trip that starts or ends outside all fences has no route."""
    route = F.concat("start_geofence", F.lit(" → "), "end_geofence")
    counts = trips.where("start_geofence IS NOT NULL AND end_geofence IS NOT NULL").groupBy(route.alias("route"))
    return counts.agg(F.count("*").alias("trips")).orderBy(F.desc("trips"), "route").limit(n)


def trip_averages(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.round(_mean("distance_km"), 2).alias("avg_distance_km"),
        F.round(_mean("duration_min"), 2).alias("avg_duration_min"),
        F.round(_mean("fuel_consumed_l"), 2).alias("avg_fuel_l"),
        F.round(_mean("avg_speed_kph"), 2).alias("avg_speed_kph"),
    )


# ---- daily facts, health and customers ---------------------------------------------------------


def top_fuel_days(daily: DataFrame, n: int = 20) -> DataFrame:
    return (
        daily.orderBy(_desc("daily_fuel_consumed_l"), "vehicle_id", "metric_date", "customer_id")
        .limit(n)
        .select(
            "vehicle_id",
            "metric_date",
            "total_readings",
            F.round("avg_speed_kph", 1).alias("avg_speed"),
            F.round("max_speed_kph", 1).alias("max_speed"),
            F.round("daily_fuel_consumed_l", 1).alias("fuel_l"),
            F.round("daily_distance_km", 1).alias("distance_km"),
            "brake_events",
            "max_dtc_count",
        )
    )


def at_risk_vehicles(health: DataFrame, n: int = 20) -> DataFrame:
    return (
        health.where(F.col("health_status").isin("WARNING", "CRITICAL"))
        .orderBy("health_status", _desc("max_dtc_count"), "vehicle_id", "customer_id")
        .limit(n)
        .select(
            "vehicle_id",
            "customer_id",
            "health_status",
            "minutes_since_last_event",
            "max_dtc_count",
            "has_can_bus_issues",
            "has_tamper_alert",
            F.round("max_coolant_temp_c", 1).alias("max_coolant_c"),
            F.round("min_battery_voltage_v", 1).alias("min_battery_v"),
            F.round("current_odometer_km", 0).alias("odometer_km"),
        )
    )


def health_cards(health: DataFrame) -> DataFrame:
    return health.agg(
        F.count_if(F.col("health_status") == "HEALTHY").alias("healthy"),
        F.count_if(F.col("health_status") == "WARNING").alias("warning"),
        F.count_if(F.col("health_status") == "CRITICAL").alias("critical"),
        F.count_if("has_can_bus_issues").alias("can_bus_issues"),
        F.round(_mean("avg_gsm_signal_dbm"), 1).alias("avg_gsm_signal_dbm"),
    )


def top_customers(customers: DataFrame, fleet_daily: DataFrame, n: int = 10) -> DataFrame:
    figures = fleet_daily.select(
        "customer_id",
        F.round("fleet_avg_speed_kph", 1).alias("avg_speed"),
        F.round("fleet_total_fuel_l", 0).alias("total_fuel_l"),
        "fleet_brake_events",
        "readings_with_dtc",
        F.round("fleet_avg_coolant_temp_c", 1).alias("avg_coolant_c"),
        "metric_date",
    )
    return (
        customers.select("customer_id", "customer_name", "fleet_size", "active_vehicles", "total_events")
        .join(figures, "customer_id", "left")
        .orderBy(F.desc_nulls_last("fleet_size"), "customer_id", "metric_date")
        .limit(n)
        .drop("metric_date")
    )


def top_vehicles(vehicles: DataFrame, n: int = 20) -> DataFrame:
    return (
        vehicles.orderBy(_desc("total_gps_events"), "vehicle_id", "customer_id")
        .limit(n)
        .select(
            "vehicle_id",
            "customer_id",
            "device_id",
            "customer_name",
            "first_seen_ts",
            "last_seen_ts",
            "total_gps_events",
        )
    )


def kpi_row(trips: DataFrame, health: DataFrame) -> DataFrame:
    """The dashboard's top figures as one row.

    The scorecard's vehicles and the alert counts follow from the trips themselves, so one pass
    over the trips gives all but the last figure.  The two one-row aggregates are stacked and
    collapsed, which needs no join.
    """
    level = rules.speed_alert_level(F.col("max_speed_kph"))
    of_trips = trips.agg(
        F.countDistinct("vehicle_id").alias("total_vehicles"),
        F.count("*").alias("total_trips"),
        F.round(_mean("fuel_efficiency_l_per_100km"), 2).alias("avg_fuel_efficiency"),
        F.round(_total("distance_km"), 1).alias("total_distance_km"),
        F.count_if(F.col("max_speed_kph") > 60).alias("speed_violations"),
        F.count_if(level == "CRITICAL").alias("critical_violations"),
    )
    of_health = health.agg(F.count_if(F.col("health_status") == "WARNING").alias("warning_vehicles"))
    stacked = of_trips.unionByName(of_health, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def counts_by(df: DataFrame, *columns: str, name: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value; the total is a subquery over the few grouped rows."""
    counts = df.groupBy(column).agg(F.count("*").alias("event_count"))
    total = counts.select(F.sum("event_count")).scalar()
    return counts.withColumn("pct", F.round(F.col("event_count") * 100.0 / total, 1))
