"""The model as temporary views and SQL functions, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from roadlark import schema
from roadlark.plans.model import FleetModel

FUNCTIONS = {
    "haversine_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": """
        CASE WHEN lat1 + lon1 + lat2 + lon2 IS NOT NULL THEN 6371 * acos(least(1, greatest(-1,
          sin(radians(lat1)) * sin(radians(lat2))
          + cos(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2 - lon1))))) END""",
    "engine_health_grade(coolant_c DOUBLE, dtc_count BIGINT, battery_v DOUBLE, oil_kpa DOUBLE) RETURNS STRING": """
        CASE WHEN dtc_count >= 3 OR coolant_c > 105 OR battery_v < 22 THEN 'CRITICAL'
          WHEN dtc_count >= 1 OR coolant_c > 95 OR battery_v < 24 OR oil_kpa < 200 THEN 'WARNING'
          ELSE 'HEALTHY' END""",
    "kmh_to_mph(speed_kmh DOUBLE) RETURNS DOUBLE": "round(speed_kmh * 0.621371D, 1)",
}

TABLE_FUNCTIONS = {
    """get_customer_fleet_report(customer STRING) RETURNS TABLE (
        vehicle_id STRING, total_trips BIGINT, total_distance_km DOUBLE, total_fuel_l DOUBLE,
        avg_fuel_efficiency DOUBLE, top_speed DOUBLE, health_status STRING, driver_grade STRING)""": """
        SELECT vehicle_id, total_trips, total_km, total_fuel_l, avg_fuel_eff, top_speed, health_status, driver_grade
        FROM driver_scorecard_v1 WHERE customer_id = customer
        ORDER BY total_km DESC NULLS FIRST, vehicle_id""",
    """get_speed_violations(customer STRING, threshold DOUBLE) RETURNS TABLE (
        vehicle_id STRING, trip_num BIGINT, trip_start_ts TIMESTAMP_NTZ, max_speed_kph DOUBLE,
        start_geofence STRING, end_geofence STRING)""": """
        SELECT vehicle_id, trip_num, trip_start_ts, round(max_speed_kph, 1), start_geofence, end_geofence
        FROM trip_summaries_v1 WHERE customer_id = customer AND max_speed_kph > threshold
        ORDER BY max_speed_kph DESC NULLS FIRST, vehicle_id, trip_num""",
}


def register(spark: SparkSession, model: FleetModel) -> None:
    """Create one temporary view per table and the SQL functions that read them."""
    views = {
        "vehicle_telemetry_raw_v1": model.raw,
        "geofence_definitions": model.fences,
        "road_segments": model.segments,
        "customer_retention_policies": model.policies,
        "fact_vehicle_daily_metrics_v1": model.vehicle_daily,
        "fact_customer_fleet_summary_v1": model.fleet_daily,
        "dim_vehicle_v1": model.vehicles,
        "dim_customer_v1": model.customers,
        "fleet_health_dashboard_v1": model.health,
        "trip_summaries_v1": model.trips,
        "vehicle360_v1": model.vehicle_360,
        "customer360_v1": model.customer_360,
        "monthly_road_segment_fuel_efficiency_v1": model.segment_efficiency,
        "realtime_fleet_status": model.status,
        "driver_scorecard_v1": model.scorecard,
        "speed_alert_report_v1": model.alerts,
    }
    names = {"gps": "gps_signals", "imu": "imu_signals", "j1939": "j1939_signals", "telematics": "telematics"}
    for signal in schema.SIGNALS:
        views[f"vw_{names[signal]}_v1"] = model.view(signal)
        table = "telematics_device_params" if signal == "telematics" else names[signal]
        views[f"{table}_v1"] = model.signal(signal)
    for name, table in views.items():
        table.createOrReplaceTempView(name)
    for head, body in {**FUNCTIONS, **TABLE_FUNCTIONS}.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
