"""Telemetry projected from the generic ``events`` table.

Each event becomes one vehicle reading; every twentieth is delivered a second time, an hour
later, with a corrected speed.  All derived sensor values are binary fractions, so sums and
averages are exact and do not depend on the order in which tasks add them.

The expressions are plain SQL that Spark and other ANSI engines read alike, but for three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlark import schema

# Differ between SQL dialects: seconds since 2024-01-01, the JSON field, interval arithmetic.
SECONDS = "unix_seconds(CAST(ts AS TIMESTAMP)) - 1704067200"
JSON_K = "CAST(get_json_object(props, '$.k') AS INT)"
INGEST = "ts + make_dt_interval(0, 0, 0, (event_id * 7919) % 50000 + copy_no * 3600)"

# Input of the expressions: event_id, user_id, event_type, ts, sec, k, fence_no, speed, load, copy_no.
FENCE_NO = "(event_id * 13 + user_id) % 25"
FENCE_LAT = "8e0 + {n} * 0.875e0"
FENCE_LON = "72e0 + ((37 * {n}) % 150) * 0.125e0"
SPEED = "k * 1.25e0 + copy_no"
LOAD = "20e0 + k * 0.5e0 + (event_id % 8) * 0.25e0"

# Seven digits at least; longer numbers keep all of theirs.
NUMBER = (
    "lpad(CAST(user_id AS STRING), CAST(greatest(7, length(CAST(user_id AS STRING))) AS INT), '0')"
)

FIELDS: dict[str, str] = {
    "event_ts": "ts",
    "customer_id": (
        "CASE WHEN user_id % 50 = 17 AND event_id % 3 = 0 THEN 'CUST_9999'"
        " ELSE concat('CUST_', lpad(CAST(user_id % 20 + 1 AS STRING), 4, '0')) END"
    ),
    "vehicle_id": f"concat('VH_', {NUMBER})",
    "device_id": f"concat('DEV_', {NUMBER})",
    "gps_latitude": (
        "CASE WHEN event_id % 71 <> 0 THEN " + FENCE_LAT.format(n="fence_no")
        + " + ((event_id * 31) % 400 - 200) / 1024e0 END"
    ),
    "gps_longitude": (
        "CASE WHEN event_id % 71 <> 0 THEN " + FENCE_LON.format(n="fence_no")
        + " + ((event_id * 17) % 400 - 200) / 1024e0 END"
    ),
    "gps_altitude_m": "400e0 + (event_id % 200) * 0.5e0",
    "gps_speed_kph": "speed",
    "gps_heading_deg": "(event_id * 7) % 360 + 0e0",
    "gps_hdop": "0.5e0 + (event_id % 10) * 0.25e0",
    "gps_satellite_count": "6 + event_id % 9",
    "gps_fix_quality": "CAST(CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 5 END AS BIGINT)",
    "imu_accel_x_g": "((event_id * 11) % 33 - 16) / 32e0",
    "imu_accel_y_g": "((event_id * 5) % 17 - 8) / 64e0",
    "imu_accel_z_g": "1e0 + ((event_id * 3) % 9 - 4) / 64e0",
    "imu_gyro_x_dps": "((event_id * 7) % 33 - 16) / 8e0",
    "imu_gyro_y_dps": "((event_id * 19) % 33 - 16) / 8e0",
    "imu_gyro_z_dps": "((event_id * 23) % 25 - 12) / 8e0",
    "j1939_vehicle_speed_kph": "speed",
    "j1939_engine_rpm": "800e0 + k * 18 + event_id % 50",
    "j1939_accelerator_pedal_pct": "least(95e0, k * 0.75e0)",
    "j1939_engine_load_pct": "load",
    "j1939_engine_torque_pct": "load * 0.875e0",
    "j1939_fuel_rate_lph": "2e0 + k * 0.25e0 + (event_id % 4) * 0.125e0",
    "j1939_total_fuel_used_l": "5000e0 + sec / 256e0",
    "j1939_fuel_level_pct": "100e0 - (event_id % 360) * 0.25e0",
    "j1939_coolant_temp_c": (
        "CASE WHEN event_id % 61 <> 0 THEN 78e0 + (event_id % 100) * 0.25e0"
        " + CASE WHEN user_id % 11 = 3 THEN 6e0 ELSE 0e0 END END"
    ),
    "j1939_oil_temp_c": "90e0 + (event_id % 60) * 0.25e0",
    "j1939_oil_pressure_kpa": "180e0 + event_id % 300",
    "j1939_intake_manifold_pressure_kpa": "80e0 + load * 1.5e0",
    "j1939_battery_voltage_v": (
        "CASE WHEN event_id % 53 <> 0 THEN 24e0 + (event_id % 15) * 0.25e0"
        " - CASE WHEN user_id % 13 = 5 THEN 4e0 ELSE 0e0 END END"
    ),
    "j1939_engine_hours": "1000e0 + sec / 4096e0",
    "j1939_odometer_km": "10000e0 + sec * (1 + user_id % 6) / 256e0",
    "j1939_gear_selected": "least(CAST(6 AS BIGINT), CAST(floor(speed / 20e0) AS BIGINT) + 1)",
    "j1939_brake_switch": "event_id % 6 = 0",
    "j1939_clutch_switch": "event_id % 50 = 1",
    "j1939_pto_status": "event_id % 100 = 7",
    "j1939_active_dtc_count": (
        "CASE WHEN user_id % 7 = 2 THEN event_id % 7 WHEN user_id % 7 = 4 THEN event_id % 4"
        " WHEN user_id % 7 < 2 THEN event_id % 2 ELSE CAST(0 AS BIGINT) END"
    ),
    "tel_ignition_status": (
        "CASE WHEN event_id % 97 = 5 THEN NULL WHEN event_id % 89 = 7 THEN 'ACC'"
        " WHEN event_type = 'error' THEN 'OFF' ELSE 'ON' END"
    ),
    "tel_external_power_v": "12e0 + (event_id % 8) * 0.25e0",
    "tel_backup_battery_v": "3.5e0 + (event_id % 5) * 0.125e0",
    "tel_device_temp_c": "30e0 + (event_id % 50) * 0.5e0",
    "tel_gsm_signal_dbm": "-95e0 + (event_id % 70) * 0.5e0",
    "tel_network_type": "CASE event_id % 4 WHEN 2 THEN '3G' WHEN 3 THEN '5G' ELSE '4G' END",
    "tel_gnss_fix_status": "CASE WHEN speed > 0e0 THEN '3D' ELSE '2D' END",
    "tel_can_bus_health": "CASE WHEN user_id % 5 = 1 AND event_id % 9 = 0 THEN 'DEGRADED' ELSE 'OK' END",
    "tel_storage_queue_depth": "event_id % 11",
    "tel_tamper_alert": "user_id % 17 = 6 AND event_id % 40 = 3",
    "j1939_tyre_pressure_front_left_kpa": "CASE WHEN user_id % 2 = 1 THEN 720e0 + (event_id % 100) * 0.5e0 END",
    "j1939_tyre_pressure_front_right_kpa": "CASE WHEN user_id % 2 = 1 THEN 725e0 + (event_id % 90) * 0.5e0 END",
    "j1939_tyre_pressure_rear_left_kpa": "CASE WHEN user_id % 2 = 1 THEN 700e0 + (event_id % 80) * 0.5e0 END",
    "j1939_tyre_pressure_rear_right_kpa": "CASE WHEN user_id % 2 = 1 THEN 705e0 + (event_id % 70) * 0.5e0 END",
    "j1939_def_level_pct": "CASE WHEN user_id % 2 = 1 THEN 40e0 + (event_id % 200) * 0.25e0 END",
}
OFFSET = "event_id * 2 + copy_no"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project_events(events: DataFrame) -> DataFrame:
    """``events`` (batch or stream) to landing rows; stateless, one pass, no shuffle."""
    delivered = events.selectExpr(
        "*",
        f"{SECONDS} AS sec",
        f"{JSON_K} AS k",
        f"{FENCE_NO} AS fence_no",
        "explode(if(event_id % 20 = 0, array(0, 1), array(0))) AS copy_no",
    ).selectExpr("*", f"{SPEED} AS speed", f"{LOAD} AS load")
    metadata = (
        f"named_struct('offset', {OFFSET}, 'topic', 'VEHICLE_TELEMETRY', 'partition', user_id % 10,"
        f" 'key', {FIELDS['vehicle_id']}, 'timestamp', unix_millis(CAST(ts AS TIMESTAMP)), 'other', CAST(NULL AS STRING)) AS record_metadata"
    )
    columns = [f"{FIELDS[name]} AS {name}" for name in schema.names(schema.ALL_FIELDS)]
    return delivered.selectExpr(metadata, *columns, f"{INGEST} AS ingest_ts")


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_events(read_table(spark, sf_dir, "events"))


def spread_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table for queries that build and write all of its columns.

    A narrow event becomes a wide row, so a small file, or one of few row groups, would keep few
    tasks busy for long: the events are dealt out first."""
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return project_events(read_table(spark, sf_dir, "events").repartition(tasks))
