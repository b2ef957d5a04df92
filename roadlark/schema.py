"""Canonical telemetry schema.

One landing row is one *delivery* of one vehicle reading.  The 48 phase-1 fields and the
five fields that arrive after the schema evolves share one ``StructType``; a producer that
does not know the new fields simply leaves them NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

_D, _L, _S, _B = T.DoubleType(), T.LongType(), T.StringType(), T.BooleanType()

# Field names and types of the landing table.
KEY_FIELDS = [
    ("event_ts", T.TimestampNTZType()),
    ("customer_id", _S),
    ("vehicle_id", _S),
    ("device_id", _S),
]
GPS_FIELDS = [
    ("gps_latitude", _D),
    ("gps_longitude", _D),
    ("gps_altitude_m", _D),
    ("gps_speed_kph", _D),
    ("gps_heading_deg", _D),
    ("gps_hdop", _D),
    ("gps_satellite_count", _L),
    ("gps_fix_quality", _L),
]
IMU_FIELDS = [
    ("imu_accel_x_g", _D),
    ("imu_accel_y_g", _D),
    ("imu_accel_z_g", _D),
    ("imu_gyro_x_dps", _D),
    ("imu_gyro_y_dps", _D),
    ("imu_gyro_z_dps", _D),
]
J1939_FIELDS = [
    ("j1939_vehicle_speed_kph", _D),
    ("j1939_engine_rpm", _D),
    ("j1939_accelerator_pedal_pct", _D),
    ("j1939_engine_load_pct", _D),
    ("j1939_engine_torque_pct", _D),
    ("j1939_fuel_rate_lph", _D),
    ("j1939_total_fuel_used_l", _D),
    ("j1939_fuel_level_pct", _D),
    ("j1939_coolant_temp_c", _D),
    ("j1939_oil_temp_c", _D),
    ("j1939_oil_pressure_kpa", _D),
    ("j1939_intake_manifold_pressure_kpa", _D),
    ("j1939_battery_voltage_v", _D),
    ("j1939_engine_hours", _D),
    ("j1939_odometer_km", _D),
    ("j1939_gear_selected", _L),
    ("j1939_brake_switch", _B),
    ("j1939_clutch_switch", _B),
    ("j1939_pto_status", _B),
    ("j1939_active_dtc_count", _L),
]
EVOLVED_FIELDS = [
    ("j1939_tyre_pressure_front_left_kpa", _D),
    ("j1939_tyre_pressure_front_right_kpa", _D),
    ("j1939_tyre_pressure_rear_left_kpa", _D),
    ("j1939_tyre_pressure_rear_right_kpa", _D),
    ("j1939_def_level_pct", _D),
]
TELEMATICS_FIELDS = [
    ("tel_ignition_status", _S),
    ("tel_external_power_v", _D),
    ("tel_backup_battery_v", _D),
    ("tel_device_temp_c", _D),
    ("tel_gsm_signal_dbm", _D),
    ("tel_network_type", _S),
    ("tel_gnss_fix_status", _S),
    ("tel_can_bus_health", _S),
    ("tel_storage_queue_depth", _L),
    ("tel_tamper_alert", _B),
]

METADATA = T.StructType(
    [
        T.StructField("offset", _L),
        T.StructField("topic", _S),
        T.StructField("partition", _L),
        T.StructField("key", _S),
        T.StructField("timestamp", _L),
        # All further keys of a message's metadata (push time, headers, ...) as one JSON object.
        T.StructField("other", _S),
    ]
)


def names(fields: list[tuple[str, T.DataType]]) -> list[str]:
    return [name for name, _ in fields]


def struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


PHASE1_FIELDS = KEY_FIELDS + GPS_FIELDS + IMU_FIELDS + J1939_FIELDS + TELEMATICS_FIELDS
ALL_FIELDS = PHASE1_FIELDS + EVOLVED_FIELDS

SIGNALS = {
    "gps": names(GPS_FIELDS),
    "imu": names(IMU_FIELDS),
    "j1939": names(J1939_FIELDS + EVOLVED_FIELDS),
    "telematics": names(TELEMATICS_FIELDS),
}
SIGNAL_KEYS = ["event_ts", "customer_id", "vehicle_id", "device_id", "ingest_ts"]

PHASE1_CONTENT = struct(PHASE1_FIELDS)
CONTENT = struct(ALL_FIELDS)
LANDING = T.StructType(
    [T.StructField("record_metadata", METADATA)]
    + CONTENT.fields
    + [T.StructField("ingest_ts", T.TimestampNTZType())]
)
