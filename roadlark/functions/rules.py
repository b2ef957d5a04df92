"""Business rules as Column expressions."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlark.functions.timing import seconds_between

LATE_AFTER_SECONDS = 25400
# Devices report OK; dashboards were written for HEALTHY.  Both count as healthy by default.
HEALTHY_CAN = ("OK", "HEALTHY")
STRICT_CAN = ("HEALTHY",)
KMH_TO_MPH = 0.621371


def arrived_late(event_ts: Column, ingest_ts: Column, after_seconds: int = LATE_AFTER_SECONDS) -> Column:
    """TRUE when event and ingest differ by more than the limit; a missing time is not late."""
    return F.coalesce(F.abs(seconds_between(event_ts, ingest_ts)) > after_seconds, F.lit(False))


def engine_health_grade(coolant_c: Column, dtc_count: Column, battery_v: Column, oil_kpa: Column) -> Column:
    critical = (dtc_count >= 3) | (coolant_c > 105) | (battery_v < 22)
    warning = (dtc_count >= 1) | (coolant_c > 95) | (battery_v < 24) | (oil_kpa < 200)
    return F.when(critical, "CRITICAL").when(warning, "WARNING").otherwise("HEALTHY")


def vehicle_health_status(
    dtc_count: Column, tampered: Column, can_healthy: Column, coolant_c: Column, battery_v: Column
) -> Column:
    return (
        F.when((dtc_count > 5) | tampered, "CRITICAL")
        .when((dtc_count > 2) | ~can_healthy, "WARNING")
        .when((coolant_c > 105) | (battery_v < 22), "ALERT")
        .otherwise("HEALTHY")
    )


def can_is_healthy(can_health: Column, healthy: Collection[str] = HEALTHY_CAN) -> Column:
    return F.coalesce(can_health.isin(*healthy), F.lit(False))


def driver_grade(avg_efficiency: Column, dtc_count: Column) -> Column:
    return (
        F.when((avg_efficiency < 25) & (dtc_count == 0), "A - Excellent")
        .when((avg_efficiency < 35) & (dtc_count <= 1), "B - Good")
        .when(avg_efficiency < 45, "C - Needs Improvement")
        .otherwise("D - At Risk")
    )


def speed_alert_level(max_speed_kph: Column) -> Column:
    return (
        F.when(max_speed_kph > 100, "CRITICAL")
        .when(max_speed_kph > 80, "HIGH")
        .when(max_speed_kph > 60, "MODERATE")
        .otherwise("NORMAL")
    )


def litres_per_100km(litres: Column, km: Column) -> Column:
    return F.when(km > 0, F.round(litres / km * 100, 2))


def kmh_to_mph(kmh: Column) -> Column:
    return F.round(kmh * KMH_TO_MPH, 1)
