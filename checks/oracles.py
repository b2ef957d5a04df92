"""The registered queries as DuckDB SQL, written independently of the Spark plans.

Queries are assembled from named building blocks; ``_sql`` adds the blocks a query mentions.
"""

from __future__ import annotations

import math
import re

from roadlark import schema
from roadlark.functions import hexagons
from roadlark.operators.text import LEXICON
from roadlark.plans.registry import AS_OF, RETENTION_AS_OF, ROLE, TENANT, TRACKED_VEHICLE
from roadlark.sources import events as ev

BLOCKS: dict[str, str] = {}


def rnd(expr: str, digits: int, scale: int = 9) -> str:
    """Half away from zero on the decimal value, as the engine rounds."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,{scale})), {digits}) AS DOUBLE)"


def avg_exact(expr: str) -> str:
    return f"(CAST(sum(CAST({expr} AS DECIMAL(28,2))) AS DOUBLE) / nullif(count({expr}), 0))"


def sum_exact(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(28,2))) AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def n_if(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(12742e0 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def cell(lat: str, lon: str, resolution: int) -> str:
    per_degree = {7: 64, 9: 512}[resolution]
    return (
        f"('C{resolution}_' || CAST(floor({lat} * {per_degree}) AS BIGINT) || '_'"
        f" || CAST(floor({lon} * {per_degree}) AS BIGINT))"
    )


def _face_values() -> str:
    """(face, centre, x axis, y axis) of the icosahedron's faces, from their published centres."""
    rows = []
    for n, (lat, lon, azimuth) in enumerate(hexagons.FACES):
        centre = [math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)]
        north = [-math.sin(lat) * math.cos(lon), -math.sin(lat) * math.sin(lon), math.cos(lat)]
        east = [-math.sin(lon), math.cos(lon), 0.0]
        x = [math.cos(azimuth) * p + math.sin(azimuth) * q for p, q in zip(north, east, strict=True)]
        y = [math.sin(azimuth) * p - math.cos(azimuth) * q for p, q in zip(north, east, strict=True)]
        rows.append(f"({n}, {', '.join(f'{v!r}::DOUBLE' for v in (*centre, *x, *y))})")
    return ", ".join(rows)


def hexes(resolution: int) -> str:
    """(lat, lon, h): hexagon ids of all points in ``hexpoint``, one subquery per level."""
    size = math.sqrt(7) ** resolution * 2 / (3 - math.sqrt(5))
    turn = math.asin(math.sqrt(3 / 28)) if resolution % 2 else 0.0
    sine, cosine = math.sin(turn) * size, math.cos(turn) * size
    sql = f"""
SELECT lat, lon, face, (px * {cosine!r} + py * {sine!r}) / d AS hx, (py * {cosine!r} - px * {sine!r}) / d AS hy
FROM (SELECT p.lat, p.lon, f.face, vx * cx + vy * cy + vz * cz AS d,
    vx * xx + vy * xy + vz * xz AS px, vx * yx + vy * yy + vz * yz AS py
  FROM (SELECT lat, lon, cos(radians(lat)) * cos(radians(lon)) AS vx, cos(radians(lat)) * sin(radians(lon)) AS vy,
      sin(radians(lat)) AS vz FROM hexpoint) p,
    (VALUES {_face_values()}) f(face, cx, cy, cz, xx, xy, xz, yx, yy, yz)
  QUALIFY row_number() OVER (PARTITION BY p.lat, p.lon ORDER BY d DESC, face) = 1)"""
    # The nearest lattice point is a corner of the parallelogram that holds the place.
    sql = f"""
SELECT lat, lon, face, CAST(floor(a) AS BIGINT) + i AS a, CAST(floor(b) AS BIGINT) + j AS b, 0::BIGINT AS digits, 0::BIGINT AS lead
FROM (SELECT lat, lon, face, hx + hy / sqrt(3) AS a, hy * 2 / sqrt(3) AS b FROM ({sql})), (VALUES (0), (1)) u(i), (VALUES (0), (1)) v(j)
QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY pow(floor(a) + i - a, 2) + pow(floor(b) + j - b, 2)
  - (floor(a) + i - a) * (floor(b) + j - b)) = 1"""
    for level in range(resolution, 0, -1):
        up, down = (("3 * a - b", "a + 2 * b"), ("2 * pa + pb", "3 * pb - pa"))
        if level % 2 == 0:
            up, down = (("2 * a + b", "3 * b - a"), ("3 * pa - pb", "pa + 2 * pb"))
        sql = f"""
SELECT lat, lon, face, pa AS a, pb AS b, digits + (digit << {3 * (15 - level)}) AS digits, CASE WHEN digit <> 0 THEN digit ELSE lead END AS lead
FROM (SELECT *, CAST(4 * da + 2 * db + 7 * greatest(0, -da, -db) AS BIGINT) AS digit
  FROM (SELECT *, a - ({down[0]}) AS da, b - ({down[1]}) AS db
    FROM (SELECT *, CAST(round(({up[0]}) / 7.0) AS BIGINT) AS pa, CAST(round(({up[1]}) / 7.0) AS BIGINT) AS pb FROM ({sql}))))"""
    known = [hexagons.base_cell(n // 27, n // 9 % 3, n // 3 % 3, n % 3) for n in range(540)]
    places = ", ".join(f"({n}, {cell}, {turns})" for n, (cell, turns) in enumerate(known))
    head = (1 << 59) + (resolution << 52) + sum(7 << 3 * n for n in range(15 - resolution))
    ring = "[1, 5, 4, 6, 2, 3]"
    digits = " + ".join(
        f"(CASE WHEN (digits >> {s}) & 7 = 0 THEN 0 ELSE {ring}[1 + CAST((list_position({ring}, CAST((digits >> {s}) & 7 AS INT)) - 1 + turns) % 6 AS INT)] END::BIGINT << {s})"
        for s in (3 * (15 - level) for level in range(1, resolution + 1))
    )
    return f"""
SELECT lat, lon, printf('%x', {head} + (cell::BIGINT << 45) + {digits}) AS h
FROM ({sql}) JOIN (VALUES {places}) t(place, cell, turns)
  ON place = face * 27 + 9 * a + 3 * b + 13 * greatest(0, -a, -b)"""


def hexed(lat: str, lon: str, resolution: int) -> str:
    return f"(SELECT h FROM hex{resolution} x WHERE x.lat = {lat} AND x.lon = {lon})"


LATE = "coalesce(abs(date_diff('second', event_ts, ingest_ts)) > 25400, FALSE)"
DAY = "CAST(date_trunc('day', event_ts) AS TIMESTAMP)"
HAVERSINE_FENCE = km("p.lat", "p.lon", "f.latitude", "f.longitude")

# ---- building blocks -------------------------------------------------------------------------

BLOCKS["timed"] = (
    "SELECT *, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS sec,"
    " CAST(json_extract_string(props, '$.k') AS INT) AS k, "
    f"{ev.FENCE_NO} AS fence_no FROM events"
)
BLOCKS["copies"] = (
    f"SELECT t.*, c.copy_no, {ev.LOAD} AS load, {ev.SPEED} AS speed FROM timed t, (VALUES (0), (1)) c(copy_no)"
    " WHERE c.copy_no = 0 OR t.event_id % 20 = 0"
)
def seven(number: str) -> str:
    """Seven digits at least, written with printf: longer numbers are not cut."""
    return f"printf('%07d', {number})"


# Keys and names are stated anew; the sensor formulas are the definition of the synthetic data.
OWN_FIELDS = {
    "vehicle_id": f"'VH_' || {seven('user_id')}",
    "device_id": f"'DEV_' || {seven('user_id')}",
    "customer_id": (
        "CASE WHEN user_id % 50 = 17 AND event_id % 3 = 0 THEN 'CUST_9999'"
        " ELSE printf('CUST_%04d', user_id % 20 + 1) END"
    ),
}
BLOCKS["raw"] = (
    f"SELECT {ev.OFFSET} AS offs, user_id % 10 AS part_no, event_id, "
    + ", ".join(f"{OWN_FIELDS.get(n, ev.FIELDS[n])} AS {n}" for n in schema.names(schema.ALL_FIELDS))
    + ", ts + to_seconds((event_id * 7919) % 50000 + copy_no * 3600) AS ingest_ts FROM copies"
)
BLOCKS["reading"] = (
    "SELECT * FROM raw QUALIFY row_number() OVER"
    " (PARTITION BY vehicle_id, event_ts ORDER BY ingest_ts DESC, offs DESC) = 1"
)
BLOCKS["fence"] = f"""
SELECT 'GF_' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geofence_id, n_name AS city_name,
  {ev.FENCE_LAT.format(n='n_nationkey')} AS latitude, {ev.FENCE_LON.format(n='n_nationkey')} AS longitude,
  15e0 AS radius_km FROM nation"""
BLOCKS["policy"] = f"""
SELECT 'CUST_' || CASE WHEN c_custkey < 10000 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0')
    ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
  'Customer ' || c_custkey AS customer_name,
  CAST([90, 120, 180][CAST(c_custkey % 3 + 1 AS INT)] AS BIGINT) AS raw_retention_days,
  CAST([365, 730][CAST(c_custkey % 2 + 1 AS INT)] AS BIGINT) AS curated_retention_days,
  CAST(730 AS BIGINT) AS trip_retention_days,
  CAST([30, 30, 60][CAST(c_custkey % 3 + 1 AS INT)] AS BIGINT) AS video_retention_days,
  TRUE AS tenant_isolation_enabled, TIMESTAMP '{AS_OF}' AS created_at FROM customer"""
BLOCKS["waypoint"] = f"""
SELECT s_suppkey % 25 AS route, s_suppkey // 25 AS idx,
  {ev.FENCE_LAT.format(n='(s_suppkey % 25)')} + ((s_suppkey * 131) % 200 - 100) / 1024e0 AS lat,
  {ev.FENCE_LON.format(n='(s_suppkey % 25)')} + ((s_suppkey * 71) % 200 - 100) / 1024e0 AS lon FROM supplier"""
BLOCKS["segment"] = f"""
SELECT 'ROUTE_' || lpad(CAST(route AS VARCHAR), 2, '0') || '_S' || CASE WHEN idx < 1000
    THEN lpad(CAST(idx AS VARCHAR), 3, '0') ELSE CAST(idx AS VARCHAR) END AS segment_id,
  'ROUTE_' || lpad(CAST(route AS VARCHAR), 2, '0') AS route_name, 'NH' || (route + 1) AS highway,
  'NATION_' || route AS from_city, 'NATION_' || ((route + 1) % 25) AS to_city, CAST(idx AS BIGINT) AS waypoint_idx,
  lat AS start_lat, lon AS start_lon, end_lat, end_lon, (lat + end_lat) / 2 AS mid_lat, (lon + end_lon) / 2 AS mid_lon,
  {rnd(km('lat', 'lon', 'end_lat', 'end_lon'), 2)} AS segment_km
FROM (SELECT *, lead(lat) OVER w AS end_lat, lead(lon) OVER w AS end_lon FROM waypoint
      WINDOW w AS (PARTITION BY route ORDER BY idx)) WHERE end_lat IS NOT NULL"""


def _grown(column: str) -> str:
    return rnd(f"max({column}) - min({column})", 2)


BLOCKS["daily"] = f"""
SELECT customer_id, vehicle_id, {DAY} AS metric_date, count(*) AS total_readings,
  {rnd('avg(j1939_vehicle_speed_kph)', 1)} AS avg_speed_kph, {rnd('max(j1939_vehicle_speed_kph)', 1)} AS max_speed_kph,
  {rnd('avg(j1939_engine_rpm)', 0)} AS avg_engine_rpm, {rnd('max(j1939_engine_rpm)', 0)} AS max_engine_rpm,
  {rnd('avg(j1939_engine_load_pct)', 1)} AS avg_engine_load_pct, {rnd('avg(j1939_fuel_rate_lph)', 2)} AS avg_fuel_rate_lph,
  {_grown('j1939_total_fuel_used_l')} AS daily_fuel_consumed_l, {_grown('j1939_odometer_km')} AS daily_distance_km,
  {rnd('avg(j1939_coolant_temp_c)', 1)} AS avg_coolant_temp_c, {rnd('max(j1939_coolant_temp_c)', 1)} AS max_coolant_temp_c,
  {rnd('avg(j1939_battery_voltage_v)', 2)} AS avg_battery_v, {_grown('j1939_engine_hours')} AS daily_engine_hours,
  {n_if('j1939_brake_switch')} AS brake_events, max(j1939_active_dtc_count) AS max_dtc_count,
  {rnd('avg(j1939_tyre_pressure_front_left_kpa)', 1)} AS avg_tyre_fl_kpa,
  {rnd('avg(j1939_tyre_pressure_front_right_kpa)', 1)} AS avg_tyre_fr_kpa,
  {rnd('avg(j1939_tyre_pressure_rear_left_kpa)', 1)} AS avg_tyre_rl_kpa,
  {rnd('avg(j1939_tyre_pressure_rear_right_kpa)', 1)} AS avg_tyre_rr_kpa,
  {rnd('avg(j1939_def_level_pct)', 1)} AS avg_def_level_pct
FROM reading GROUP BY customer_id, vehicle_id, {DAY}"""
BLOCKS["fleetday"] = f"""
SELECT customer_id, {DAY} AS metric_date, count(DISTINCT vehicle_id) AS active_vehicles, count(*) AS total_readings,
  {rnd('avg(j1939_vehicle_speed_kph)', 1)} AS fleet_avg_speed_kph, {rnd('avg(j1939_fuel_rate_lph)', 2)} AS fleet_avg_fuel_rate_lph,
  {rnd('sum(coalesce(j1939_total_fuel_used_l, 0e0))', 0)} AS fleet_total_fuel_l,
  {rnd('avg(j1939_engine_load_pct)', 1)} AS fleet_avg_engine_load_pct,
  {rnd('avg(j1939_coolant_temp_c)', 1)} AS fleet_avg_coolant_temp_c, {n_if('j1939_active_dtc_count > 0')} AS readings_with_dtc,
  {rnd('avg(j1939_battery_voltage_v)', 2)} AS fleet_avg_battery_v, {n_if('j1939_brake_switch')} AS fleet_brake_events,
  {rnd('avg(j1939_tyre_pressure_front_left_kpa)', 1)} AS fleet_avg_tyre_fl_kpa,
  {rnd('avg(j1939_def_level_pct)', 1)} AS fleet_avg_def_level_pct
FROM reading GROUP BY customer_id, {DAY}"""
BLOCKS["vehicle"] = """
SELECT r.vehicle_id, r.customer_id, r.device_id, p.customer_name, p.raw_retention_days, p.curated_retention_days,
  p.trip_retention_days, p.tenant_isolation_enabled, min(event_ts) AS first_seen_ts, max(event_ts) AS last_seen_ts,
  count(*) AS total_gps_events
FROM reading r LEFT JOIN policy p ON p.customer_id = r.customer_id GROUP BY ALL"""
BLOCKS["custdim"] = f"""
SELECT p.*, f.fleet_size, f.active_vehicles, f.total_events FROM policy p LEFT JOIN (
  SELECT customer_id, count(DISTINCT vehicle_id) AS fleet_size,
    count(DISTINCT vehicle_id) FILTER (event_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY) AS active_vehicles,
    count(*) AS total_events FROM reading GROUP BY customer_id) f ON f.customer_id = p.customer_id"""


def device_health(healthy: str) -> str:
    return f"""
SELECT vehicle_id, avg(tel_gsm_signal_dbm) AS avg_gsm_signal_dbm, max(tel_storage_queue_depth) AS max_queue_depth,
  bool_and(coalesce(tel_can_bus_health IN ({healthy}), FALSE)) AS all_can_healthy,
  bool_or(coalesce(tel_tamper_alert, FALSE)) AS has_tamper_alert FROM reading GROUP BY vehicle_id"""


BLOCKS["devicehealth"] = device_health("'OK', 'HEALTHY'")
BLOCKS["devicestrict"] = device_health("'HEALTHY'")
STATUS_CASE = (
    "CASE WHEN {dtc} > 5 OR {tamper} THEN 'CRITICAL' WHEN {dtc} > 2 OR NOT {can} THEN 'WARNING'"
    " WHEN {cool} > 105 OR {volt} < 22 THEN 'ALERT' ELSE 'HEALTHY' END"
)


def vehicle_health(device_block: str) -> str:
    status = STATUS_CASE.format(
        dtc="dtc", tamper="has_tamper_alert", can="all_can_healthy", cool="coolant", volt="battery"
    )
    return f"""
SELECT customer_id, e.vehicle_id, device_id, last_event_ts,
  date_diff('minute', last_event_ts, TIMESTAMP '{AS_OF}') AS minutes_since_last_event, dtc AS max_dtc_count,
  NOT all_can_healthy AS has_can_bus_issues, has_tamper_alert, {rnd('coolant', 1)} AS max_coolant_temp_c,
  {rnd('battery', 1)} AS min_battery_voltage_v, {rnd('avg_gsm_signal_dbm', 1)} AS avg_gsm_signal_dbm, max_queue_depth,
  {rnd('odometer', 0)} AS current_odometer_km, {rnd('hours', 0)} AS current_engine_hours, {status} AS health_status
FROM (SELECT customer_id, vehicle_id, device_id, max(event_ts) AS last_event_ts,
        coalesce(max(j1939_active_dtc_count), 0) AS dtc, max(j1939_coolant_temp_c) AS coolant,
        min(j1939_battery_voltage_v) AS battery, max(j1939_odometer_km) AS odometer, max(j1939_engine_hours) AS hours
      FROM reading GROUP BY ALL) e LEFT JOIN {device_block} d ON d.vehicle_id = e.vehicle_id"""


BLOCKS["health"] = vehicle_health("devicehealth")
BLOCKS["healthstrict"] = vehicle_health("devicestrict")

# Trips, by the plain route: number the ON rows, take spans, join readings by time.
BLOCKS["ignition"] = """
SELECT customer_id, vehicle_id, event_ts, tel_ignition_status,
  CAST(coalesce(tel_ignition_status = 'ON' AND coalesce(lag(tel_ignition_status)
    OVER (PARTITION BY vehicle_id ORDER BY event_ts), 'OFF') = 'OFF', FALSE) AS BIGINT) AS trip_start_flag FROM reading"""
BLOCKS["onrow"] = """
SELECT *, CAST(sum(trip_start_flag) OVER (PARTITION BY vehicle_id ORDER BY event_ts) AS BIGINT) AS trip_num
FROM ignition WHERE tel_ignition_status = 'ON'"""
BLOCKS["span"] = """
SELECT customer_id, vehicle_id, trip_num, min(event_ts) AS trip_start_ts, max(event_ts) AS trip_end_ts
FROM onrow WHERE trip_num > 0 GROUP BY ALL"""
BLOCKS["inside"] = """
SELECT s.customer_id AS span_customer, s.trip_num, s.trip_start_ts, s.trip_end_ts, r.*
FROM span s JOIN reading r ON r.vehicle_id = s.vehicle_id AND r.event_ts BETWEEN s.trip_start_ts AND s.trip_end_ts"""


def end_city(moment: str) -> str:
    return f"""
SELECT p.vehicle_id, p.trip_num, f.city_name FROM (
  SELECT s.vehicle_id, s.trip_num, r.gps_latitude AS lat, r.gps_longitude AS lon
  FROM span s JOIN reading r ON r.vehicle_id = s.vehicle_id AND r.event_ts = s.{moment}) p
JOIN fence f ON {HAVERSINE_FENCE} <= f.radius_km
QUALIFY row_number() OVER (PARTITION BY p.vehicle_id, p.trip_num ORDER BY {HAVERSINE_FENCE}, f.geofence_id) = 1"""


BLOCKS["startcity"] = end_city("trip_start_ts")
BLOCKS["endcity"] = end_city("trip_end_ts")
BLOCKS["tripsum"] = """
SELECT vehicle_id, trip_num, first(span_customer ORDER BY event_ts) AS customer_id,
  min(trip_start_ts) AS trip_start_ts, first(trip_end_ts ORDER BY event_ts) AS trip_end_ts,
  first(gps_latitude ORDER BY event_ts) AS start_lat, first(gps_longitude ORDER BY event_ts) AS start_lon,
  last(gps_latitude ORDER BY event_ts) AS end_lat, last(gps_longitude ORDER BY event_ts) AS end_lon,
  max(j1939_odometer_km) - min(j1939_odometer_km) AS dist, max(j1939_total_fuel_used_l) - min(j1939_total_fuel_used_l) AS fuel,
  avg(j1939_vehicle_speed_kph) AS speed, max(j1939_vehicle_speed_kph) AS top, avg(j1939_engine_rpm) AS rpm,
  avg(j1939_engine_load_pct) AS load FROM inside GROUP BY vehicle_id, trip_num"""
BLOCKS["trip"] = f"""
SELECT t.customer_id, t.vehicle_id, t.trip_num, trip_start_ts, trip_end_ts,
  date_diff('second', trip_start_ts, trip_end_ts) AS duration_sec,
  {rnd("date_diff('second', trip_start_ts, trip_end_ts) / 60e0", 1)} AS duration_min,
  start_lat, start_lon, end_lat, end_lon, {rnd('dist', 2)} AS distance_km, {rnd('fuel', 2)} AS fuel_consumed_l,
  CASE WHEN dist > 0 THEN {rnd('fuel / dist * 100', 2)} END AS fuel_efficiency_l_per_100km,
  {rnd('speed', 1)} AS avg_speed_kph, {rnd('top', 1)} AS max_speed_kph, {rnd('rpm', 0)} AS avg_engine_rpm,
  {rnd('load', 1)} AS avg_engine_load_pct, a.city_name AS start_geofence, z.city_name AS end_geofence
FROM tripsum t LEFT JOIN startcity a ON a.vehicle_id = t.vehicle_id AND a.trip_num = t.trip_num
LEFT JOIN endcity z ON z.vehicle_id = t.vehicle_id AND z.trip_num = t.trip_num"""
BLOCKS["score"] = f"""
SELECT t.customer_id, t.vehicle_id, count(*) AS total_trips, {rnd(avg_exact('fuel_efficiency_l_per_100km'), 2)} AS avg_fuel_eff,
  {rnd(avg_exact('avg_speed_kph'), 1)} AS avg_speed, {rnd('max(max_speed_kph)', 1)} AS top_speed,
  {rnd(sum_exact('distance_km'), 1)} AS total_km, {rnd(sum_exact('fuel_consumed_l'), 1)} AS total_fuel_l,
  h.health_status, h.max_dtc_count,
  CASE WHEN {avg_exact('fuel_efficiency_l_per_100km')} < 25 AND h.max_dtc_count = 0 THEN 'A - Excellent'
    WHEN {avg_exact('fuel_efficiency_l_per_100km')} < 35 AND h.max_dtc_count <= 1 THEN 'B - Good'
    WHEN {avg_exact('fuel_efficiency_l_per_100km')} < 45 THEN 'C - Needs Improvement' ELSE 'D - At Risk' END AS driver_grade
FROM trip t LEFT JOIN health h ON h.vehicle_id = t.vehicle_id AND h.customer_id = t.customer_id
GROUP BY t.customer_id, t.vehicle_id, h.health_status, h.max_dtc_count"""
BLOCKS["alert"] = f"""
SELECT customer_id, vehicle_id, trip_num, trip_start_ts, start_geofence, end_geofence,
  {rnd('max_speed_kph', 1)} AS max_speed_kph, {rnd('avg_speed_kph', 1)} AS avg_speed_kph,
  {rnd('distance_km', 1)} AS distance_km, {rnd('duration_min', 1)} AS duration_min,
  CASE WHEN trip.max_speed_kph > 100 THEN 'CRITICAL' WHEN trip.max_speed_kph > 80 THEN 'HIGH' ELSE 'MODERATE' END
    AS speed_alert_level FROM trip WHERE trip.max_speed_kph > 60"""
BLOCKS["v360"] = """
SELECT v.vehicle_id, v.customer_id, v.device_id, v.customer_name, v.first_seen_ts, v.last_seen_ts, v.total_gps_events,
  d.* EXCLUDE (customer_id, vehicle_id, max_engine_rpm), CASE WHEN daily_distance_km > 0 THEN """ + rnd(
    "daily_fuel_consumed_l / daily_distance_km * 100", 2
) + """ END AS fuel_efficiency_l_per_100km FROM vehicle v LEFT JOIN daily d ON d.vehicle_id = v.vehicle_id"""
BLOCKS["fstatus"] = f"""
SELECT vehicle_id, first(customer_id ORDER BY event_ts DESC) AS customer_id, max(event_ts) AS last_event_ts,
  first(gps_latitude ORDER BY event_ts DESC) AS latest_lat, first(gps_longitude ORDER BY event_ts DESC) AS latest_lon,
  {rnd('avg(gps_speed_kph)', 1)} AS avg_speed_kph, {rnd('max(gps_speed_kph)', 1)} AS max_speed_kph,
  first(tel_ignition_status ORDER BY event_ts DESC) AS ignition_status,
  {STATUS_CASE.format(dtc='coalesce(max(j1939_active_dtc_count), 0)', tamper='bool_or(tel_tamper_alert)',
                      can="bool_and(tel_can_bus_health IN ('OK', 'HEALTHY'))", cool='max(j1939_coolant_temp_c)',
                      volt='min(j1939_battery_voltage_v)')} AS health_status,
  coalesce(max(j1939_active_dtc_count), 0) AS max_dtc_count,
  first(tel_can_bus_health ORDER BY event_ts DESC) AS can_bus_health FROM reading GROUP BY vehicle_id"""
BLOCKS["registry"] = """
SELECT v.customer_id, v.customer_name, v.vehicle_id, v.device_id, v.first_seen_ts, v.last_seen_ts, v.total_gps_events,
  p.raw_retention_days, p.tenant_isolation_enabled,
  'driver_' || lower(replace(v.vehicle_id, 'VH_', '')) || '@fleet.example' AS driver_email
FROM vehicle v JOIN policy p ON p.customer_id = v.customer_id"""
BLOCKS["profile"] = """
SELECT printf('D-%07d', c_custkey) AS driver_id, c_name AS driver_name, printf('+91-98%07d', c_custkey) AS phone,
  printf('DL-%07d', c_custkey) AS license_no, printf('VIN%07d', c_custkey) AS vin, r_name AS dealer_region
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""
BLOCKS["hexpoint"] = """
SELECT DISTINCT lat, lon FROM (SELECT gps_latitude AS lat, gps_longitude AS lon FROM reading
  UNION ALL SELECT latitude, longitude FROM fence UNION ALL SELECT start_lat, start_lon FROM segment
  UNION ALL SELECT end_lat, end_lon FROM segment UNION ALL SELECT mid_lat, mid_lon FROM segment)
WHERE lat IS NOT NULL AND lon IS NOT NULL"""
# No point of the data lies in a pentagon, so the missing direction never has to be closed here.
BLOCKS["hex7"], BLOCKS["hex9"] = hexes(7), hexes(9)
BLOCKS["onroad"] = f"""
SELECT r.*, s.segment_id, s.route_name, s.highway, s.from_city, s.to_city, s.segment_km
FROM reading r JOIN hex7 x ON x.lat = r.gps_latitude AND x.lon = r.gps_longitude
JOIN (SELECT s.*, m.h FROM segment s JOIN hex7 m ON m.lat = s.mid_lat AND m.lon = s.mid_lon) s ON s.h = x.h"""
BLOCKS["message"] = """
SELECT *, CASE WHEN offs % 86 = 4 THEN 'message is not a JSON object' WHEN offs % 86 = 8 THEN 'record_content is missing'
  WHEN offs % 86 = 12 THEN 'record_content has no vehicle_id'
  WHEN offs % 86 = 16 THEN 'unreadable value in gps_altitude_m: high' END AS error FROM raw"""
BLOCKS["judged"] = f"""
SELECT r.*, coalesce(r.event_ts < TIMESTAMP '{RETENTION_AS_OF}' - to_days(CAST(p.raw_retention_days AS INT)), FALSE) AS gone
FROM raw r LEFT JOIN policy p ON p.customer_id = r.customer_id"""
BLOCKS["fencedist"] = """
SELECT r.vehicle_id, r.event_ts, r.gps_latitude AS la, r.gps_longitude AS lo, f.latitude AS fa, f.longitude AS fo,
  f.radius_km FROM reading r JOIN fence f ON f.geofence_id = 'GF_' || lpad(CAST(r.event_id % 25 AS VARCHAR), 2, '0')"""
BLOCKS["lexicon"] = "SELECT * FROM (VALUES " + ", ".join(
    "('{}', {}e0)".format(*line.split()) for line in LEXICON.strip().splitlines()
) + ") l(word, score)"
BLOCKS["token"] = """
SELECT doc_id, lower(unnest(regexp_extract_all(text, '\\p{L}[\\p{L}\\p{M}]*'))) AS word FROM documents"""
BLOCKS["sentence"] = r"""
SELECT doc_id, pos - 1 AS pos, trim(parts[pos]) AS sentence,
  list_transform(regexp_extract_all(parts[pos], '\p{L}[\p{L}\p{M}]*'), lambda w: lower(w)) AS ws
FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos
      FROM (SELECT doc_id, string_split_regex(text, '[.!?\n]+') AS parts FROM documents))"""


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in BLOCKS:
        if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
            _needed(BLOCKS[name], found)
            found.append(name)
    return found


def _sql(body: str) -> str:
    names = _needed(body, [])
    blocks = ",\n".join(f"{name} AS ({BLOCKS[name].strip()})" for name in names)
    return f"WITH {blocks}\n{body.strip()}" if names else body.strip()


BODIES: dict[str, str] = {}

# ---- sources and ingestion -----------------------------------------------------------------

ALL = ", ".join(schema.names(schema.ALL_FIELDS))
PHASE = "CASE WHEN ingest_ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'phase 1' ELSE 'phase 2' END"
BODIES["flatten_event"] = f"""
SELECT offs AS "offset", CASE WHEN offs % 86 = 32 THEN '{{"headers":{{"a":[1,"x"]}},"push time":7}}' END AS other_metadata,
  {ALL}, ingest_ts FROM message WHERE error IS NULL"""
LETTER = "error AS error_message, 'VEHICLE_TELEMETRY' AS source_topic, part_no AS source_partition, ingest_ts AS dlq_ingest_ts"
BODIES["dlq_split"] = f"SELECT {LETTER} FROM message WHERE error IS NOT NULL"
BODIES["dlq_by_key"] = f"""
SELECT {LETTER}, CASE WHEN offs % 86 <> 4 THEN vehicle_id END AS vehicle_key FROM message WHERE error IS NOT NULL
ORDER BY dlq_ingest_ts, vehicle_key NULLS FIRST, error_message, source_partition LIMIT 10"""
BODIES["ingest_stream"] = """
SELECT customer_id, count(*) AS landed FROM message WHERE error IS NULL GROUP BY customer_id
UNION ALL SELECT '(dead letters)', count(*) FROM message WHERE error IS NOT NULL"""
BODIES["ingest_stream_audit"] = f"""
SELECT count(*) AS produced, {n_if('error IS NULL')} AS landed, {n_if('error IS NOT NULL')} AS dead,
  {rnd(f"{n_if('error IS NULL')} * 100.0 / count(*)", 2)} AS landed_pct FROM message"""
BODIES["ingest_defaults"] = f"""
SELECT offs AS "offset", vehicle_id, event_ts, CASE WHEN offs % 7 = 3 THEN TIMESTAMP '{AS_OF}' ELSE ingest_ts END AS ingest_ts
FROM message WHERE error IS NULL"""
BODIES["schema_evolution"] = """
SELECT vehicle_id, count(*) AS total,
  count(j1939_tyre_pressure_front_left_kpa) FILTER (ingest_ts >= TIMESTAMP '2024-01-16 00:00:00') AS evolved,
  count(j1939_def_level_pct) FILTER (ingest_ts >= TIMESTAMP '2024-01-16 00:00:00') AS with_def_level
FROM raw GROUP BY vehicle_id"""
EVOLVED = {
    n: f"CASE WHEN ingest_ts >= TIMESTAMP '2024-01-16 00:00:00' THEN {n} END AS {n}"
    for n in schema.names(schema.EVOLVED_FIELDS)
}
BODIES["evolved_table"] = (
    'SELECT offs AS "offset", '
    + ", ".join(EVOLVED.get(n, n) for n in schema.names(schema.ALL_FIELDS))
    + ", ingest_ts FROM raw"
)
BODIES["evolution_coverage"] = (
    "SELECT count(*) AS total, count(j1939_tyre_pressure_front_left_kpa) AS evolved FROM raw"
)
BODIES["ingest_audit"] = f"""
SELECT {PHASE} AS phase, count(*) AS produced, {n_if('error IS NULL')} AS ingested, count(error) AS dead_letters,
  {rnd(n_if('error IS NULL') + ' * 100e0 / count(*)', 1)} AS ingested_pct FROM message GROUP BY 1"""
BODIES["partition_skew"] = """
SELECT (hi * 6 + lo) % 10 AS "partition", count(*) AS messages, count(DISTINCT vehicle_id) AS vehicles FROM (
  SELECT vehicle_id, CAST(CAST('0x' || md5(vehicle_id)[1:16] AS UBIGINT) % 10 AS BIGINT) AS hi,
    CAST(CAST('0x' || md5(vehicle_id)[17:32] AS UBIGINT) % 10 AS BIGINT) AS lo FROM raw) GROUP BY 1"""
BODIES["load_segments"] = "SELECT * FROM segment"
BODIES["segments_enriched"] = f"""
SELECT *, {hexed('start_lat', 'start_lon', 7)} AS cell_start_res7, {hexed('end_lat', 'end_lon', 7)} AS cell_end_res7,
  {hexed('mid_lat', 'mid_lon', 7)} AS cell_mid_res7, {hexed('mid_lat', 'mid_lon', 9)} AS cell_mid_res9 FROM segment"""
BODIES["retention_policies"] = "SELECT * FROM policy"
BODIES["geofences"] = f"""
SELECT *, 'CITY_BOUNDARY' AS geofence_type, {hexed('latitude', 'longitude', 7)} AS cell_center_res7,
  {hexed('latitude', 'longitude', 9)} AS cell_center_res9, TRUE AS is_active FROM fence"""
BODIES["refresh_incremental"] = BODIES["stream_daily_metrics"] = BODIES["fact_vehicle_daily"] = "SELECT * FROM daily"

# ---- curated -----------------------------------------------------------------------------------

KEYS = ", ".join(schema.SIGNAL_KEYS)
BODIES["raw_count"] = "SELECT count(*) AS raw_row_count FROM raw"
for _signal, _columns in schema.SIGNALS.items():
    BODIES[f"{_signal}_signals"] = f"SELECT {KEYS}, {', '.join(_columns)}, {LATE} AS arrived_late FROM reading"
BODIES["arrived_late"] = f"SELECT vehicle_id, event_ts, ingest_ts, {LATE} AS arrived_late FROM raw"
BODIES["dedup_latest"] = f'SELECT {KEYS}, gps_speed_kph, offs AS "offset" FROM reading'
BODIES["stream_dedup"] = f"SELECT {KEYS}, gps_speed_kph FROM reading"
BODIES["late_counts"] = f"SELECT {LATE} AS arrived_late, count(*) AS event_count FROM raw GROUP BY 1"
BODIES["late_distribution"] = f"""
SELECT {LATE} AS arrived_late, count(*) AS event_count,
  {rnd('count(*) * 100e0 / sum(count(*)) OVER ()', 1)} AS pct FROM reading GROUP BY 1"""
BODIES["stream_late_counts"] = f"""
SELECT {DAY} AS metric_date, {LATE} AS arrived_late, count(*) AS event_count FROM raw GROUP BY 1, 2"""
BODIES["raw_preview"] = """
SELECT event_ts, customer_id, vehicle_id, gps_latitude, gps_longitude, gps_speed_kph, j1939_engine_rpm, j1939_fuel_rate_lph,
  j1939_coolant_temp_c, j1939_active_dtc_count, tel_ignition_status, tel_can_bus_health FROM raw
ORDER BY event_ts, vehicle_id, gps_speed_kph LIMIT 20"""
BODIES["on_time_gps"] = f"""
SELECT event_ts, vehicle_id, gps_latitude, gps_longitude, gps_speed_kph, gps_heading_deg, gps_satellite_count,
  FALSE AS arrived_late FROM raw WHERE NOT {LATE}"""
BODIES["high_rpm"] = """
SELECT event_ts, vehicle_id, j1939_engine_rpm, j1939_engine_load_pct, j1939_fuel_rate_lph, j1939_coolant_temp_c,
  j1939_battery_voltage_v, j1939_active_dtc_count, j1939_brake_switch FROM raw WHERE j1939_engine_rpm > 2000"""
BODIES["harsh_driving"] = f"""
SELECT event_ts, vehicle_id, {', '.join(schema.SIGNALS['imu'])} FROM raw WHERE imu_accel_x_g > 0.3 OR imu_accel_x_g < -0.3"""
BODIES["device_faults"] = """
SELECT event_ts, vehicle_id, tel_ignition_status, tel_external_power_v, tel_gsm_signal_dbm, tel_network_type,
  tel_can_bus_health, tel_tamper_alert FROM raw WHERE tel_can_bus_health <> 'OK' OR tel_tamper_alert"""
ONE = f"vehicle_id = '{TRACKED_VEHICLE}'"
BODIES["track_raw"] = f"""
SELECT event_ts, vehicle_id, customer_id, gps_latitude, gps_longitude, gps_speed_kph, j1939_engine_rpm, j1939_fuel_rate_lph,
  j1939_coolant_temp_c, tel_ignition_status, ingest_ts FROM raw WHERE {ONE} ORDER BY event_ts, ingest_ts LIMIT 20"""
BODIES["track_gps"] = f"""
SELECT event_ts, vehicle_id, gps_latitude, gps_longitude, gps_speed_kph, gps_heading_deg, {LATE} AS arrived_late
FROM raw WHERE {ONE} ORDER BY event_ts, ingest_ts LIMIT 20"""
BODIES["track_j1939"] = f"""
SELECT event_ts, vehicle_id, j1939_engine_rpm, j1939_fuel_rate_lph, j1939_coolant_temp_c, j1939_active_dtc_count,
  j1939_odometer_km FROM raw WHERE {ONE} ORDER BY event_ts, ingest_ts LIMIT 20"""
BODIES["track_trips"] = f"""
SELECT vehicle_id, trip_num, trip_start_ts, trip_end_ts, duration_min AS mins, {rnd('distance_km', 1)} AS km,
  {rnd('fuel_consumed_l', 1)} AS fuel_l, fuel_efficiency_l_per_100km AS fuel_eff, start_geofence, end_geofence
FROM trip WHERE {ONE}"""
BODIES["track_health"] = f"""
SELECT vehicle_id, health_status, max_dtc_count, has_can_bus_issues, max_coolant_temp_c AS max_coolant_c,
  current_odometer_km AS odometer_km FROM health WHERE {ONE}"""
BODIES["fleet_stats"] = """
SELECT count(DISTINCT customer_id) AS customers, count(DISTINCT vehicle_id) AS vehicles, count(DISTINCT device_id) AS devices,
  min(event_ts) AS earliest_event, max(event_ts) AS latest_event FROM raw"""

# ---- facts, dimensions, health, 360 --------------------------------------------------------------

BODIES["fact_customer_fleet"] = "SELECT * FROM fleetday"
BODIES["dim_vehicle"] = "SELECT * FROM vehicle"
BODIES["dim_customer"] = "SELECT * FROM custdim"
BODIES["telematics_health"] = "SELECT * FROM devicehealth"
BODIES["fleet_health"] = "SELECT * FROM health"
BODIES["fleet_health_strict"] = "SELECT * FROM healthstrict"
BODIES["vehicle360"] = "SELECT * FROM v360"
BODIES["customer360"] = """
SELECT c.customer_id, c.customer_name, c.fleet_size, c.active_vehicles, c.total_events, c.raw_retention_days,
  c.curated_retention_days, c.trip_retention_days, c.tenant_isolation_enabled, f.metric_date,
  f.active_vehicles AS daily_active_vehicles, f.total_readings AS daily_readings,
  f.* EXCLUDE (customer_id, metric_date, active_vehicles, total_readings)
FROM custdim c LEFT JOIN fleetday f ON f.customer_id = c.customer_id"""
BODIES["realtime_fleet_status"] = "SELECT * FROM fstatus"
BODIES["stream_fleet_status"] = "SELECT * FROM fstatus"
BODIES["fuel_efficiency"] = "SELECT vehicle_id, customer_id, metric_date, fuel_efficiency_l_per_100km FROM v360"
BODIES["at_risk_vehicles"] = """
SELECT vehicle_id, customer_id, health_status, minutes_since_last_event, max_dtc_count, has_can_bus_issues, has_tamper_alert,
  max_coolant_temp_c AS max_coolant_c, min_battery_voltage_v AS min_battery_v, current_odometer_km AS odometer_km
FROM health WHERE health_status = 'WARNING' OR health_status = 'CRITICAL'
ORDER BY health_status, max_dtc_count DESC NULLS FIRST, vehicle_id, customer_id LIMIT 20"""
BODIES["health_breakdown"] = "SELECT health_status, count(*) AS vehicle_count FROM health GROUP BY 1"
BODIES["health_cards"] = f"""
SELECT {n_if("health_status = 'HEALTHY'")} AS healthy, {n_if("health_status = 'WARNING'")} AS warning,
  {n_if("health_status = 'CRITICAL'")} AS critical, {n_if('has_can_bus_issues')} AS can_bus_issues,
  {rnd(avg_exact('avg_gsm_signal_dbm'), 1)} AS avg_gsm_signal_dbm FROM health"""
BODIES["health_scatter"] = "SELECT vehicle_id, max_coolant_temp_c, min_battery_voltage_v, health_status FROM health"
BODIES["status_breakdown"] = (
    "SELECT health_status, ignition_status, count(*) AS vehicle_count FROM fstatus GROUP BY 1, 2"
)
BODIES["dtc_histogram"] = "SELECT max_dtc_count, count(*) AS vehicles FROM health WHERE max_dtc_count > 0 GROUP BY 1"


def box(table: str, group: str, value: str) -> str:
    points = {"min_value": 0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max_value": 1}
    columns = ", ".join(f"{rnd(f'quantile_cont({value}, {p})', 4)} AS {name}" for name, p in points.items())
    return f"SELECT {group}, count({value}) AS n, {columns} FROM {table} GROUP BY {group}"


BODIES["odometer_quantiles"] = box("health", "health_status", "current_odometer_km")
BODIES["speed_quantiles"] = box("alert", "speed_alert_level", "max_speed_kph")
BODIES["top_fuel_days"] = f"""
SELECT vehicle_id, metric_date, total_readings, avg_speed_kph AS avg_speed, max_speed_kph AS max_speed,
  {rnd('daily_fuel_consumed_l', 1)} AS fuel_l, {rnd('daily_distance_km', 1)} AS distance_km, brake_events, max_dtc_count
FROM daily ORDER BY daily_fuel_consumed_l DESC NULLS FIRST, vehicle_id, metric_date, customer_id LIMIT 20"""
BODIES["top_customers"] = """
SELECT c.customer_id, c.customer_name, c.fleet_size, c.active_vehicles, c.total_events, f.fleet_avg_speed_kph AS avg_speed,
  f.fleet_total_fuel_l AS total_fuel_l, f.fleet_brake_events, f.readings_with_dtc, f.fleet_avg_coolant_temp_c AS avg_coolant_c
FROM custdim c LEFT JOIN fleetday f ON f.customer_id = c.customer_id
ORDER BY c.fleet_size DESC NULLS LAST, c.customer_id, f.metric_date NULLS FIRST LIMIT 10"""
BODIES["top_vehicles"] = """
SELECT vehicle_id, customer_id, device_id, customer_name, first_seen_ts, last_seen_ts, total_gps_events FROM vehicle
ORDER BY total_gps_events DESC, vehicle_id, customer_id LIMIT 20"""

# ---- trips and place -------------------------------------------------------------------------------

BODIES["ignition_transitions"] = "SELECT * FROM ignition"
BODIES["trip_groups"] = "SELECT * FROM onrow"
BODIES["trip_boundaries"] = "SELECT * FROM span"
BODIES["trip_endpoints"] = "SELECT vehicle_id, trip_num, start_lat, start_lon, end_lat, end_lon FROM tripsum"
BODIES["trip_summaries"] = BODIES["stream_trips"] = "SELECT * FROM trip"
BODIES["interval_join_trips"] = """
SELECT span_customer AS trip_customer_id, vehicle_id, trip_num, count(*) AS readings, sum(j1939_vehicle_speed_kph) AS speed_sum,
  max(j1939_engine_rpm) AS max_rpm FROM inside GROUP BY ALL"""
BODIES["geofence_match"] = f"""
SELECT vehicle_id, event_ts, geofence_id, city_name, {rnd('dist', 6)} AS distance_km FROM (
  SELECT p.vehicle_id, p.event_ts, f.geofence_id, f.city_name, {HAVERSINE_FENCE} AS dist
  FROM (SELECT vehicle_id, event_ts, gps_latitude AS lat, gps_longitude AS lon FROM reading) p
  JOIN fence f ON {HAVERSINE_FENCE} <= f.radius_km)
QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_ts ORDER BY dist, geofence_id) = 1"""
BODIES["signal_align"] = """
SELECT g.vehicle_id, g.event_ts, g.gps_latitude, g.gps_longitude, g.gps_speed_kph, j.j1939_fuel_rate_lph, j.j1939_engine_rpm
FROM reading g JOIN reading j ON j.vehicle_id = g.vehicle_id AND j.event_ts = g.event_ts"""
BODIES["road_segment_join"] = """
SELECT vehicle_id, customer_id, event_ts, gps_latitude, gps_longitude, segment_id, route_name, highway, from_city, to_city,
  segment_km FROM onroad"""
BODIES["monthly_segment_efficiency"] = f"""
SELECT CAST(date_trunc('month', event_ts) AS TIMESTAMP) AS month_start, segment_id, route_name, highway, from_city, to_city,
  segment_km, count(DISTINCT vehicle_id) AS unique_vehicles, count(DISTINCT customer_id) AS unique_customers,
  count(*) AS total_readings, {rnd('avg(j1939_fuel_rate_lph)', 2)} AS avg_fuel_rate_lph,
  {rnd('avg(j1939_vehicle_speed_kph)', 1)} AS avg_speed_kph, {rnd('avg(j1939_engine_load_pct)', 1)} AS avg_engine_load_pct,
  CASE WHEN avg(j1939_vehicle_speed_kph) > 0
    THEN {rnd('avg(j1939_fuel_rate_lph) / avg(j1939_vehicle_speed_kph) * 100', 2)} END AS fuel_efficiency_l_per_100km
FROM onroad GROUP BY 1, 2, 3, 4, 5, 6, 7"""

# ---- scorecard, alerts, dashboard ------------------------------------------------------------------

BODIES["driver_scorecard"] = "SELECT * FROM score"
BODIES["scorecard_top"] = """
SELECT * FROM score ORDER BY driver_grade, total_km DESC NULLS FIRST, customer_id, vehicle_id LIMIT 20"""
BODIES["grade_distribution"] = "SELECT driver_grade, count(*) AS vehicle_count FROM score GROUP BY 1"
BODIES["worst_efficiency"] = """
SELECT * FROM score ORDER BY avg_fuel_eff DESC NULLS LAST, customer_id, vehicle_id LIMIT 10"""
BODIES["eff_by_grade"] = f"""
SELECT driver_grade, {rnd(avg_exact('score.avg_fuel_eff'), 2)} AS avg_fuel_eff FROM score GROUP BY 1"""
BODIES["grade_scatter"] = (
    "SELECT vehicle_id, customer_id, avg_speed, avg_fuel_eff, driver_grade, total_km FROM score"
)
BODIES["speed_alert_report"] = "SELECT * FROM alert"
BODIES["top_speed_alerts"] = """
SELECT * FROM alert ORDER BY max_speed_kph DESC NULLS FIRST, vehicle_id, trip_num LIMIT 20"""
BODIES["alert_distribution"] = "SELECT speed_alert_level, count(*) AS alert_count FROM alert GROUP BY 1"
BODIES["violations_by_customer"] = f"""
SELECT customer_id, count(*) AS violations, {n_if("speed_alert_level = 'CRITICAL'")} AS critical_violations
FROM alert GROUP BY 1"""
BODIES["customer_fleet_report"] = f"""
SELECT vehicle_id, total_trips, total_km AS total_distance_km, total_fuel_l, avg_fuel_eff AS avg_fuel_efficiency, top_speed,
  health_status, driver_grade FROM score WHERE customer_id = '{TENANT}'"""
BODIES["sql_fleet_report"] = BODIES["customer_fleet_report"]
BODIES["sql_speed_violations"] = BODIES["speed_violations"] = f"""
SELECT vehicle_id, trip_num, trip_start_ts, max_speed_kph, start_geofence, end_geofence FROM trip
WHERE customer_id = '{TENANT}' AND max_speed_kph > 80"""
BODIES["top_trips"] = f"""
SELECT customer_id, vehicle_id, trip_num, trip_start_ts, trip_end_ts, duration_min, {rnd('t.distance_km', 1)} AS distance_km,
  {rnd('fuel_consumed_l', 1)} AS fuel_l, fuel_efficiency_l_per_100km AS fuel_eff, avg_speed_kph AS avg_speed,
  max_speed_kph AS max_speed, start_geofence, end_geofence
FROM trip t ORDER BY t.distance_km DESC NULLS FIRST, vehicle_id, trip_num LIMIT 20"""
BODIES["longest_trips"] = f"""
SELECT vehicle_id, customer_id, trip_num, {rnd('distance_km', 1)} AS km, duration_min AS mins,
  fuel_efficiency_l_per_100km AS fuel_eff, start_geofence, end_geofence
FROM trip ORDER BY distance_km DESC NULLS FIRST, vehicle_id, trip_num LIMIT 10"""
BODIES["top_routes"] = """
SELECT start_geofence || ' → ' || end_geofence AS route, count(*) AS trips FROM trip
WHERE start_geofence IS NOT NULL AND end_geofence IS NOT NULL GROUP BY 1 ORDER BY trips DESC, route LIMIT 10"""
BODIES["trip_averages"] = f"""
SELECT {rnd(avg_exact('distance_km'), 2)} AS avg_distance_km, {rnd(avg_exact('duration_min'), 2)} AS avg_duration_min,
  {rnd(avg_exact('fuel_consumed_l'), 2)} AS avg_fuel_l, {rnd(avg_exact('trip.avg_speed_kph'), 2)} AS avg_speed_kph FROM trip"""
BODIES["distance_histogram"] = """
SELECT CAST(least(floor((distance_km - lo) * 30 / (hi - lo)) + 1, 30) AS BIGINT) AS bin, count(*) AS n,
  min(distance_km) AS min_value, max(distance_km) AS max_value
FROM trip, (SELECT min(distance_km) AS lo, max(distance_km) AS hi FROM trip) WHERE distance_km IS NOT NULL GROUP BY 1"""
BODIES["trip_scatter"] = """
SELECT vehicle_id, trip_num, distance_km, fuel_efficiency_l_per_100km, avg_speed_kph FROM trip"""


def kpis(where: str) -> str:
    return f"""
SELECT (SELECT count(DISTINCT vehicle_id) FROM score {where}) AS total_vehicles, (SELECT count(*) FROM trip {where}) AS total_trips,
  (SELECT {rnd(avg_exact('fuel_efficiency_l_per_100km'), 2)} FROM trip {where}) AS avg_fuel_efficiency,
  (SELECT {rnd(sum_exact('distance_km'), 1)} FROM trip {where}) AS total_distance_km,
  (SELECT count(*) FROM alert {where}) AS speed_violations,
  (SELECT {n_if("speed_alert_level = 'CRITICAL'")} FROM alert {where}) AS critical_violations,
  (SELECT {n_if("health_status = 'WARNING'")} FROM health {where}) AS warning_vehicles"""


BODIES["kpi_row"] = kpis("")
BODIES["kpi_row_customer"] = kpis(f"WHERE customer_id = '{TENANT}'")

# ---- scalar functions --------------------------------------------------------------------------------

DIST = km("la", "lo", "fa", "fo")
BODIES["haversine"] = f"SELECT vehicle_id, event_ts, {rnd(DIST, 4)} AS km FROM fencedist"
BODIES["great_circle_acos"] = f"SELECT vehicle_id, event_ts, {rnd(DIST, 3)} AS km FROM fencedist"
BODIES["in_geofence"] = f"""
SELECT vehicle_id, event_ts, {DIST} <= radius_km AS inside, {DIST} <= 400 AS inside_400km FROM fencedist"""
BODIES["geo_cell"] = f"""
SELECT vehicle_id, event_ts, {cell('gps_latitude', 'gps_longitude', 7)} AS cell_res7,
  {cell('gps_latitude', 'gps_longitude', 9)} AS cell_res9 FROM reading"""
BODIES["fleet_distinct_sketch"] = """
SELECT customer_id, count(DISTINCT vehicle_id) AS vehicles, count(DISTINCT device_id) AS devices, TRUE AS within_bound
FROM reading GROUP BY customer_id"""
BODIES["curved_box"] = """
SELECT vehicle_id, event_ts, gps_latitude, gps_longitude, gps_speed_kph FROM reading
WHERE CAST(substr(vehicle_id, 4) AS BIGINT) BETWEEN 10 AND 60 AND event_ts >= TIMESTAMP '2024-01-05 00:00:00'
  AND event_ts < TIMESTAMP '2024-01-15 00:00:00' AND gps_latitude BETWEEN 10 AND 20"""
BODIES["hex_cell"] = f"""
SELECT vehicle_id, event_ts, {hexed('gps_latitude', 'gps_longitude', 7)} AS cell_res7,
  {hexed('gps_latitude', 'gps_longitude', 9)} AS cell_res9 FROM reading"""
# The parent of a cell by its id: another resolution, and no digits behind it.
BODIES["hex_density"] = f"""
SELECT printf('%x', (CAST('0x' || h AS BIGINT) & {~(15 << 52)}) | {(4 << 52) + sum(7 << 3 * n for n in range(11))}) AS cell_res4,
  count(DISTINCT h) AS cells, count(DISTINCT vehicle_id) AS vehicles, count(*) AS readings
FROM reading JOIN hex7 x ON x.lat = gps_latitude AND x.lon = gps_longitude GROUP BY 1"""
BEARING = (
    "degrees(atan2(sin(radians(end_lon - start_lon)) * cos(radians(end_lat)), cos(radians(start_lat)) * sin(radians(end_lat))"
    " - sin(radians(start_lat)) * cos(radians(end_lat)) * cos(radians(end_lon - start_lon))))"
)
BODIES["segment_bearing"] = f"""
SELECT segment_id, {rnd(f'CASE WHEN {BEARING} < 0 THEN {BEARING} + 360 ELSE {BEARING} END', 4)} AS bearing FROM segment"""
BODIES["segment_geometry"] = f"""
SELECT segment_id, route_name, mid_lat, mid_lon, {rnd(km('start_lat', 'start_lon', 'end_lat', 'end_lon'), 1)} AS km FROM segment"""
BODIES["interpolate"] = """
SELECT segment_id, start_lat * 0.75e0 + end_lat * 0.25e0 AS lat, start_lon * 0.75e0 + end_lon * 0.25e0 AS lon FROM segment"""
BODIES["engine_health_grade"] = """
SELECT vehicle_id, event_ts, ingest_ts,
  CASE WHEN j1939_active_dtc_count >= 3 OR j1939_coolant_temp_c > 105 OR j1939_battery_voltage_v < 22 THEN 'CRITICAL'
    WHEN j1939_active_dtc_count >= 1 OR j1939_coolant_temp_c > 95 OR j1939_battery_voltage_v < 24
      OR j1939_oil_pressure_kpa < 200 THEN 'WARNING' ELSE 'HEALTHY' END AS engine_grade FROM raw"""
BODIES["kmh_to_mph"] = f"""
SELECT vehicle_id, event_ts, gps_speed_kph AS speed_kmh, {rnd('gps_speed_kph * 0.621371e0', 1)} AS speed_mph FROM raw"""
BODIES["sql_functions"] = (
    BODIES["engine_health_grade"].replace("ingest_ts,", f"ingest_ts, {rnd('j1939_vehicle_speed_kph * 0.621371e0', 1)} AS speed_mph,", 1)
)
BODIES["string_funcs"] = """
SELECT c_custkey, 'CUST_' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS padded, lower(c_mktsegment) AS lowered,
  replace(c_name, 'Customer#', '') AS replaced, right(c_name, 4) AS tail, '****@fleet.example' AS masked,
  c_name LIKE '%7' AS ends_with_7 FROM customer"""
BODIES["math_funcs"] = f"""
SELECT vehicle_id, event_ts, {rnd('cos(radians(gps_latitude))', 6, 12)} AS cos_lat, {rnd('sin(radians(gps_longitude))', 6, 12)} AS sin_lon,
  {rnd('atan2(imu_accel_y_g, imu_accel_x_g)', 6, 12)} AS accel_angle,
  {rnd('sqrt(imu_accel_x_g * imu_accel_x_g + imu_accel_y_g * imu_accel_y_g + imu_accel_z_g * imu_accel_z_g)', 6, 12)} AS accel_norm,
  abs(imu_gyro_x_dps) AS abs_gyro, gps_satellite_count % 4 AS sat_mod,
  CASE WHEN gps_speed_kph > 80 THEN 80e0 ELSE gps_speed_kph END AS capped,
  CASE WHEN gps_speed_kph < 20 THEN 20e0 ELSE gps_speed_kph END AS floored FROM reading"""
BODIES["date_funcs"] = f"""
SELECT vehicle_id, event_ts, ingest_ts, {DAY} AS "day", CAST(date_trunc('month', event_ts) AS TIMESTAMP) AS "month",
  event_ts - INTERVAL 7 DAY AS week_before, date_diff('second', event_ts, ingest_ts) AS seconds,
  date_diff('minute', event_ts, TIMESTAMP '{AS_OF}') AS minutes FROM raw"""
BODIES["json_payload"] = """
SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double,
  CAST(NULL AS VARCHAR) AS missing FROM events"""
BODIES["json_typed"] = """
SELECT vehicle_id, event_ts AS event_time, customer_id AS plant_region, CAST(trunc(gps_speed_kph) AS INT) AS speed_kph,
  gps_latitude AS latitude, gps_longitude AS longitude, 'Model ' || gps_fix_quality AS vehicle_model,
  CASE WHEN j1939_brake_switch THEN CAST(j1939_engine_rpm AS INT) END AS engine_rpm,
  CASE WHEN gps_speed_kph > 90 THEN 'OVERSPEED' WHEN gps_speed_kph > 5 THEN 'MOVING' ELSE 'IDLE' END AS event_type FROM raw"""
BODIES["json_filter"] = """
SELECT vehicle_id, event_ts AS event_time, CAST(trunc(gps_speed_kph) AS INT) AS speed FROM raw
WHERE gps_speed_kph > 5 AND gps_speed_kph <= 90"""

# ---- governance and retention ------------------------------------------------------------------------

BODIES["customer_vehicles"] = """
SELECT * EXCLUDE (n), 'XX-' || (n // 9000 + 10) || '-XX-' || (n % 9000 + 1000) AS device_serial_number FROM (
  SELECT *, CAST('0x' || md5(vehicle_id || '|' || device_id)[1:15] AS BIGINT) % 810000 AS n FROM registry)"""
BODIES["row_policy"] = f"SELECT * FROM trip WHERE customer_id || '_ROLE' = '{ROLE}'"
BODIES["mask_email"] = f"""
SELECT * EXCLUDE (driver_email), '****-****' AS device_serial_number, '****@fleet.example' AS driver_email
FROM registry WHERE customer_id = '{TENANT}'"""
BODIES["tenant_customers"] = f"SELECT DISTINCT customer_id FROM registry WHERE customer_id = '{TENANT}'"
BODIES["tenant_counts"] = f"""
SELECT 'ACCOUNTADMIN' AS role, count(*) AS n FROM registry
UNION ALL SELECT '{ROLE}', count(*) FROM registry WHERE customer_id || '_ROLE' = '{ROLE}'
UNION ALL SELECT 'CUST_0002_ROLE', count(*) FROM registry WHERE customer_id || '_ROLE' = 'CUST_0002_ROLE'"""
MASKED = """
SELECT driver_id, driver_name, 'XXX-XXX-' || right(phone, 4) AS phone, '****-MASKED-****' AS license_no,
  '***VIN-' || right(vin, 4) AS vin, dealer_region FROM profile"""
BODIES["mask_columns"] = BODIES["mask_by_tag"] = MASKED
BODIES["region_policy"] = "SELECT * FROM profile WHERE dealer_region = 'ASIA'"
BODIES["policy_listing"] = """
SELECT customer_id, customer_name, raw_retention_days, curated_retention_days, trip_retention_days, video_retention_days
FROM policy ORDER BY customer_id LIMIT 10"""
BODIES["retention_keep"] = "SELECT vehicle_id, customer_id, event_ts, ingest_ts FROM judged WHERE NOT gone"
BODIES["retention_deleted"] = """
SELECT p.customer_id, count(j.customer_id) AS deleted FROM policy p
LEFT JOIN (SELECT customer_id FROM judged WHERE gone) j ON j.customer_id = p.customer_id GROUP BY 1"""
BODIES["retention_message"] = """
SELECT 'RAW retention enforced. Total rows deleted: ' || count(*) AS message FROM judged WHERE gone"""

# ---- text --------------------------------------------------------------------------------------------

BODIES["text_sentiment"] = """
SELECT d.doc_id, count(t.word) AS word_count, count(l.word) AS scored_words,
  coalesce(sum(l.score) / nullif(count(l.word), 0), 0e0) AS sentiment_score
FROM documents d LEFT JOIN token t ON t.doc_id = d.doc_id LEFT JOIN lexicon l ON l.word = t.word GROUP BY d.doc_id"""
BODIES["text_summary"] = """
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(s.summary, '') END AS summary FROM documents d LEFT JOIN (
SELECT doc_id, string_agg(sentence, '. ' ORDER BY pos) AS summary FROM (
  SELECT w.doc_id, w.pos, w.sentence, sum(f.n) / count(*) AS weight
  FROM (SELECT doc_id, pos, sentence, unnest(ws) AS word FROM sentence) w
  JOIN (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS word FROM sentence) GROUP BY ALL) f
    ON f.doc_id = w.doc_id AND f.word = w.word
  GROUP BY w.doc_id, w.pos, w.sentence
  QUALIFY row_number() OVER (PARTITION BY w.doc_id ORDER BY weight DESC, w.pos) <= 2) GROUP BY doc_id) s ON s.doc_id = d.doc_id"""
BODIES["structured_extract"] = """
SELECT event_id, CASE WHEN ok THEN CASE event_id % 4 WHEN 0 THEN 'Wet' WHEN 1 THEN 'Potholed' ELSE 'Dry' END END AS road_condition,
  CASE WHEN ok THEN CASE WHEN event_id % 3 = 0 THEN 'Rain' ELSE 'Clear' END END AS weather,
  CASE WHEN ok THEN CASE WHEN event_id % 5 = 0 THEN 'Poor' ELSE 'Good' END END AS visibility,
  CASE WHEN ok THEN 'truck, ' || event_type END AS objects_detected,
  CASE WHEN ok THEN CASE WHEN event_id % 4 = 0 THEN 'HIGH' ELSE 'LOW' END END AS safety_risk,
  CASE WHEN ok AND event_id % 4 = 0 THEN 'Slow down.' END AS recommended_action
FROM (SELECT *, event_id % 10 <> 9 AS ok FROM events)"""

_AFTER = BLOCKS["daily"].replace("FROM reading", "FROM kept_reading")
BLOCKS["kept_reading"] = """
SELECT * FROM judged WHERE NOT gone QUALIFY row_number() OVER
 (PARTITION BY vehicle_id, event_ts ORDER BY ingest_ts DESC, offs DESC) = 1"""
BODIES["retention_propagate"] = _AFTER

BODIES["refresh_fleet"], BODIES["refresh_vehicles"] = BODIES["fact_customer_fleet"], BODIES["dim_vehicle"]
BODIES["refresh_customers"], BODIES["refresh_health"] = BODIES["dim_customer"], BODIES["fleet_health"]
BODIES["refresh_status"], BODIES["refresh_trips"] = BODIES["realtime_fleet_status"], BODIES["trip_summaries"]
BODIES["refresh_status_lookup"] = f"SELECT * FROM ({BODIES['realtime_fleet_status']}) WHERE vehicle_id = '{TRACKED_VEHICLE}'"
BODIES["retention_applied"] = "SELECT vehicle_id, customer_id, event_ts, ingest_ts FROM kept_reading"

ORACLES: dict[str, str] = {name: _sql(body) for name, body in BODIES.items()}

# The same tables over what retention leaves.
BLOCKS["reading"] = BLOCKS["kept_reading"]
ORACLES["retention_daily"] = _sql("SELECT * FROM daily")
ORACLES["retention_trips"] = _sql("SELECT * FROM trip")
ORACLES["retention_health"] = _sql("SELECT * FROM health").replace(AS_OF, RETENTION_AS_OF)
