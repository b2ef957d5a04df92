"""Reference data: geofences, road segments and customer retention policies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlark.functions.geo import haversine_km
from roadlark.functions.hexagons import hex_cell, with_hex_cell
from roadlark.functions.timing import as_ntz
from roadlark.sources.events import FENCE_LAT, FENCE_LON, read_table

CellFunction = Callable[[Column, Column, int], Column]

def with_cell(rows: DataFrame, name: str, cell: CellFunction, lat: str, lon: str, resolution: int) -> DataFrame:
    """``rows`` with their points' cells as a column; hexagons by their compiled form."""
    if cell is hex_cell:
        return with_hex_cell(rows, name, lat, lon, resolution)
    return rows.withColumn(name, cell(F.col(lat), F.col(lon), resolution))


# City geofences (id, city, latitude, longitude, radius in km).
CITY_FENCES = """
GF_AGR Agra 27.1767 78.0081 15
GF_AHM Ahmedabad 23.0225 72.5714 15
GF_BHU Bhubaneswar 20.2961 85.8245 15
GF_BLR Bangalore 12.9716 77.5946 15
GF_CHD Chandigarh 30.7333 76.7794 15
GF_CHE Chennai 13.0827 80.2707 15
GF_DEL Delhi 28.7041 77.1025 15
GF_DUR Durgapur 23.5204 87.3119 15
GF_GOA Goa 15.2993 74.124 15
GF_HYD Hyderabad 17.385 78.4867 15
GF_IND Indore 22.7196 75.8577 15
GF_JAI Jaipur 26.9124 75.7873 15
GF_KOC Kochi 9.9312 76.2673 15
GF_KOL Kolkata 22.5726 88.3639 15
GF_LKN Lucknow 26.8467 80.9462 15
GF_MAD Madurai 9.9252 78.1198 15
GF_MUM Mumbai 19.076 72.8777 15
GF_MYS Mysore 12.2958 76.6394 15
GF_NAS Nashik 19.9975 73.7898 15
GF_PUN Pune 18.5204 73.8567 15
GF_TRV Trivandrum 8.5241 76.9366 15
GF_UDP Udaipur 24.5854 73.7125 15
GF_VIJ Vijayawada 16.5062 80.648 15
GF_VIZ Visakhapatnam 17.6868 83.2185 15
GF_VNS Varanasi 25.3176 82.9739 15
"""

SEGMENT_FILE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("segment_id", "route_name", "highway", "from_city", "to_city")]
    + [T.StructField("waypoint_idx", T.LongType())]
    + [
        T.StructField(n, T.DoubleType())
        for n in ("start_lat", "start_lon", "end_lat", "end_lon", "mid_lat", "mid_lon", "segment_km")
    ]
)


# ---- geofences -----------------------------------------------------------------------------


def complete_fences(fences: DataFrame, cell: CellFunction = hex_cell) -> DataFrame:
    """Add the column defaults and the centre cells to (id, city, lat, lon, radius) rows."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return fences.select(
        "geofence_id",
        "city_name",
        "latitude",
        "longitude",
        "radius_km",
        F.lit("CITY_BOUNDARY").alias("geofence_type"),
        cell(lat, lon, 7).alias("cell_center_res7"),
        cell(lat, lon, 9).alias("cell_center_res9"),
        F.lit(True).alias("is_active"),
    )


def city_fences(spark: SparkSession) -> DataFrame:
    """As literal rows, so that Spark knows their size and can broadcast them."""
    rows = ", ".join("('{}', '{}', {}D, {}D, {}D)".format(*line.split()) for line in CITY_FENCES.strip().splitlines())
    names = "geofence_id, city_name, latitude, longitude, radius_km"
    return complete_fences(spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})"))


def fences_from_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    return complete_fences(
        nation.selectExpr(
            "concat('GF_', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS geofence_id",
            "n_name AS city_name",
            FENCE_LAT.format(n="n_nationkey") + " AS latitude",
            FENCE_LON.format(n="n_nationkey") + " AS longitude",
            "15e0 AS radius_km",
        )
    )


# ---- road segments -------------------------------------------------------------------------


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line."""
    return spark.read.csv(path, schema=SEGMENT_FILE, header=True)


def segments_from_waypoints(waypoints: DataFrame) -> DataFrame:
    """Join each waypoint to the next one of its route.

    Expects (route_name, highway, from_city, to_city, waypoint_idx, lat, lon) with consecutive
    indexes.  The pair is found by an equi join on (route, idx), so a route that holds most of
    the waypoints still spreads over all tasks, which a per-route window would not.
    """
    after = waypoints.select(
        "route_name",
        (F.col("waypoint_idx") - 1).alias("waypoint_idx"),
        F.col("lat").alias("end_lat"),
        F.col("lon").alias("end_lon"),
    )
    start = waypoints.withColumnsRenamed({"lat": "start_lat", "lon": "start_lon"})
    pairs = start.join(after, ["route_name", "waypoint_idx"])
    km = haversine_km(*(F.col(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")))
    return pairs.select(
        F.concat("route_name", F.lit("_S"), padded(F.col("waypoint_idx"), 3)).alias("segment_id"),
        "route_name",
        "highway",
        "from_city",
        "to_city",
        "waypoint_idx",
        "start_lat",
        "start_lon",
        "end_lat",
        "end_lon",
        ((F.col("start_lat") + F.col("end_lat")) / 2).alias("mid_lat"),
        ((F.col("start_lon") + F.col("end_lon")) / 2).alias("mid_lon"),
        F.round(km, 2).alias("segment_km"),
    )


def with_segment_cells(segments: DataFrame, cell: CellFunction = hex_cell) -> DataFrame:
    def at(point: str, resolution: int) -> Column:
        return cell(F.col(f"{point}_lat"), F.col(f"{point}_lon"), resolution)

    # The cell that readings meet is computed for every segment; the others only where they are read.
    placed = with_cell(segments, "cell_mid_res7", cell, "mid_lat", "mid_lon", 7)
    return placed.select(
        *segments.columns,
        at("start", 7).alias("cell_start_res7"),
        at("end", 7).alias("cell_end_res7"),
        "cell_mid_res7",
        at("mid", 9).alias("cell_mid_res9"),
    )


def waypoints_from_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier is a waypoint: 25 routes, each around the geofence of the same number."""
    supplier = read_table(spark, sf_dir, "supplier")
    route = "(s_suppkey % 25)"
    return supplier.selectExpr(
        f"concat('ROUTE_', lpad(CAST({route} AS STRING), 2, '0')) AS route_name",
        f"concat('NH', CAST({route} + 1 AS STRING)) AS highway",
        f"concat('NATION_', CAST({route} AS STRING)) AS from_city",
        f"concat('NATION_', CAST(({route} + 1) % 25 AS STRING)) AS to_city",
        "CAST(floor(s_suppkey / 25) AS BIGINT) AS waypoint_idx",
        FENCE_LAT.format(n=route) + " + ((s_suppkey * 131) % 200 - 100) / 1024e0 AS lat",
        FENCE_LON.format(n=route) + " + ((s_suppkey * 71) % 200 - 100) / 1024e0 AS lon",
    )


def segments_from_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_segment_cells(segments_from_waypoints(waypoints_from_suppliers(spark, sf_dir)))


# ---- customer retention policies -----------------------------------------------------------


def padded(number: Column, width: int) -> Column:
    """Zero-padded text that is never cut when the number outgrows the width."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def policies_from_sequence(seq: DataFrame, created_at: str, column: str = "seq") -> DataFrame:
    """One policy per sequence number; retention days repeat with the number."""
    n = F.col(column).cast("bigint")

    def days(value: int) -> Column:
        return F.lit(value).cast("bigint")

    return seq.select(
        F.concat(F.lit("CUST_"), padded(n, 4)).alias("customer_id"),
        F.concat(F.lit("Customer "), n.cast("string")).alias("customer_name"),
        F.when(n % 3 == 0, days(90)).when(n % 3 == 1, days(120)).otherwise(days(180)).alias("raw_retention_days"),
        F.when(n % 2 == 0, days(365)).otherwise(days(730)).alias("curated_retention_days"),
        days(730).alias("trip_retention_days"),
        F.when(n % 3 == 2, days(60)).otherwise(days(30)).alias("video_retention_days"),
        F.lit(True).alias("tenant_isolation_enabled"),
        as_ntz(created_at).alias("created_at"),
    )


def generated_policies(spark: SparkSession, count: int, created_at: str) -> DataFrame:
    return policies_from_sequence(spark.range(count), created_at, "id")


def policies_from_customers(spark: SparkSession, sf_dir: str, created_at: str) -> DataFrame:
    return policies_from_sequence(read_table(spark, sf_dir, "customer"), created_at, "c_custkey")
