"""Joins on place: points in geofences, readings on road segments."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlark.functions.geo import EARTH_RADIUS_KM, haversine_km
from roadlark.functions.hexagons import hex_cell
from roadlark.functions.timing import month_start
from roadlark.sources.masters import CellFunction, with_cell

# A quadtree over longitude and latitude: cells of 360 / 2**level degrees, at every other level.
FINEST, STEP = 22, 2
POLAR = 6  # caps over a pole touch whole circles of latitude: not finer than this
_CELLS = [2**n for n in range(FINEST + 1)]


def _index(degrees: Column, level: Column) -> Column:
    return F.floor(degrees * F.get(F.lit(_CELLS), level) / 360.0)


def _around(column: Column, level: Column) -> Column:
    return F.pmod(column, F.get(F.lit(_CELLS), level).cast("bigint"))


def fence_cells(fences: DataFrame) -> DataFrame:
    """One row per fence and quadtree cell its circle may touch, all of the fence's own level.

    The level is the finest whose cells are as wide as the circle, so it touches four as a rule,
    whatever its radius.  The latitude band is the angular radius; the longitude band is the exact
    half-width of a spherical cap, or the whole circle of latitude when the cap reaches a pole.  Both
    get a small margin, so a point on the rim is never missed; the exact distance test comes after
    the join.
    """
    angle = F.col("radius_km") / EARTH_RADIUS_KM + 1e-9
    lat = F.radians("latitude")
    lat_reach = F.degrees(angle) + 1e-6
    over_pole = F.abs(lat) + angle >= math.pi / 2
    lon_reach = F.when(over_pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), F.sin(angle) / F.cos(lat)))) + 1e-6
    )

    def finest(reach: Column) -> Column:
        level = F.floor(F.log2(F.lit(180.0) / reach))
        return F.greatest(F.least(level, F.lit(FINEST)), F.lit(0)).cast("int")

    reached = fences.withColumns({"_lat_reach": lat_reach, "_lon_reach": lon_reach})
    by_lat, by_lon = finest(F.col("_lat_reach")), finest(F.col("_lon_reach"))
    level = F.greatest(by_lon, F.least(by_lat, F.lit(POLAR)))
    leveled = reached.where("radius_km >= 0").withColumn("_level", level - level % STEP)
    west, east = (_index(F.col("longitude") + s * F.col("_lon_reach"), F.col("_level")) for s in (-1, 1))
    whole = F.get(F.lit(_CELLS), F.col("_level")).cast("bigint")
    columns = F.sequence(west, F.least(east, west + whole - 1))
    south, north = (_index(F.col("latitude") + s * F.col("_lat_reach"), F.col("_level")) for s in (-1, 1))
    return (
        leveled.select("*", F.explode(F.sequence(south, north)).alias("_y"), columns.alias("_columns"))
        .select("*", F.explode("_columns").alias("_column"))
        .withColumn("_x", _around(F.col("_column"), F.col("_level")))
        .drop("_columns", "_column", "_lat_reach", "_lon_reach")
    )


def fences_around(points: DataFrame, fences: DataFrame, lat: str, lon: str, how: str = "inner") -> DataFrame:
    """Each point with every fence that holds it, plus ``distance_km``; with ``how="left"`` also one
    row without a fence for each point that no fence of the coarsest level holds.

    An equi join on quadtree cells with the exact distance as residual condition: a fence lies in the
    cells of its own level, and a point looks into one cell for each level that some fence has (a
    subquery over the fences tells which, when the join runs).  So depots of 200 metres and regions
    of 2,000 km can stand in one table.  Spark broadcasts the fences while their size is below its
    threshold and otherwise shuffles on the cell, where AQE splits a cell that holds too many points.
    """
    cells = fence_cells(
        fences.select("geofence_id", "city_name", "latitude", "longitude", "radius_km")
    ).withColumnsRenamed({"latitude": "_fence_lat", "longitude": "_fence_lon"})
    levels = cells.select(F.sort_array(F.collect_set("_level"))).scalar()
    # Without any fence a point is looked up once, in vain.
    used = F.when(F.size(levels) > 0, levels).otherwise(F.array(F.lit(0)))

    leveled = points.withColumn("_used", used).select("*", F.posexplode("_used").alias("_n", "_pl")).drop("_used")
    x = _around(_index(F.col(lon), F.col("_pl")), F.col("_pl"))
    located = leveled.withColumns({"_px": x, "_py": _index(F.col(lat), F.col("_pl"))})
    distance = haversine_km(F.col(lat), F.col(lon), F.col("_fence_lat"), F.col("_fence_lon"))
    near = (
        (F.col("_pl") == F.col("_level"))
        & (F.col("_px") == F.col("_x"))
        & (F.col("_py") == F.col("_y"))
        & (distance <= F.col("radius_km"))
    )
    return (
        located.join(cells, near, how)
        .withColumn("distance_km", distance)
        .where((F.col("_n") == 0) | F.col("geofence_id").isNotNull())
        .drop("_n", "_pl", "_px", "_py", "_level", "_x", "_y", "_fence_lat", "_fence_lon", "radius_km")
    )


def nearest_fence() -> Column:
    """Aggregate over the rows of ``fences_around``: nearest fence, smaller id on equal distance."""
    return F.min(
        F.when(F.col("geofence_id").isNotNull(), F.struct("distance_km", "geofence_id", "city_name"))
    )


def match_nearest_fence(points: DataFrame, fences: DataFrame, keys: list[str], lat: str, lon: str) -> DataFrame:
    """Keys of the points inside some fence, with the nearest fence."""
    best = fences_around(points.select(*keys, lat, lon), fences, lat, lon).groupBy(*keys)
    return best.agg(nearest_fence().alias("_best")).select(
        *keys,
        F.col("_best.geofence_id").alias("geofence_id"),
        F.col("_best.city_name").alias("city_name"),
        F.col("_best.distance_km").alias("distance_km"),
    )


def readings_on_segments(readings: DataFrame, segments: DataFrame, cell: CellFunction = hex_cell) -> DataFrame:
    """Readings whose cell is the cell of a segment's midpoint; cells may hold several segments."""
    place = with_cell(readings, "_cell", cell, "gps_latitude", "gps_longitude", 7)
    roads = segments.select(
        F.col("cell_mid_res7").alias("_cell"),
        "segment_id",
        "route_name",
        "highway",
        "from_city",
        "to_city",
        "segment_km",
    )
    return place.join(roads, "_cell").drop("_cell")


def _places(segments: DataFrame, names: list[str]) -> DataFrame:
    """Segments by cell, with the ``_key`` that their readings are summed under.

    Segments that lie in one cell alone share the cell's sums; one that lies in several (a name that
    stands for several rows) has sums of its own.  ``_copies`` are equal rows.
    """
    rows = segments.where("cell_mid_res7 IS NOT NULL").groupBy(F.col("cell_mid_res7").alias("_cell"), *names)
    alone = F.count("*").over(Window.partitionBy(*names)) == 1
    key = F.struct(F.when(F.col("_alone"), F.col("_cell")).alias("cell"), *[F.when(~F.col("_alone"), F.col(c)).alias(c) for c in names])
    return rows.agg(F.count("*").alias("_copies")).withColumn("_alone", alone).withColumn("_key", key)


def monthly_segment_efficiency(readings: DataFrame, segments: DataFrame, cell: CellFunction = hex_cell) -> DataFrame:
    """Fuel use per month and road segment.

    Readings are summed per cell before they meet the segments, so a cell costs as many rows as it
    has readings, however many segments lie in it.  Sums per (month, cell, vehicle, customer) come
    first; the two distinct counts then run on those few rows instead of expanding every reading.
    """
    names = ["segment_id", "route_name", "highway", "from_city", "to_city", "segment_km"]
    measures = {
        "fuel": "j1939_fuel_rate_lph",
        "speed": "j1939_vehicle_speed_kph",
        "load": "j1939_engine_load_pct",
    }
    places = _places(segments, names)
    shared = F.col("_alone")
    summed = places.select("_cell", "_key", F.when(shared, F.lit(1)).otherwise(F.col("_copies")).alias("_weight")).distinct()
    roads = places.select("_key", *names, F.when(shared, F.col("_copies")).otherwise(F.lit(1)).alias("_times")).distinct()
    placed = readings.select(
        "vehicle_id",
        "customer_id",
        month_start(F.col("event_ts")).alias("month_start"),
        "gps_latitude",
        "gps_longitude",
        *measures.values(),
    )
    located = with_cell(placed, "_cell", cell, "gps_latitude", "gps_longitude", 7).join(summed, "_cell")
    weight = F.col("_weight")
    parts = located.groupBy("month_start", "_key", "vehicle_id", "customer_id").agg(
        F.sum(weight).alias("n"),
        *[F.sum(F.col(c) * weight).alias(f"{m}_sum") for m, c in measures.items()],
        *[F.sum(F.when(F.col(c).isNotNull(), weight)).alias(f"{m}_n") for m, c in measures.items()],
    )

    def mean(measure: str) -> Column:
        return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n"))

    cells = parts.groupBy("month_start", "_key").agg(
        F.countDistinct("vehicle_id").alias("unique_vehicles"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("n").alias("total_readings"),
        F.round(mean("fuel"), 2).alias("avg_fuel_rate_lph"),
        F.round(mean("speed"), 1).alias("avg_speed_kph"),
        F.round(mean("load"), 1).alias("avg_engine_load_pct"),
        F.when(mean("speed") > 0, F.round(mean("fuel") * 100 / mean("speed"), 2)).alias(
            "fuel_efficiency_l_per_100km"
        ),
    )
    results = {c: F.col(c) for c in cells.columns[2:]} | {"total_readings": F.col("total_readings") * F.col("_times")}
    return cells.join(roads, "_key").select("month_start", *names, *[r.alias(c) for c, r in results.items()])
