import math
import random

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from roadlark.functions import geo
from roadlark.operators import spatial
from roadlark.operators.spatial import fences_around, match_nearest_fence, readings_on_segments
from roadlark.sources.masters import segments_from_waypoints, with_segment_cells
from test_trips import km


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_known_distance(spark):
    points = [F.lit(x) for x in (12.9716, 77.5946, 17.385, 78.4867)]
    row = one(spark, geo.haversine_km(*points), geo.great_circle_km(*points), geo.bearing_deg(*points))
    assert row[0] == pytest.approx(499.99, abs=0.01)
    assert row[1] == pytest.approx(row[0], abs=1e-6)
    assert 0 <= row[2] < 360


def test_missing_coordinate_gives_missing_distance(spark):
    nothing = F.lit(None).cast("double")
    args = [F.lit(1.0), nothing, F.lit(2.0), F.lit(3.0)]
    assert one(spark, geo.haversine_km(*args), geo.great_circle_km(*args), geo.geo_cell(F.lit(1.0), nothing))[:] == (
        None,
        None,
        None,
    )


def test_zero_radius_means_default(spark):
    here = [F.lit(x) for x in (10.0, 77.0, 10.1, 77.0)]
    assert one(spark, geo.in_fence(*here), geo.in_fence(*here, 0.0), geo.in_fence(*here, 5.0))[:] == (True, True, False)


@pytest.mark.parametrize("radius", [0.5, 15.0, 900.0, 9000.0])
def test_fence_join_equals_brute_force_everywhere(spark, radius):
    """Includes fences over the poles and across the date line."""
    rng = random.Random(int(radius * 10))
    centres = [(89.9, 10.0), (-89.95, 0.0), (0.0, 179.99), (12.3, -179.95), (45.0, 7.0), (0.0, 0.0)]
    points = []
    for lat, lon in centres:
        for _ in range(60):
            spread = radius / 111 * 1.3
            la = max(-90.0, min(90.0, lat + rng.uniform(-spread, spread)))
            lo = lon + rng.uniform(-spread, spread) / max(0.02, math.cos(math.radians(la)))
            points.append((len(points), la, (lo + 180) % 360 - 180))
    fences = [(f"G{i}", f"c{i}", la, lo, radius) for i, (la, lo) in enumerate(centres)]
    p = spark.createDataFrame(points, "id int, lat double, lon double")
    f = spark.createDataFrame(fences, "geofence_id string, city_name string, latitude double, longitude double, radius_km double")
    got = {(r.id, r.geofence_id) for r in fences_around(p, f, "lat", "lon").collect()}
    want = {(i, g) for i, la, lo in points for g, _, fa, fo, rad in fences if km(la, lo, fa, fo) <= rad}
    assert got == want and want


def test_nearest_fence_and_tie(spark):
    f = spark.createDataFrame(
        [("B", "b", 10.0, 77.0, 20.0), ("A", "a", 10.0, 77.0, 20.0), ("C", "c", 10.05, 77.0, 20.0)],
        "geofence_id string, city_name string, latitude double, longitude double, radius_km double",
    )
    p = spark.createDataFrame([(1, 10.0, 77.0), (2, 10.06, 77.0), (3, 40.0, 77.0), (4, None, 77.0)], "id int, lat double, lon double")
    got = match_nearest_fence(p, f, ["id"], "lat", "lon").collect()
    assert {r.id: r.geofence_id for r in got} == {1: "A", 2: "C"}


def test_fence_join_is_an_equi_join(spark):
    p = spark.createDataFrame([(1, 10.0, 77.0)], "id int, lat double, lon double")
    f = spark.createDataFrame([("A", "a", 10.0, 77.0, 20.0)], "geofence_id string, city_name string, latitude double, longitude double, radius_km double")
    plan = plan_of(fences_around(p, f, "lat", "lon"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_segments(spark):
    waypoints = spark.createDataFrame(
        [("R", "NH1", "x", "y", i, 10.0 + i / 8, 77.0) for i in range(4)],
        "route_name string, highway string, from_city string, to_city string, waypoint_idx bigint, lat double, lon double",
    )
    segments = with_segment_cells(segments_from_waypoints(waypoints))
    rows = segments.orderBy("segment_id").collect()
    assert [r.segment_id for r in rows] == ["R_S000", "R_S001", "R_S002"]
    assert rows[1].mid_lat == 10.1875 and rows[1].segment_km == pytest.approx(13.9, abs=0.01)
    on = spark.createDataFrame([("v", 10.1875, 77.0), ("v", 11.9, 77.0), ("v", None, None)], "vehicle_id string, gps_latitude double, gps_longitude double")
    assert [r.segment_id for r in readings_on_segments(on, segments).collect()] == ["R_S001"]


def test_small_fences_in_one_city_meet_few_points(spark):
    """10,000 depots of 200 metres on a grid of 8 by 8 km: a point's cell holds a handful of them."""
    fences = spark.range(10_000).selectExpr(
        "cast(id as string) AS geofence_id",
        "'c' AS city_name",
        "10D + floor(id / 100) * 0.0007 AS latitude",
        "70D + (id % 100) * 0.0007 AS longitude",
        "0.2D AS radius_km",
    )
    cells = spatial.fence_cells(fences)
    per_fence = cells.count() / 10_000
    per_cell = cells.groupBy("_level", "_x", "_y").count().agg({"count": "max"}).first()[0]
    assert per_fence <= 9 and per_cell <= 200
    points = spark.createDataFrame([(1, 10.03, 70.03)], "id int, lat double, lon double")
    near = spatial.fences_around(points, fences, "lat", "lon")
    brute = points.crossJoin(fences).where(
        "2 * 6371 * asin(sqrt(pow(sin(radians(latitude - lat) / 2), 2) + cos(radians(lat)) * cos(radians(latitude))"
        " * pow(sin(radians(longitude - lon) / 2), 2))) <= radius_km"
    )
    assert near.count() == brute.count() > 10


FENCE = "geofence_id string, city_name string, latitude double, longitude double, radius_km double"


def test_mixed_radii_in_one_table(spark):
    """Depots of 200 metres and a region of 2,000 km; no job runs while the plan is built."""
    rng = random.Random(4)
    depots = [(f"D{n}", "d", rng.uniform(8, 30), rng.uniform(70, 90), 0.2) for n in range(3000)]
    region = [("R", "r", 20.0, 80.0, 2000.0), ("Z", "z", 20.0, 80.0, 0.0), ("N", "n", 20.0, 80.0, None)]
    fences = spark.createDataFrame(depots + region, FENCE)
    per_fence = {r.geofence_id: r["count"] for r in spatial.fence_cells(fences).groupBy("geofence_id").count().collect()}
    assert max(per_fence.values()) <= 9 and "N" not in per_fence
    near = [(n, lat + rng.uniform(-0.003, 0.003), lon) for n, (_, _, lat, lon, _) in enumerate(depots[:300])]
    points = spark.createDataFrame([*near, (1000, -40.0, -60.0), (1001, None, 1.0)], "id int, lat double, lon double")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    joined = fences_around(points, fences, "lat", "lon", how="left")
    assert len(tracker.getJobIdsForGroup(None)) == before
    got = [(r.id, r.geofence_id) for r in joined.collect()]
    want = {(i, g) for i, la, lo in near for g, _, fa, fo, rad in depots + region[:1] if km(la, lo, fa, fo) <= rad}
    assert sorted(g for g in got if g[1]) == sorted(want) and len(want) > 400
    assert {(1000, None), (1001, None)} <= set(got)
    # A point is compared with the depots of its own small cell only.
    cells = spatial.fence_cells(fences.where("radius_km = 0.2")).groupBy("_level", "_x", "_y").count()
    assert cells.agg({"count": "max"}).first()[0] <= 4


def test_no_fences(spark):
    points = spark.createDataFrame([(1, 10.0, 77.0)], "id int, lat double, lon double")
    none = spark.createDataFrame([], FENCE)
    assert fences_around(points, none, "lat", "lon").isEmpty()
    assert [r.geofence_id for r in fences_around(points, none, "lat", "lon", how="left").collect()] == [None]


def test_segment_efficiency_sums_readings_per_cell(spark):
    """Many segments in one cell, names in several cells, equal rows and missing names."""
    rng = random.Random(3)
    names = ["segment_id", "route_name", "highway", "from_city", "to_city", "segment_km"]
    roads = [(f"S{n}", "R", None, "a", "b", 1.5, f"cell{n % 4}") for n in range(40)]
    roads += [("twice", "R", "h", "a", None, 2.0, c) for c in ("cell0", "cell1", "cell1", "cell9")]
    roads += [(None, None, None, None, None, None, c) for c in ("cell2", "cell2", None)]
    types = ", ".join(f"{c} {'double' if c == 'segment_km' else 'string'}" for c in names)
    segments = spark.createDataFrame(roads, types + ", cell_mid_res7 string")
    rows = [
        (rng.choice(["v1", "v2", None]), rng.choice(["A", "B", None]), f"2024-0{rng.randint(1, 2)}-03 00:00:00", rng.choice([0.0, 1.0, 2.0, 3.0, 5.0, None]), 0.0,
         *[rng.choice([None, 0.5, 3.25, 8.0]) for _ in range(3)])
        for _ in range(200)
    ]
    measured = ["j1939_fuel_rate_lph", "j1939_vehicle_speed_kph", "j1939_engine_load_pct"]
    columns = "vehicle_id string, customer_id string, ts string, gps_latitude double, gps_longitude double, "
    raw = spark.createDataFrame(rows, columns + ", ".join(f"{c} double" for c in measured))
    readings = raw.withColumn("event_ts", F.col("ts").cast("timestamp_ntz"))

    def cell(lat, lon, resolution):
        return F.concat(F.lit("cell"), lat.cast("int"))

    got = spatial.monthly_segment_efficiency(readings, segments, cell)
    month = F.date_trunc("MONTH", "event_ts").cast("timestamp_ntz").alias("month_start")
    pairs = readings.withColumn("cell_mid_res7", cell(F.col("gps_latitude"), None, 7)).join(segments, "cell_mid_res7")
    fuel, speed, load = (F.avg(c) for c in measured)
    wanted = pairs.groupBy(month, *names).agg(
        F.countDistinct("vehicle_id"), F.countDistinct("customer_id"), F.count("*"),
        F.round(fuel, 2), F.round(speed, 1), F.round(load, 1), F.when(speed > 0, F.round(fuel * 100 / speed, 2)),
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
    # No step holds a row per segment and vehicle.
    exchanged = [line for line in plan_of(got).splitlines() if "hashpartitioning" in line and "vehicle_id" in line]
    assert exchanged and not [line for line in exchanged if "segment_id" in line]
