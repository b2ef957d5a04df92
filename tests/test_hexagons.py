import math

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from roadlark.functions.hexagons import (
    FACES,
    PENTAGONS,
    base_cell,
    filed,
    hex_cell,
    hex_id,
    hex_parent,
    with_hex_cell,
    with_hex_id,
)
from roadlark.sources.masters import city_fences

# Published ids of the cities' cells at resolutions 7 and 9 (fixed values).
CITIES = """
AGR 873d8584affffff 893d8584a87ffff
AHM 8742cea64ffffff 8942cea6453ffff
BHU 873c8e400ffffff 893c8e400c3ffff
BLR 8760145b4ffffff 8960145b483ffff
CHD 873d14699ffffff 893d14699c7ffff
CHE 87618c488ffffff 89618c48847ffff
DEL 873da18c3ffffff 893da18c333ffff
DUR 873ca96e8ffffff 893ca96e823ffff
GOA 8760a989bffffff 8960a989b2fffff
HYD 8760a25b0ffffff 8960a25b007ffff
IND 873d9629bffffff 893d9629b83ffff
JAI 873da218effffff 893da218ea7ffff
KOC 876004d33ffffff 896004d339bffff
KOL 873cf2c60ffffff 893cf2c646fffff
LKN 873d8dcd5ffffff 893d8dcd553ffff
MAD 87603422cffffff 89603422c3bffff
MUM 87608b0b6ffffff 89608b0b61bffff
MYS 876015d9dffffff 896015d9d2fffff
NAS 876099a04ffffff 896099a048fffff
PUN 876088501ffffff 8960885016bffff
TRV 876026235ffffff 896026222dbffff
UDP 873db66b4ffffff 893db679a6fffff
VIJ 87619aa6cffffff 89619aa6c77ffff
VIZ 873c93014ffffff 893c9301423ffff
VNS 873c16456ffffff 893c16456cfffff
"""


def test_published_ids(spark):
    rows = {r.geofence_id[3:]: (r.cell_center_res7, r.cell_center_res9) for r in city_fences(spark).collect()}
    assert rows == {line.split()[0]: tuple(line.split()[1:]) for line in CITIES.strip().splitlines()}


def test_base_cells():
    places = {base_cell(f, i, j, k) for f in range(20) for i in range(3) for j in range(3) for k in range(3)}
    assert {cell for cell, _ in places} == set(range(122)) and len(set(filed())) == 122
    # Their numbers follow their centres from north to south.
    assert base_cell(0, 0, 0, 0) == (16, 0) and base_cell(0, 2, 1, 0) == (15, 1) and base_cell(5, 0, 2, 0) == (24, 3)


@pytest.mark.parametrize("resolution", [0, 1, 2])
def test_cells_cover_the_sphere(spark, resolution):
    """Evenly spread points: every cell is met, none twice at distant places, pentagons included."""
    n = 60_000 * 5**resolution
    points = spark.range(n).select(
        F.degrees(F.asin(1 - (F.col("id") + 0.5) * 2 / n)).alias("lat"),
        (F.pmod(F.col("id") * 360 * (math.sqrt(5) - 1) / 2, F.lit(360.0)) - 180).alias("lon"),
    )
    flat = F.cos(F.radians("lat"))
    place = [flat * F.cos(F.radians("lon")), flat * F.sin(F.radians("lon")), F.sin(F.radians("lat"))]
    cells = points.groupBy(hex_id(F.col("lat"), F.col("lon"), resolution).alias("id")).agg(
        F.count("*").alias("n"), *[F.avg(p).alias(c) for p, c in zip(place, "xyz", strict=True)]
    )
    # A cap of the mean cell's area: its mean point lies at about 1 - area / (4 pi) of the radius.
    spread = 1 - F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2)
    count, least, widest = cells.agg(F.count("*"), F.min("n"), F.max(spread)).first()
    assert count == 2 + 120 * 7**resolution and least > 0.4 * n / count
    assert widest < 1.7 / count
    pentagons = cells.where(F.shiftright("id", 45).bitwiseAND(F.lit(127)).isin(list(PENTAGONS))).count()
    assert pentagons == 12 * (1 + 5 * (7**resolution - 1) // 6)


def test_odd_points_and_parents(spark):
    rows = [(None, 1.0), (1.0, None), (float("nan"), 1.0), (float("inf"), 1.0), (91.0, 200.0), (90.0, 0.0), (-90.0, 7.0), (0.0, 180.0), (0.0, -180.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    got = [r[0] for r in df.select(hex_cell(F.col("lat"), F.col("lon"), 5)).collect()]
    assert got[:4] == [None] * 4 and all(got[4:]) and got[7] == got[8]
    fine = hex_id(F.lit(26.9124), F.lit(75.7873), 9)
    row = spark.range(1).select(fine.alias("f")).select(hex_parent(F.col("f"), 7), hex_parent(F.col("f"), 9), "f", hex_parent(F.col("f"), 10)).first()
    assert row[0] == 0x873DA218EFFFFFF and row[1] == row[2] and row[3] is None
    with pytest.raises(ValueError):
        hex_id(F.lit(1.0), F.lit(1.0), 16)


def test_no_python_in_the_plan(spark):
    plan = plan_of(city_fences(spark))
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("resolution", [0, 1, 7, 8, 15])
def test_compiled_ids_equal_the_expression(spark, resolution):
    poles = [(90.0, 0.0), (-90.0, 180.0), (0.0, 180.0), (0.0, -180.0), (100.0, 500.0)]
    rows = poles + [(None, 1.0), (1.0, None), (float("inf"), 0.0), (float("nan"), 0.0)]
    rows += [(math.degrees(lat), math.degrees(lon)) for lat, lon, _ in FACES]
    rows += [(math.degrees(math.asin(2 * ((n * 0.618) % 1) - 1)), (n * 137.5) % 360 - 180) for n in range(300)]
    points = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "lat double, lon double, _hexa int")
    made = with_hex_id(points, "id", "lat", "lon", resolution)
    assert made.columns == ["lat", "lon", "_hexa", "id"]
    got = made.select("id", hex_id(F.col("lat"), F.col("lon"), resolution).alias("other")).collect()
    assert len(got) == len(rows) and [r.id for r in got] == [r.other for r in got]
    assert [r.id for r in got[5:9]] == [None] * 4


def test_a_condition_on_compiled_cells_stays_above_them(spark):
    points = spark.createDataFrame([(26.9, 75.8), (None, 1.0)], "lat double, lon double")
    cells = with_hex_cell(points, "cell", "lat", "lon").where("cell IS NOT NULL")
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and len(plan) < 60_000
    assert cells.count() == 1


def test_joins_on_place_interpret_no_cells(spark):
    from roadlark.operators.spatial import readings_on_segments

    readings = spark.createDataFrame([(1, 26.9, 75.8)], "vehicle_id int, gps_latitude double, gps_longitude double")
    names = "segment_id, route_name, highway, from_city, to_city, segment_km, cell_mid_res7".split(", ")
    cell = hex_cell(F.lit(26.9), F.lit(75.8))
    segments = spark.range(1).select(*[F.lit(n).alias(n) for n in names[:-1]], cell.alias(names[-1]))
    joined = readings_on_segments(readings, segments.localCheckpoint())
    assert "lambda" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 1
