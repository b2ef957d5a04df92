"""Trips against a brute-force reading of the rules."""

import math
import random

import pytest
from helpers import at, deliveries

from roadlark.operators import curated, intervals, trips
from roadlark.sources.masters import complete_fences, city_fences

R = 6371.0


def km(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(h))


def brute_force(rows, fences):
    """Number the ON rows of each vehicle, take spans per customer, scan all rows of each span."""
    out = {}
    for vehicle in {r["vehicle_id"] for r in rows}:
        own = sorted((r for r in rows if r["vehicle_id"] == vehicle), key=lambda r: r["t"])
        number, before, spans = 0, None, {}
        for r in own:
            if r["tel_ignition_status"] == "ON":
                if before in (None, "OFF"):
                    number += 1
                if number:
                    spans.setdefault((number, r["customer_id"]), []).append(r["t"])
            before = r["tel_ignition_status"]
        for trip in {n for n, _ in spans}:
            customers = {c: (min(ts), max(ts)) for (n, c), ts in spans.items() if n == trip}
            inside = sorted(
                (r["t"], c, r) for c, (lo, hi) in customers.items() for r in own if lo <= r["t"] <= hi
            )
            first_customer = min(customers, key=lambda c: customers[c][0])
            lo, hi = customers[first_customer]
            speeds = [r["j1939_vehicle_speed_kph"] for _, _, r in inside if r["j1939_vehicle_speed_kph"] is not None]
            odo = [r["j1939_odometer_km"] for _, _, r in inside]

            def city(times):
                best = [
                    (d, fid, name)
                    for r in own
                    if r["t"] in times and r["gps_latitude"] is not None
                    for fid, name, la, lo_, rad in fences
                    if (d := km(r["gps_latitude"], r["gps_longitude"], la, lo_)) <= rad
                ]
                return min(best)[2] if best else None

            out[(vehicle, trip)] = (
                first_customer,
                at(lo),
                at(hi),
                int(hi) - int(lo),
                inside[0][2]["gps_latitude"],
                inside[-1][2]["gps_longitude"],
                round(max(odo) - min(odo), 2),
                len(speeds) and sum(speeds) / len(speeds),
                city([v[0] for v in customers.values()]),
                city([v[1] for v in customers.values()]),
            )
    return out


def random_rows(seed, vehicles=6, per_vehicle=60):
    rng = random.Random(seed)
    rows = []
    for v in range(vehicles):
        times = sorted(rng.sample(range(0, 20000), per_vehicle))
        for i, t in enumerate(times):
            located = rng.random() > 0.1
            rows.append(
                {
                    "t": t,
                    "vehicle_id": f"VH_{v}",
                    "customer_id": rng.choice(["A", "B"]) if v % 3 == 0 else "A",
                    "tel_ignition_status": rng.choice(["ON", "ON", "ON", "OFF", "ACC", None]),
                    "gps_latitude": 10 + rng.randrange(0, 64) / 64 if located else None,
                    "gps_longitude": 77 + rng.randrange(0, 64) / 64 if located else None,
                    "j1939_vehicle_speed_kph": rng.choice([None, rng.randrange(0, 400) / 4]),
                    "j1939_odometer_km": i * 2.25,
                }
            )
    return rows


FENCES = [("F1", "one", 10.25, 77.25, 30.0), ("F2", "two", 10.75, 77.75, 30.0), ("F3", "twin", 10.75, 77.75, 30.0)]


@pytest.fixture(scope="module")
def fences(spark):
    return complete_fences(
        spark.createDataFrame(
            FENCES, "geofence_id string, city_name string, latitude double, longitude double, radius_km double"
        )
    )


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bucket", [7, 3600, 10**7])
def test_trips_equal_brute_force(spark, fences, seed, bucket):
    rows = random_rows(seed)
    readings = curated.latest_readings(deliveries(spark, rows))
    got = trips.trip_summaries(readings, fences, bucket).collect()
    want = brute_force(rows, FENCES)
    assert len(got) == len(want)
    for r in got:
        c, start, end, seconds, lat, lon, dist, speed, start_city, end_city = want[(r.vehicle_id, r.trip_num)]
        assert (r.customer_id, r.trip_start_ts, r.trip_end_ts, r.duration_sec) == (c, start, end, seconds)
        assert (r.start_lat, r.end_lon, r.distance_km) == (lat, lon, dist)
        assert (r.start_geofence, r.end_geofence) == (start_city, end_city)
        assert (r.avg_speed_kph or 0) == pytest.approx(speed, abs=0.051)


def test_start_needs_off_or_nothing_before(spark):
    states = ["ACC", "ON", "OFF", "ON", "ACC", "ON", None, "ON"]
    rows = [{"t": i * 10, "tel_ignition_status": s} for i, s in enumerate(states)]
    got = trips.ignition_transitions(deliveries(spark, rows), 15).orderBy("event_ts").collect()
    assert [r.trip_start_flag for r in got] == [0, 0, 0, 1, 0, 0, 0, 1]
    assert [r.trip_num for r in got] == [None, 0, None, 1, None, 1, None, 2]


def test_special_vehicles(spark, fences):
    rows = [{"t": i, "vehicle_id": "all_off", "tel_ignition_status": "OFF"} for i in range(5)]
    rows += [{"t": 3, "vehicle_id": "single"}]
    rows += [{"t": None, "vehicle_id": "no_time"}]
    got = trips.trip_summaries(curated.latest_readings(deliveries(spark, rows)), fences).collect()
    assert [(r.vehicle_id, r.trip_num, r.duration_sec, r.distance_km) for r in got] == [("single", 1, 0, None)]
    assert got[0].start_geofence is None and got[0].fuel_efficiency_l_per_100km is None


def test_trips_of_a_vehicle_are_disjoint(spark, fences):
    readings = curated.latest_readings(deliveries(spark, random_rows(5)))
    rows = sorted(
        (r.vehicle_id, r.trip_start_ts, r.trip_end_ts) for r in trips.trip_boundaries(readings).where("customer_id = 'A' AND vehicle_id IN ('VH_1', 'VH_2')").collect()
    )
    for a, b in zip(rows, rows[1:]):
        assert a[0] != b[0] or a[2] < b[1]


def test_interval_join_equals_plain_join(spark):
    rows = random_rows(9)
    events = deliveries(spark, rows).select("vehicle_id", "event_ts")
    rng = random.Random(3)
    spans = []
    for n in range(80):
        lo = rng.randrange(0, 20000)
        spans.append((f"VH_{rng.randrange(6)}", n, at(lo), at(lo + rng.choice([-5, 0, 40, 9000]))))
    spans = spark.createDataFrame(spans, "vehicle_id string, n int, s timestamp_ntz, e timestamp_ntz")
    got = intervals.interval_join(events, spans, "vehicle_id", "event_ts", "s", "e")
    plain = events.join(spans, "vehicle_id").where("event_ts BETWEEN s AND e")
    assert sorted(got.select("n", "event_ts").collect()) == sorted(plain.select("n", "event_ts").collect())
    assert got.count() > 0


def test_long_and_short_intervals_in_one_join(spark):
    """Intervals of a second, an hour and ten years; each lies in two cells at most."""
    events = deliveries(spark, [{"t": t} for t in range(0, 40000, 7)]).select("vehicle_id", "event_ts")
    spans = spark.createDataFrame(
        [(1, at(70), at(71)), (2, at(0), at(3600)), (3, at(-150_000_000), at(170_000_000)), (4, at(20), at(10)), (5, at(0), None)],
        "n int, s timestamp_ntz, e timestamp_ntz",
    )
    spans = spans.crossJoin(events.select("vehicle_id").distinct())
    cells = intervals.interval_cells(spans, "s", "e").groupBy("n").count().collect()
    assert {r.n for r in cells} == {1, 2, 3} and max(r["count"] for r in cells) <= 2
    got = intervals.interval_join(events, spans, "vehicle_id", "event_ts", "s", "e")
    plain = events.join(spans, "vehicle_id").where("event_ts BETWEEN s AND e")
    assert sorted(got.select("n", "event_ts").collect()) == sorted(plain.select("n", "event_ts").collect())
    assert intervals.interval_join(events, spans.where("n > 5"), "vehicle_id", "event_ts", "s", "e").isEmpty()


def test_city_fences(spark):
    assert city_fences(spark).count() == 25


def test_flapping_ignition_leaves_few_rows_per_piece(spark):
    """2,000 readings that alternate ON and ACC are one trip of 2,000 runs."""
    rows = [{"t": i * 10, "tel_ignition_status": "ON" if i % 2 == 0 else "ACC", "j1939_odometer_km": float(i)} for i in range(2000)]
    runs = trips.trip_runs(deliveries(spark, rows))
    assert runs.count() == 2000
    merged = trips._without_flapping(trips._numbered(runs))
    buckets = merged.select("bucket").distinct().count()
    assert merged.count() <= 5 * buckets
    trip = trips.trips_from_runs(runs, city_fences(spark)).collect()
    assert len(trip) == 1 and trip[0].distance_km == 1998.0 and trip[0].duration_sec == 19980
