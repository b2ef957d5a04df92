"""Trips from ignition changes.

A trip starts at an ON reading whose predecessor is OFF or missing, and lasts to the last ON
reading before the next start.  Numbering runs per vehicle, and one vehicle may own a large part
of all readings, so no window ever spans a whole vehicle's readings:

1. Readings are cut into (vehicle, time bucket) pieces.  Inside a piece, consecutive readings
   with the same customer and ignition class collapse into one *run* carrying partial sums.
2. One row per (vehicle, bucket) - bounded by time, not by data - tells each bucket how its
   predecessor ended and how many trips started before it.
3. Runs get their trip number from that row.  Of the runs of a piece and trip, only each
   customer's first and last ON run can bound its span; what lies between is merged, so an
   ignition that flaps at every reading still leaves a few rows per piece.
4. These rows are merged per (vehicle, trip).

Steps 2 and 3 both need the result of step 1, which is therefore written once, to the work folder:
readings are scanned, deduplicated and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlark.functions.rules import litres_per_100km
from roadlark.functions.timing import epoch_seconds, seconds_between
from roadlark.operators.spatial import fences_around
from roadlark.session import work_folder

BUCKET_SECONDS = 3600
_PIECE = ["vehicle_id", "bucket"]
_TRIP = ["vehicle_id", "trip_num"]

_COUNTERS = {"odometer": "j1939_odometer_km", "fuel": "j1939_total_fuel_used_l"}
_AVERAGED = {"speed": "j1939_vehicle_speed_kph", "rpm": "j1939_engine_rpm", "load": "j1939_engine_load_pct"}
_POSITION = ["gps_latitude", "gps_longitude"]


def _trip_number() -> Column:
    """Trips before the piece, plus the one its first reading opens, plus those opened inside."""
    return F.col("trips_before") + F.col("opens").cast("bigint") + F.col("started_so_far")


def _with_bucket(readings: DataFrame, bucket_seconds: int) -> DataFrame:
    return readings.where("event_ts IS NOT NULL").withColumn(
        "bucket", F.floor(epoch_seconds(F.col("event_ts")) / bucket_seconds)
    )


def _ignition_flags(readings: DataFrame, bucket_seconds: int) -> DataFrame:
    """Flags that a piece can decide alone; ``first_in_piece`` marks what it cannot."""
    status = F.col("tel_ignition_status")
    in_order = Window.partitionBy(*_PIECE).orderBy("event_ts")
    starts_inside = F.coalesce(F.col("is_on") & F.col("prev_rearms"), F.lit(False))
    flagged = _with_bucket(readings, bucket_seconds).withColumns(
        {
            "is_on": F.coalesce(status == "ON", F.lit(False)),
            # The next ON reading after an OFF or unknown one opens a trip.
            "rearms": F.coalesce(status == "OFF", F.lit(True)),
        }
    )
    return flagged.withColumns(
        {
            "first_in_piece": F.row_number().over(in_order) == 1,
            "prev_on": F.lag("is_on").over(in_order),
            "prev_rearms": F.lag("rearms").over(in_order),
            "prev_customer": F.lag("customer_id").over(in_order),
        }
    ).withColumns(
        {
            "starts_inside": starts_inside,
            "started_so_far": F.sum(starts_inside.cast("bigint")).over(
                in_order.rowsBetween(Window.unboundedPreceding, 0)
            ),
        }
    )


def _carry(rows: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Per (vehicle, bucket): does its first reading open a trip, and how many opened earlier.

    ``rows`` are flagged readings or runs; either is reduced to one row per piece first.
    """
    pieces = rows.groupBy(*_PIECE).agg(
        F.min_by("is_on", ts).alias("first_on"),
        F.max_by("rearms", ts).alias("last_rearms"),
        F.sum(F.col("starts_inside").cast("bigint")).alias("started_inside"),
    )
    by_time = Window.partitionBy("vehicle_id").orderBy("bucket")
    opened = pieces.withColumn(
        "opens", F.col("first_on") & F.coalesce(F.lag("last_rearms").over(by_time), F.lit(True))
    )
    earlier = by_time.rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("started_inside") + F.col("opens").cast("bigint")
    return opened.select(
        *_PIECE, "opens", F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias("trips_before")
    )


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` as a table in the work folder."""
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def ignition_transitions(readings: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every reading with ``trip_start_flag`` and, for ON readings, the running ``trip_num``."""
    columns = ["customer_id", "vehicle_id", "event_ts", "tel_ignition_status"]
    flagged = _written(_ignition_flags(readings.select(*columns), bucket_seconds), "ignition")
    tagged = flagged.join(_carry(flagged), _PIECE)
    starts = F.when(F.col("first_in_piece"), F.col("opens")).otherwise(F.col("starts_inside"))
    return tagged.select(
        *columns,
        starts.cast("bigint").alias("trip_start_flag"),
        F.when(F.col("is_on"), _trip_number()).alias("trip_num"),
    )


def trip_groups(readings: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    return ignition_transitions(readings, bucket_seconds).where("tel_ignition_status = 'ON'")


def trip_boundaries(readings: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    return (
        trip_groups(readings, bucket_seconds)
        .where("trip_num > 0")
        .groupBy("customer_id", *_TRIP)
        .agg(F.min("event_ts").alias("trip_start_ts"), F.max("event_ts").alias("trip_end_ts"))
    )


def trip_runs(readings: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Collapse consecutive readings of one piece; partial sums replace the readings.

    A piece depends on its own readings only, so after late data just the touched (vehicle,
    bucket) pieces have to be computed again.
    """
    needed = ["customer_id", "vehicle_id", "event_ts", "tel_ignition_status", *_POSITION]
    flagged = _ignition_flags(
        readings.select(*needed, *_COUNTERS.values(), *_AVERAGED.values()), bucket_seconds
    )
    in_order = Window.partitionBy(*_PIECE).orderBy("event_ts")
    changes = (
        F.col("first_in_piece")
        | F.col("starts_inside")
        | (F.col("is_on") != F.col("prev_on"))
        | ~F.col("customer_id").eqNullSafe(F.col("prev_customer"))
    )
    numbered = flagged.withColumn(
        "run", F.sum(changes.cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    sums: list[Column] = []
    for name, column in _COUNTERS.items():
        sums += [F.min(column).alias(f"{name}_min"), F.max(column).alias(f"{name}_max")]
    for name, column in _AVERAGED.items():
        sums += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    return numbered.groupBy(*_PIECE, "run", "customer_id").agg(
        F.bool_or("is_on").alias("is_on"),
        F.bool_or("first_in_piece").alias("first_in_piece"),
        F.bool_or("starts_inside").alias("starts_inside"),
        F.max("started_so_far").alias("started_so_far"),
        F.max_by("rearms", "event_ts").alias("rearms"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        *[F.min_by(c, "event_ts").alias(f"first_{c}") for c in _POSITION],
        *[F.max_by(c, "event_ts").alias(f"last_{c}") for c in _POSITION],
        *sums,
        F.max("j1939_vehicle_speed_kph").alias("speed_max"),
    )


def _numbered(runs: DataFrame) -> DataFrame:
    numbered = runs.join(_carry(runs, "first_ts"), _PIECE).withColumn("trip_num", _trip_number())
    return numbered.where("trip_num > 0")


def _without_flapping(runs: DataFrame) -> DataFrame:
    """Numbered runs of a piece and trip, merged between the first and last ON runs of customers.

    A merged row counts as not ON, so it neither begins nor ends a span.  Rows per piece are
    bounded by its customers, whatever the ignition does.
    """
    in_trip = [*_PIECE, "trip_num"]
    by_time = Window.partitionBy(*in_trip).orderBy("first_ts")
    same = Window.partitionBy(*in_trip, "customer_id", "is_on")
    first, last = F.min("first_ts").over(same), F.max("first_ts").over(same)
    marked = runs.withColumn(
        "edge", F.col("is_on") & ((F.col("first_ts") == first) | (F.col("first_ts") == last))
    )
    cut = F.col("edge") | F.coalesce(F.lag("edge").over(by_time), F.lit(False))
    parts = marked.withColumn("cut", cut.cast("int")).withColumn("part", F.sum("cut").over(by_time))
    sums: list[Column] = []
    for name in _COUNTERS:
        sums += [F.min(f"{name}_min").alias(f"{name}_min"), F.max(f"{name}_max").alias(f"{name}_max")]
    for name in _AVERAGED:
        sums += [F.sum(f"{name}_{k}").alias(f"{name}_{k}") for k in ("sum", "n")]
    return parts.groupBy(*in_trip, "part").agg(
        F.min_by("customer_id", "first_ts").alias("customer_id"),
        F.bool_or("edge").alias("is_on"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        *[F.min_by(f"first_{c}", "first_ts").alias(f"first_{c}") for c in _POSITION],
        *[F.max_by(f"last_{c}", "first_ts").alias(f"last_{c}") for c in _POSITION],
        *sums,
        F.max("speed_max").alias("speed_max"),
    )


def _merged_trips(runs: DataFrame) -> DataFrame:
    """One row per (vehicle, trip) from its runs.

    A trip's readings are those between the first and the last ON reading *of each customer* seen
    in it; where two customers' spans overlap a reading counts once for each.  ``spans`` is that
    count, kept by a sweep over the runs: plus one at a customer's first ON run, minus one after
    the last.  With one customer per trip it is simply 1 up to the last ON run.
    """
    by_time = Window.partitionBy(*_TRIP).orderBy("first_ts")
    customer_runs = Window.partitionBy(*_TRIP, "customer_id", "is_on")
    up_to = by_time.rowsBetween(Window.unboundedPreceding, 0)
    before = by_time.rowsBetween(Window.unboundedPreceding, -1)
    marked = (
        # One shuffle on (vehicle, trip) serves every window and the final aggregate.
        runs.repartition(*_TRIP)
        .withColumns(
            {
                "begins": F.col("is_on") & (F.col("first_ts") == F.min("first_ts").over(customer_runs)),
                "ends": F.col("is_on") & (F.col("first_ts") == F.max("first_ts").over(customer_runs)),
            }
        )
        .withColumns(
            {
                "spans": F.count_if("begins").over(up_to) - F.coalesce(F.count_if("ends").over(before), F.lit(0)),
                "trip_customer": F.first("customer_id").over(up_to),
            }
        )
        .where("spans > 0")
    )

    def mean(name: str) -> Column:
        weight = F.col("spans")
        return F.try_divide(F.sum(F.col(f"{name}_sum") * weight), F.sum(F.col(f"{name}_n") * weight))

    def point(flag: str, side: str) -> Column:
        lat, lon = (F.col(f"{side}_{c}") for c in _POSITION)
        return F.when(F.col(flag), F.struct(lat.alias("lat"), lon.alias("lon")))

    own = F.col("customer_id").eqNullSafe(F.col("trip_customer")) & F.col("is_on")
    return marked.groupBy(*_TRIP).agg(
        F.min_by("customer_id", "first_ts").alias("customer_id"),
        F.min("first_ts").alias("trip_start_ts"),
        F.max(F.when(own, F.col("last_ts"))).alias("trip_end_ts"),
        F.min_by("first_gps_latitude", "first_ts").alias("start_lat"),
        F.min_by("first_gps_longitude", "first_ts").alias("start_lon"),
        F.max_by("last_gps_latitude", "first_ts").alias("end_lat"),
        F.max_by("last_gps_longitude", "first_ts").alias("end_lon"),
        *[(F.max(f"{n}_max") - F.min(f"{n}_min")).alias(n) for n in _COUNTERS],
        *[mean(n).alias(n) for n in _AVERAGED],
        F.max("speed_max").alias("speed_max"),
        # One point per customer seen in the trip, so nearly always a single one.
        F.collect_list(point("begins", "first")).alias("start_points"),
        F.collect_list(point("ends", "last")).alias("end_points"),
    )


def _with_fences(trips: DataFrame, fences: DataFrame) -> DataFrame:
    """Nearest fence of start and end in one pass: both ends are rows of one fence join."""

    def tagged(points: str, end: str) -> Column:
        return F.transform(points, lambda p: F.struct(F.lit(end).alias("end"), p.lat.alias("lat"), p.lon.alias("lon")))

    ends = trips.select(
        *[c for c in trips.columns if not c.endswith("_points")],
        F.explode(F.concat(tagged("start_points", "start"), tagged("end_points", "end"))).alias("_p"),
    )
    ends = ends.select("*", F.col("_p.end").alias("_end"), F.col("_p.lat").alias("_lat"), F.col("_p.lon").alias("_lon"))
    matched = fences_around(ends.drop("_p"), fences, "_lat", "_lon", how="left")
    carried = [c for c in trips.columns if not c.endswith("_points") and c not in _TRIP]

    def city(end: str) -> Column:
        inside = (F.col("_end") == end) & F.col("geofence_id").isNotNull()
        return F.min(F.when(inside, F.struct("distance_km", "geofence_id", "city_name")))["city_name"]

    return matched.groupBy(*_TRIP).agg(
        *[F.first(c).alias(c) for c in carried],
        city("start").alias("start_geofence"),
        city("end").alias("end_geofence"),
    )


def spans_of_runs(runs: DataFrame) -> DataFrame:
    """One row per trip, without fences, of runs that are cheap to read twice: a written table."""
    return _merged_trips(_without_flapping(_numbered(runs)))


def trips_from_runs(runs: DataFrame, fences: DataFrame) -> DataFrame:
    return trips_from_spans(spans_of_runs(runs), fences)


def trips_from_spans(spans: DataFrame, fences: DataFrame) -> DataFrame:
    trips = _with_fences(spans, fences)
    seconds = seconds_between(F.col("trip_start_ts"), F.col("trip_end_ts"))
    return trips.select(
        "customer_id",
        "vehicle_id",
        "trip_num",
        "trip_start_ts",
        "trip_end_ts",
        seconds.alias("duration_sec"),
        F.round(seconds / 60.0, 1).alias("duration_min"),
        "start_lat",
        "start_lon",
        "end_lat",
        "end_lon",
        F.round("odometer", 2).alias("distance_km"),
        F.round("fuel", 2).alias("fuel_consumed_l"),
        litres_per_100km(F.col("fuel"), F.col("odometer")).alias("fuel_efficiency_l_per_100km"),
        F.round("speed", 1).alias("avg_speed_kph"),
        F.round("speed_max", 1).alias("max_speed_kph"),
        F.round("rpm", 0).alias("avg_engine_rpm"),
        F.round("load", 1).alias("avg_engine_load_pct"),
        "start_geofence",
        "end_geofence",
    )


def trip_summaries(readings: DataFrame, fences: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    return trips_from_runs(_written(trip_runs(readings, bucket_seconds), "trip-runs"), fences)
