"""Named queries over the given tables.  Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlark import schema
from roadlark.functions import geo, hexagons, masks, rules, timing
from roadlark.operators import (
    curated,
    facts,
    governance,
    intervals,
    payloads,
    quantiles,
    reports,
    retention,
    spatial,
    text,
    trips,
)
from roadlark.plans.model import FleetModel
from roadlark.plans.refresh import IncrementalTables
from roadlark.plans.sql import register
from roadlark.session import speed_up, work_folder
from roadlark.sources import envelopes, files, masters
from roadlark.sources.events import landing, read_table, spread_landing
from roadlark.streaming import ingest, log, tables

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-31 00:00:00"
RETENTION_AS_OF = "2024-05-10 00:00:00"
TRACKED_VEHICLE = "VH_0000008"
TENANT = "CUST_0003"
ROLE = f"{TENANT}_ROLE"
SHARDS = 2  # folders per date of the given tables

QUERIES: dict[str, Query] = {}


def register_query(name: str, build: Query) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        speed_up(spark)
        return build(spark, sf_dir)

    QUERIES[name] = run


def query(fn: Query) -> Query:
    register_query(fn.__name__, fn)
    return fn


def model(spark: SparkSession, sf_dir: str, as_of: str = AS_OF, healthy=rules.HEALTHY_CAN) -> FleetModel:
    return FleetModel(
        landing(spark, sf_dir),
        masters.fences_from_nations(spark, sf_dir),
        masters.policies_from_customers(spark, sf_dir, as_of),
        masters.segments_from_suppliers(spark, sf_dir),
        as_of,
        healthy,
    )


def over_model(name: str, build: Callable[[FleetModel], DataFrame]) -> None:
    register_query(name, lambda spark, sf_dir: build(model(spark, sf_dir)))


# ---- sources and ingestion -----------------------------------------------------------------


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table as messages: some are broken in four ways, some have other forms of time
    and more metadata, which are no fault."""
    offset, value = F.col("offset"), F.col("value")
    return envelopes.to_envelope(spread_landing(spark, sf_dir)).withColumn(
        "value",
        F.when(offset % 86 == 4, F.concat(F.lit("broken:"), value))
        .when(offset % 86 == 8, F.regexp_replace(value, '"record_content"', '"content"'))
        .when(offset % 86 == 12, F.regexp_replace(value, '"vehicle_id":"[^"]*",', ""))
        .when(offset % 86 == 16, F.regexp_replace(value, '"gps_altitude_m":[^,]*,', '"gps_altitude_m":"high",'))
        .when(offset % 86 == 20, F.regexp_replace(value, r'("event_ts":"[^"]*)T', "$1 "))
        .when(offset % 86 == 24, F.regexp_replace(value, r'("event_ts":"[^"]*)"', '$1789"'))
        .when(offset % 86 == 28, F.regexp_replace(value, r'("event_ts":"[^"]*)"', '$1Z"'))
        .when(offset % 86 == 32, F.regexp_replace(value, '"partition":', '"headers":{"a":[1,"x"]},"push time":7,"partition":'))
        .otherwise(value),
    )


@query
def flatten_event(spark, sf_dir):
    parsed = envelopes.parse(damaged_messages(spark, sf_dir))
    rows = envelopes.flatten(parsed, F.col("ingest_ts"))
    return rows.select(
        F.col("record_metadata.offset").alias("offset"),
        F.col("record_metadata.other").alias("other_metadata"),
        *schema.names(schema.ALL_FIELDS),
        "ingest_ts",
    )


@query
def dlq_split(spark, sf_dir):
    parsed = envelopes.parse(damaged_messages(spark, sf_dir))
    return envelopes.dead_letters(parsed, ingest_ts=F.col("ingest_ts")).select(
        "error_message", "source_topic", "source_partition", "dlq_ingest_ts"
    )


@query
def dlq_by_key(spark, sf_dir):
    parsed = envelopes.parse(damaged_messages(spark, sf_dir))
    return envelopes.dead_letters_by_key(envelopes.dead_letters(parsed, ingest_ts=F.col("ingest_ts")))


def in_batches(rows: DataFrame, path: str) -> str:
    """Rows as files by ten-day periods of their ingest time, as many tasks as Spark likes; returns
    the pattern of the periods' folders."""
    period = F.floor(F.dayofyear("ingest_ts") / 10).alias("period")
    log.write_batch(rows.select("*", period), path, 0, ["period"])
    return f"{path}/batch_id=0/period=*"


@query
def ingest_stream(spark, sf_dir):
    """Counts per customer of what a message stream landed."""
    root = work_folder(spark, "ingest")
    folders = in_batches(damaged_messages(spark, sf_dir), f"{root}/messages")
    messages = ingest.file_messages(spark, folders)
    ingest.start_ingest(messages, f"{root}/landing", f"{root}/dead", f"{root}/checkpoint").awaitTermination()
    landed = log.read_log(spark, f"{root}/landing").groupBy("customer_id").agg(F.count("*").alias("landed"))
    dead = log.read_log(spark, f"{root}/dead").agg(F.lit("(dead letters)").alias("customer_id"), F.count("*").alias("landed"))
    return landed.unionByName(dead)


@query
def ingest_stream_audit(spark, sf_dir):
    """Totals that a running message stream has observed, over all of its batches."""
    root = work_folder(spark, "ingest-audit")
    messages = ingest.file_messages(spark, in_batches(damaged_messages(spark, sf_dir), f"{root}/messages"))
    ingest.start_ingest(
        messages, f"{root}/landing", f"{root}/dead", f"{root}/checkpoint", audit_path=f"{root}/audit"
    ).awaitTermination()
    totals = log.read_log(spark, f"{root}/audit").agg(F.sum("landed").alias("landed"), F.sum("dead").alias("dead"))
    produced = F.col("landed") + F.col("dead")
    return totals.select(produced.alias("produced"), "landed", "dead", F.round(F.col("landed") * 100.0 / produced, 2).alias("landed_pct"))


@query
def ingest_defaults(spark, sf_dir):
    """Messages without an ingest time get the time of their load; fields that are absent stay null."""
    messages = damaged_messages(spark, sf_dir)
    unstamped = F.when(F.col("offset") % 7 != 3, F.col("ingest_ts"))
    parsed = envelopes.parse(messages.withColumn("ingest_ts", unstamped))
    loaded = F.coalesce("ingest_ts", timing.as_ntz(AS_OF))
    rows = envelopes.flatten(parsed, loaded)
    return rows.select(F.col("record_metadata.offset").alias("offset"), "vehicle_id", "event_ts", "ingest_ts")


@query
def schema_evolution(spark, sf_dir):
    """Messages read with the first field list until mid-month and with all fields after."""
    messages = envelopes.to_envelope(landing(spark, sf_dir))
    switch = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    before = envelopes.parse(messages.where(F.col("ingest_ts") < switch), schema.PHASE1_CONTENT)
    after = envelopes.parse(messages.where(F.col("ingest_ts") >= switch))
    table = envelopes.evolve(*[envelopes.flatten(p, F.col("ingest_ts")) for p in (before, after)])
    return table.groupBy("vehicle_id").agg(
        F.count("*").alias("total"),
        F.count("j1939_tyre_pressure_front_left_kpa").alias("evolved"),
        F.count("j1939_def_level_pct").alias("with_def_level"),
    )


@query
def evolved_table(spark, sf_dir):
    """A stored landing table whose second batch has more fields than the first, read back whole."""
    path = work_folder(spark, "evolved")
    messages = envelopes.to_envelope(spread_landing(spark, sf_dir))
    switch = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    halves = F.col("ingest_ts") < switch, F.col("ingest_ts") >= switch
    for number, (half, fields) in enumerate(zip(halves, (schema.PHASE1_CONTENT, schema.CONTENT))):
        rows = envelopes.flatten(envelopes.parse(messages.where(half), fields), F.col("ingest_ts"))
        log.write_batch(rows, path, number)
    return log.read_log(spark, path).select(
        F.col("record_metadata.offset").alias("offset"), *schema.names(schema.ALL_FIELDS), "ingest_ts"
    )


over_model(
    "evolution_coverage",
    lambda m: m.raw.agg(
        F.count("*").alias("total"), F.count("j1939_tyre_pressure_front_left_kpa").alias("evolved")
    ),
)


@query
def ingest_audit(spark, sf_dir):
    parsed = envelopes.parse(damaged_messages(spark, sf_dir))
    phase = F.when(F.col("ingest_ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"), "phase 1")
    return envelopes.ingest_audit(parsed, phase.otherwise("phase 2"))


@query
def partition_skew(spark, sf_dir):
    vehicles = landing(spark, sf_dir).select("vehicle_id", envelopes.key_partition(F.col("vehicle_id"), 10).alias("partition"))
    return vehicles.groupBy("partition").agg(
        F.count("*").alias("messages"), F.countDistinct("vehicle_id").alias("vehicles")
    )


@query
def load_segments(spark, sf_dir):
    """Write the segment file as CSV and load it back with its declared schema."""
    path = work_folder(spark, "segments")
    rows = masters.segments_from_waypoints(masters.waypoints_from_suppliers(spark, sf_dir))
    rows.write.csv(path, header=True)
    return masters.read_segments(spark, path)


@query
def segments_enriched(spark, sf_dir):
    return masters.segments_from_suppliers(spark, sf_dir)


@query
def retention_policies(spark, sf_dir):
    return masters.policies_from_customers(spark, sf_dir, AS_OF)


@query
def geofences(spark, sf_dir):
    return masters.fences_from_nations(spark, sf_dir)


@query
def refresh_incremental(spark, sf_dir):
    """A first load and two increments by ingest time, out of event order."""
    return refreshed(spark, sf_dir).fact_vehicle_daily()


def refreshed(spark: SparkSession, sf_dir: str) -> IncrementalTables:
    built = IncrementalTables(spark, work_folder(spark, "refresh"), shards=SHARDS)
    raw = spread_landing(spark, sf_dir)
    cuts = [F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz") for day in (11, 21)]
    ts = F.col("ingest_ts")
    built.load(raw.where(ts < cuts[0]))
    built.apply(raw.where((ts >= cuts[0]) & (ts < cuts[1])), 1)
    built.apply(raw.where(ts >= cuts[1]), 2)
    return built


@query
def refresh_fleet(spark, sf_dir):
    return refreshed(spark, sf_dir).fact_customer_fleet()


@query
def refresh_vehicles(spark, sf_dir):
    return refreshed(spark, sf_dir).dim_vehicle(masters.policies_from_customers(spark, sf_dir, AS_OF))


@query
def refresh_customers(spark, sf_dir):
    return refreshed(spark, sf_dir).dim_customer(masters.policies_from_customers(spark, sf_dir, AS_OF), AS_OF)


@query
def refresh_health(spark, sf_dir):
    return refreshed(spark, sf_dir).fleet_health(AS_OF)


@query
def refresh_status(spark, sf_dir):
    return refreshed(spark, sf_dir).fleet_status()


@query
def refresh_status_lookup(spark, sf_dir):
    """One vehicle's state, from its own folder."""
    return refreshed(spark, sf_dir).fleet_status(TRACKED_VEHICLE)


@query
def refresh_trips(spark, sf_dir):
    return refreshed(spark, sf_dir).trip_summaries(masters.fences_from_nations(spark, sf_dir))


@query
def fleet_distinct_sketch(spark, sf_dir):
    """Exact distinct counts per customer, and whether those merged from stored daily sketches keep
    their error bound."""
    m, path = model(spark, sf_dir), work_folder(spark, "sketches")
    facts.distinct_sketches(m.readings).write.parquet(path)
    guessed = facts.distinct_estimates(spark.read.parquet(path), "customer_id")
    guessed = guessed.withColumnsRenamed({"customer_id": "id", "vehicles": "v", "devices": "d"})
    exact = m.readings.groupBy("customer_id").agg(
        F.countDistinct("vehicle_id").alias("vehicles"), F.countDistinct("device_id").alias("devices")
    )

    def near(estimate: str, count: str):
        return F.abs(F.col(estimate) - F.col(count)) <= F.greatest(F.lit(1.0), F.col(count) * facts.SKETCH_ERROR)

    joined = exact.join(guessed, F.col("customer_id").eqNullSafe(F.col("id")))
    return joined.select("customer_id", "vehicles", "devices", (near("v", "vehicles") & near("d", "devices")).alias("within_bound"))


# ---- curated layer -----------------------------------------------------------------------------

over_model("raw_count", lambda m: m.raw.agg(F.count("*").alias("raw_row_count")))
over_model("gps_signals", lambda m: m.signal("gps"))
over_model("imu_signals", lambda m: m.signal("imu"))
over_model("j1939_signals", lambda m: m.signal("j1939"))
over_model("telematics_signals", lambda m: m.signal("telematics"))
over_model(
    "arrived_late",
    lambda m: m.view("gps").select("vehicle_id", "event_ts", "ingest_ts", "arrived_late"),
)
over_model(
    "dedup_latest",
    lambda m: m.readings.select(*schema.SIGNAL_KEYS, "gps_speed_kph", F.col("record_metadata.offset").alias("offset")),
)
over_model("late_counts", lambda m: reports.counts_by(m.view("gps"), "arrived_late", name="event_count"))
over_model("late_distribution", lambda m: reports.share_of_total(m.signal("gps"), "arrived_late"))


def first_rows(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


over_model(
    "raw_preview",
    lambda m: first_rows(
        m.raw.select(
            "event_ts",
            "customer_id",
            "vehicle_id",
            "gps_latitude",
            "gps_longitude",
            "gps_speed_kph",
            "j1939_engine_rpm",
            "j1939_fuel_rate_lph",
            "j1939_coolant_temp_c",
            "j1939_active_dtc_count",
            "tel_ignition_status",
            "tel_can_bus_health",
        ),
        20,
        "event_ts",
        "vehicle_id",
        "gps_speed_kph",
    ),
)
over_model(
    "on_time_gps",
    lambda m: m.view("gps")
    .where("NOT arrived_late")
    .select(
        "event_ts",
        "vehicle_id",
        "gps_latitude",
        "gps_longitude",
        "gps_speed_kph",
        "gps_heading_deg",
        "gps_satellite_count",
        "arrived_late",
    ),
)
over_model(
    "high_rpm",
    lambda m: m.view("j1939")
    .where("j1939_engine_rpm > 2000")
    .select(
        "event_ts",
        "vehicle_id",
        "j1939_engine_rpm",
        "j1939_engine_load_pct",
        "j1939_fuel_rate_lph",
        "j1939_coolant_temp_c",
        "j1939_battery_voltage_v",
        "j1939_active_dtc_count",
        "j1939_brake_switch",
    ),
)
over_model(
    "harsh_driving",
    lambda m: m.view("imu")
    .where("abs(imu_accel_x_g) > 0.3")
    .select("event_ts", "vehicle_id", *schema.SIGNALS["imu"]),
)
over_model(
    "device_faults",
    lambda m: m.view("telematics")
    .where("tel_can_bus_health <> 'OK' OR tel_tamper_alert")
    .select(
        "event_ts",
        "vehicle_id",
        "tel_ignition_status",
        "tel_external_power_v",
        "tel_gsm_signal_dbm",
        "tel_network_type",
        "tel_can_bus_health",
        "tel_tamper_alert",
    ),
)

# One vehicle through all layers.


def of_vehicle(df: DataFrame) -> DataFrame:
    return df.where(F.col("vehicle_id") == TRACKED_VEHICLE)


over_model(
    "track_raw",
    lambda m: first_rows(
        of_vehicle(m.raw).select(
            "event_ts",
            "vehicle_id",
            "customer_id",
            "gps_latitude",
            "gps_longitude",
            "gps_speed_kph",
            "j1939_engine_rpm",
            "j1939_fuel_rate_lph",
            "j1939_coolant_temp_c",
            "tel_ignition_status",
            "ingest_ts",
        ),
        20,
        "event_ts",
        "ingest_ts",
    ),
)
over_model(
    "track_gps",
    lambda m: first_rows(of_vehicle(m.view("gps")), 20, "event_ts", "ingest_ts").select(
        "event_ts",
        "vehicle_id",
        "gps_latitude",
        "gps_longitude",
        "gps_speed_kph",
        "gps_heading_deg",
        "arrived_late",
    ),
)
over_model(
    "track_j1939",
    lambda m: first_rows(of_vehicle(m.view("j1939")), 20, "event_ts", "ingest_ts").select(
        "event_ts",
        "vehicle_id",
        "j1939_engine_rpm",
        "j1939_fuel_rate_lph",
        "j1939_coolant_temp_c",
        "j1939_active_dtc_count",
        "j1939_odometer_km",
    ),
)
over_model(
    "track_trips",
    lambda m: of_vehicle(m.trips).select(
        "vehicle_id",
        "trip_num",
        "trip_start_ts",
        "trip_end_ts",
        F.round("duration_min", 1).alias("mins"),
        F.round("distance_km", 1).alias("km"),
        F.round("fuel_consumed_l", 1).alias("fuel_l"),
        F.round("fuel_efficiency_l_per_100km", 2).alias("fuel_eff"),
        "start_geofence",
        "end_geofence",
    ),
)
over_model(
    "track_health",
    lambda m: of_vehicle(m.health).select(
        "vehicle_id",
        "health_status",
        "max_dtc_count",
        "has_can_bus_issues",
        F.round("max_coolant_temp_c", 1).alias("max_coolant_c"),
        F.round("current_odometer_km", 0).alias("odometer_km"),
    ),
)
over_model(
    "fleet_stats",
    # Distinct triples first: three distinct counts over all rows would triple the rows.
    lambda m: m.raw.groupBy("customer_id", "vehicle_id", "device_id")
    .agg(F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"))
    .agg(
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct("vehicle_id").alias("vehicles"),
        F.countDistinct("device_id").alias("devices"),
        F.min("first_ts").alias("earliest_event"),
        F.max("last_ts").alias("latest_event"),
    ),
)

# ---- facts, dimensions, health, 360 ----------------------------------------------------------

over_model("fact_vehicle_daily", lambda m: m.vehicle_daily)
over_model("fact_customer_fleet", lambda m: m.fleet_daily)
over_model("dim_vehicle", lambda m: m.vehicles)
over_model("dim_customer", lambda m: m.customers)
over_model("telematics_health", lambda m: facts.telematics_health(m.readings, m.healthy))
over_model("fleet_health", lambda m: m.health)
register_query("fleet_health_strict", lambda spark, sf_dir: model(spark, sf_dir, healthy=rules.STRICT_CAN).health)
over_model("vehicle360", lambda m: m.vehicle_360)
over_model("customer360", lambda m: m.customer_360)
over_model("realtime_fleet_status", lambda m: m.status)
over_model(
    "fuel_efficiency",
    lambda m: m.vehicle_360.select("vehicle_id", "customer_id", "metric_date", "fuel_efficiency_l_per_100km"),
)
over_model("at_risk_vehicles", lambda m: reports.at_risk_vehicles(m.health))
over_model("health_breakdown", lambda m: reports.counts_by(m.health, "health_status", name="vehicle_count"))
over_model("health_cards", lambda m: reports.health_cards(m.health))
over_model(
    "health_scatter",
    lambda m: m.health.select("vehicle_id", "max_coolant_temp_c", "min_battery_voltage_v", "health_status"),
)
over_model(
    "status_breakdown",
    lambda m: reports.counts_by(m.status, "health_status", "ignition_status", name="vehicle_count"),
)
over_model(
    "dtc_histogram",
    lambda m: reports.counts_by(m.health.where("max_dtc_count > 0"), "max_dtc_count", name="vehicles"),
)
over_model(
    "odometer_quantiles",
    lambda m: quantiles.exact_quantiles(m.health, "health_status", "current_odometer_km"),
)
over_model("top_fuel_days", lambda m: reports.top_fuel_days(m.vehicle_daily))
over_model("top_customers", lambda m: reports.top_customers(m.customers, m.fleet_daily))
over_model("top_vehicles", lambda m: reports.top_vehicles(m.vehicles))

# ---- trips and place -----------------------------------------------------------------------------

over_model(
    "ignition_transitions",
    lambda m: trips.ignition_transitions(m.readings).select(
        "customer_id", "vehicle_id", "event_ts", "tel_ignition_status", "trip_start_flag"
    ),
)
over_model("trip_groups", lambda m: trips.trip_groups(m.readings))
over_model("trip_boundaries", lambda m: trips.trip_boundaries(m.readings))
over_model(
    "trip_endpoints",
    lambda m: m.trips.select("vehicle_id", "trip_num", "start_lat", "start_lon", "end_lat", "end_lon"),
)
over_model("trip_summaries", lambda m: m.trips)


def trip_readings(m: FleetModel) -> DataFrame:
    """Per trip and customer: readings inside the trip's time span, by interval join."""
    spans = trips.trip_boundaries(m.readings).withColumnRenamed("customer_id", "trip_customer_id")
    inside = intervals.interval_join(
        m.readings.select("vehicle_id", "event_ts", "j1939_vehicle_speed_kph", "j1939_engine_rpm"),
        spans,
        "vehicle_id",
        "event_ts",
        "trip_start_ts",
        "trip_end_ts",
    )
    return inside.groupBy("trip_customer_id", "vehicle_id", "trip_num").agg(
        F.count("*").alias("readings"),
        F.sum("j1939_vehicle_speed_kph").alias("speed_sum"),
        F.max("j1939_engine_rpm").alias("max_rpm"),
    )


over_model("interval_join_trips", trip_readings)


def fenced_readings(m: FleetModel) -> DataFrame:
    found = spatial.match_nearest_fence(
        m.signal("gps"), m.fences, ["vehicle_id", "event_ts"], "gps_latitude", "gps_longitude"
    )
    return found.withColumn("distance_km", F.round("distance_km", 6))


over_model("geofence_match", fenced_readings)
over_model(
    "signal_align",
    lambda m: curated.align_signals(
        m.signal("gps").select("vehicle_id", "event_ts", "gps_latitude", "gps_longitude", "gps_speed_kph"),
        m.signal("j1939").select("vehicle_id", "event_ts", "j1939_fuel_rate_lph", "j1939_engine_rpm"),
    ),
)
over_model(
    "road_segment_join",
    lambda m: spatial.readings_on_segments(
        m.signal("gps").select("vehicle_id", "customer_id", "event_ts", "gps_latitude", "gps_longitude"), m.segments
    ),
)
over_model("monthly_segment_efficiency", lambda m: m.segment_efficiency)

# ---- scorecard, alerts, dashboard --------------------------------------------------------------

over_model("driver_scorecard", lambda m: m.scorecard)
over_model("scorecard_top", lambda m: reports.scorecard_top(m.scorecard))
over_model("grade_distribution", lambda m: reports.counts_by(m.scorecard, "driver_grade", name="vehicle_count"))
over_model("worst_efficiency", lambda m: reports.worst_efficiency(m.scorecard))
over_model("eff_by_grade", lambda m: reports.efficiency_by_grade(m.scorecard))
over_model(
    "grade_scatter",
    lambda m: m.scorecard.select("vehicle_id", "customer_id", "avg_speed", "avg_fuel_eff", "driver_grade", "total_km"),
)
over_model("speed_alert_report", lambda m: m.alerts)
over_model("top_speed_alerts", lambda m: reports.top_speed_alerts(m.alerts))
over_model("alert_distribution", lambda m: reports.counts_by(m.alerts, "speed_alert_level", name="alert_count"))
over_model("violations_by_customer", lambda m: reports.violations_by_customer(m.alerts))
over_model("speed_quantiles", lambda m: quantiles.exact_quantiles(m.alerts, "speed_alert_level", "max_speed_kph"))
over_model("customer_fleet_report", lambda m: reports.customer_fleet_report(m.scorecard, TENANT))
over_model("speed_violations", lambda m: reports.speed_violations(m.trips, TENANT, 80.0))
over_model("top_trips", lambda m: reports.top_trips(m.trips))
over_model("longest_trips", lambda m: reports.longest_trips(m.trips))
over_model("top_routes", lambda m: reports.top_routes(m.trips))
over_model("trip_averages", lambda m: reports.trip_averages(m.trips))
over_model("distance_histogram", lambda m: quantiles.histogram(m.trips, "distance_km", 30))
over_model(
    "trip_scatter",
    lambda m: m.trips.select("vehicle_id", "trip_num", "distance_km", "fuel_efficiency_l_per_100km", "avg_speed_kph"),
)
over_model("kpi_row", lambda m: reports.kpi_row(m.trips, m.health))
over_model(
    "kpi_row_customer",
    lambda m: reports.kpi_row(*[reports.for_customer(t, TENANT) for t in (m.trips, m.health)]),
)

# ---- scalar functions ------------------------------------------------------------------------------


def fence_distances(m: FleetModel) -> DataFrame:
    """Each located reading with the fence of its own event number: an equi join, no pairs."""
    fence = F.concat(F.lit("GF_"), F.lpad((F.floor(F.col("record_metadata.offset") / 2) % 25).cast("string"), 2, "0"))
    rows = m.readings.select("vehicle_id", "event_ts", "gps_latitude", "gps_longitude", fence.alias("geofence_id"))
    return rows.join(m.fences.select("geofence_id", "latitude", "longitude", "radius_km"), "geofence_id")


def pair_columns() -> list:
    return [F.col(c) for c in ("gps_latitude", "gps_longitude", "latitude", "longitude")]


over_model(
    "haversine",
    lambda m: fence_distances(m).select(
        "vehicle_id", "event_ts", F.round(geo.haversine_km(*pair_columns()), 4).alias("km")
    ),
)
over_model(
    "great_circle_acos",
    lambda m: fence_distances(m).select(
        "vehicle_id", "event_ts", F.round(geo.great_circle_km(*pair_columns()), 3).alias("km")
    ),
)
over_model(
    "in_geofence",
    lambda m: fence_distances(m).select(
        "vehicle_id",
        "event_ts",
        geo.in_fence(*pair_columns(), F.col("radius_km")).alias("inside"),
        geo.in_fence(*pair_columns(), 400.0).alias("inside_400km"),
    ),
)
over_model(
    "geo_cell",
    lambda m: m.readings.select(
        "vehicle_id",
        "event_ts",
        geo.geo_cell(F.col("gps_latitude"), F.col("gps_longitude"), 7).alias("cell_res7"),
        geo.geo_cell(F.col("gps_latitude"), F.col("gps_longitude"), 9).alias("cell_res9"),
    ),
)


over_model(
    "hex_cell",
    lambda m: hexagons.with_hex_cell(
        hexagons.with_hex_cell(
            m.readings.select("vehicle_id", "event_ts", "gps_latitude", "gps_longitude"),
            "cell_res7",
            "gps_latitude",
            "gps_longitude",
            7,
        ),
        "cell_res9",
        "gps_latitude",
        "gps_longitude",
        9,
    ).drop("gps_latitude", "gps_longitude"),
)


def _density(m: FleetModel) -> DataFrame:
    places = m.readings.select("vehicle_id", "gps_latitude", "gps_longitude")
    cells = hexagons.with_hex_id(places, "cell", "gps_latitude", "gps_longitude", 7).where("cell IS NOT NULL")
    vehicles = cells.groupBy("cell", "vehicle_id").agg(F.count("*").alias("n"))
    around = vehicles.groupBy(hexagons.hex_parent(F.col("cell"), 4).alias("around")).agg(
        F.countDistinct("cell").alias("cells"), F.countDistinct("vehicle_id").alias("vehicles"), F.sum("n").alias("readings")
    )
    return around.select(F.lower(F.hex("around")).alias("cell_res4"), "cells", "vehicles", "readings")


over_model("hex_density", _density)


@query
def curved_box(spark, sf_dir):
    """Readings of some vehicles in ten days and a box of places, from files along a curve through
    vehicle, time and place."""
    path, rows = work_folder(spark, "curved"), model(spark, sf_dir).readings
    rows = rows.select("vehicle_id", "event_ts", "gps_latitude", "gps_longitude", "gps_speed_kph")
    number = F.substring("vehicle_id", 4, 18).cast("long")
    files.write_curved(
        rows.withColumn("vehicle_no", number),
        path,
        {
            "vehicle": F.col("vehicle_no"),
            "time": timing.epoch_seconds(F.col("event_ts")),
            "lat": F.col("gps_latitude"),
            "lon": F.col("gps_longitude"),
        },
        16,
    )
    box = "vehicle_no BETWEEN 10 AND 60 AND event_ts >= timestamp_ntz'2024-01-05 00:00:00' AND event_ts < timestamp_ntz'2024-01-15 00:00:00' AND gps_latitude BETWEEN 10 AND 20"
    return spark.read.parquet(path).where(box).drop("vehicle_no")


def segment_ends() -> list:
    return [F.col(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")]


over_model(
    "segment_bearing",
    lambda m: m.segments.select("segment_id", F.round(geo.bearing_deg(*segment_ends()), 4).alias("bearing")),
)
over_model(
    "segment_geometry",
    lambda m: m.segments.select(
        "segment_id", "route_name", "mid_lat", "mid_lon", F.round(geo.haversine_km(*segment_ends()), 1).alias("km")
    ),
)
over_model(
    "interpolate",
    lambda m: m.segments.select(
        "segment_id",
        geo.interpolate(F.col("start_lat"), F.col("end_lat"), 0.25).alias("lat"),
        geo.interpolate(F.col("start_lon"), F.col("end_lon"), 0.25).alias("lon"),
    ),
)
over_model(
    "engine_health_grade",
    lambda m: m.view("j1939").select(
        "vehicle_id",
        "event_ts",
        "ingest_ts",
        rules.engine_health_grade(
            F.col("j1939_coolant_temp_c"),
            F.col("j1939_active_dtc_count"),
            F.col("j1939_battery_voltage_v"),
            F.col("j1939_oil_pressure_kpa"),
        ).alias("engine_grade"),
    ),
)
over_model(
    "kmh_to_mph",
    lambda m: m.raw.select(
        "vehicle_id",
        "event_ts",
        F.col("gps_speed_kph").alias("speed_kmh"),
        rules.kmh_to_mph(F.col("gps_speed_kph")).alias("speed_mph"),
    ),
)


@query
def string_funcs(spark, sf_dir):
    name = F.col("c_name")
    return read_table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("CUST_"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("padded"),
        F.lower("c_mktsegment").alias("lowered"),
        F.replace(name, F.lit("Customer#"), F.lit("")).alias("replaced"),
        F.right(name, F.lit(4)).alias("tail"),
        masks.mask_email(F.concat(F.lower("c_mktsegment"), F.lit("@fleet.example"))).alias("masked"),
        name.like("%7").alias("ends_with_7"),
    )


over_model(
    "math_funcs",
    lambda m: m.readings.select(
        "vehicle_id",
        "event_ts",
        F.round(F.cos(F.radians("gps_latitude")), 6).alias("cos_lat"),
        F.round(F.sin(F.radians("gps_longitude")), 6).alias("sin_lon"),
        F.round(F.atan2(F.col("imu_accel_y_g"), F.col("imu_accel_x_g")), 6).alias("accel_angle"),
        F.round(
            F.sqrt(F.pow("imu_accel_x_g", 2.0) + F.pow("imu_accel_y_g", 2.0) + F.pow("imu_accel_z_g", 2.0)), 6
        ).alias("accel_norm"),
        F.abs("imu_gyro_x_dps").alias("abs_gyro"),
        (F.col("gps_satellite_count") % 4).alias("sat_mod"),
        F.least("gps_speed_kph", F.lit(80.0)).alias("capped"),
        F.greatest("gps_speed_kph", F.lit(20.0)).alias("floored"),
    ),
)
over_model(
    "date_funcs",
    lambda m: m.raw.select(
        "vehicle_id",
        "event_ts",
        "ingest_ts",
        timing.day_start(F.col("event_ts")).alias("day"),
        timing.month_start(F.col("event_ts")).alias("month"),
        timing.days_before(F.col("event_ts"), 7).alias("week_before"),
        timing.seconds_between(F.col("event_ts"), F.col("ingest_ts")).alias("seconds"),
        timing.minutes_between(F.col("event_ts"), timing.as_ntz(AS_OF)).alias("minutes"),
    ),
)


@query
def json_payload(spark, sf_dir):
    """The JSON column of the events, read by path with typed casts."""
    events = read_table(spark, sf_dir, "events")
    value = payloads.as_variant(F.col("props"))
    return events.select(
        "event_id",
        "ts",
        payloads.payload_field(value, "$.k", "int").alias("k"),
        payloads.payload_field(value, "$.k", "double").alias("k_double"),
        payloads.payload_field(value, "$.missing", "string").alias("missing"),
    )


def vehicle_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as (vehicle_id, event_time, plant_region, payload), the payload a JSON variant."""
    speed = F.col("gps_speed_kph")
    body = F.struct(
        speed.cast("int").alias("speed_kph"),
        F.col("gps_latitude").alias("lat"),
        F.col("gps_longitude").alias("lon"),
        F.concat(F.lit("Model "), F.col("gps_fix_quality").cast("string")).alias("model"),
        F.when(F.col("j1939_brake_switch"), F.col("j1939_engine_rpm").cast("int")).alias("engine_rpm"),
        F.when(speed > 90, "OVERSPEED").when(speed > 5, "MOVING").otherwise("IDLE").alias("event"),
    )
    return landing(spark, sf_dir).select(
        "vehicle_id",
        F.col("event_ts").alias("event_time"),
        F.col("customer_id").alias("plant_region"),
        payloads.as_variant(F.to_json(body)).alias("payload"),
    )


@query
def json_typed(spark, sf_dir):
    return payloads.typed_payload(vehicle_payloads(spark, sf_dir)).orderBy(F.desc("event_time"), "vehicle_id")


@query
def json_filter(spark, sf_dir):
    moving = payloads.with_event(vehicle_payloads(spark, sf_dir), "MOVING")
    return moving.select(
        "vehicle_id", "event_time", payloads.payload_field(F.col("payload"), "$.speed_kph", "int").alias("speed")
    )


# ---- the same tables through SQL ---------------------------------------------------------------


def over_sql(name: str, statement: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register(spark, model(spark, sf_dir))
        return spark.sql(statement)

    register_query(name, run)


over_sql("sql_fleet_report", f"SELECT * FROM get_customer_fleet_report('{TENANT}')")
over_sql("sql_speed_violations", f"SELECT * FROM get_speed_violations('{TENANT}', 80)")
over_sql(
    "sql_functions",
    """
    SELECT vehicle_id, event_ts, ingest_ts, kmh_to_mph(j1939_vehicle_speed_kph) AS speed_mph,
      engine_health_grade(j1939_coolant_temp_c, j1939_active_dtc_count, j1939_battery_voltage_v,
        j1939_oil_pressure_kpa) AS engine_grade
    FROM vw_j1939_signals_v1""",
)

# ---- governance and retention ------------------------------------------------------------------

VEHICLE_MASKS = {"driver_email": masks.mask_email, "device_serial_number": masks.mask_serial}


def registry_of(m: FleetModel) -> DataFrame:
    return governance.customer_vehicles(m.vehicles, m.policies)


@query
def customer_vehicles(spark, sf_dir):
    """Written as a table and read back."""
    path = work_folder(spark, "customer-vehicles")
    registry_of(model(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


over_model("row_policy", lambda m: governance.rows_of_role(m.trips, ROLE))
over_model("mask_email", lambda m: governance.secured(registry_of(m), ROLE, VEHICLE_MASKS))
over_model(
    "tenant_customers",
    lambda m: governance.secured(registry_of(m), ROLE, VEHICLE_MASKS).select("customer_id").distinct(),
)


over_model(
    "tenant_counts",
    lambda m: governance.visible_counts(registry_of(m), ["ACCOUNTADMIN", ROLE, "CUST_0002_ROLE"]),
)


def driver_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    homes = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    key = masters.padded(F.col("c_custkey"), 7)
    return customer.join(homes, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("D-"), key).alias("driver_id"),
        F.col("c_name").alias("driver_name"),
        F.concat(F.lit("+91-98"), key).alias("phone"),
        F.concat(F.lit("DL-"), key).alias("license_no"),
        F.concat(F.lit("VIN"), key).alias("vin"),
        F.col("r_name").alias("dealer_region"),
    )


PROFILE_TAGS = {"phone": "PHONE_NUMBER", "license_no": "LICENSE", "vin": "VEHICLE_VIN"}


@query
def mask_columns(spark, sf_dir):
    rules_by_column = {"phone": masks.mask_phone, "license_no": masks.mask_license, "vin": masks.mask_vin}
    return governance.masked(driver_profiles(spark, sf_dir), "ANALYST", rules_by_column, governance.PLATFORM_ADMINS)


@query
def mask_by_tag(spark, sf_dir):
    return governance.masked_by_tags(governance.tagged(driver_profiles(spark, sf_dir), PROFILE_TAGS), "ANALYST")


@query
def region_policy(spark, sf_dir):
    return governance.rows_of_region(driver_profiles(spark, sf_dir), "ANALYST", "dealer_region", "ASIA")


@query
def policy_listing(spark, sf_dir):
    return (
        masters.policies_from_customers(spark, sf_dir, AS_OF)
        .select(
            "customer_id",
            "customer_name",
            "raw_retention_days",
            "curated_retention_days",
            "trip_retention_days",
            "video_retention_days",
        )
        .orderBy("customer_id")
        .limit(10)
    )


over_model(
    "retention_keep",
    lambda m: retention.retained(
        m.raw.select("vehicle_id", "customer_id", "event_ts", "ingest_ts"), m.policies, RETENTION_AS_OF
    ),
)
over_model("retention_deleted", lambda m: retention.deleted_per_customer(m.raw, m.policies, RETENTION_AS_OF))
over_model("retention_message", lambda m: retention.deletion_message(m.raw, m.policies, RETENTION_AS_OF))


def after_retention(m: FleetModel) -> DataFrame:
    kept = retention.retained(m.raw, m.policies, RETENTION_AS_OF)
    return FleetModel(kept, m.fences, m.policies, m.segments, RETENTION_AS_OF).vehicle_daily


over_model("retention_propagate", after_retention)


def after_deletion(spark: SparkSession, sf_dir: str) -> IncrementalTables:
    built = refreshed(spark, sf_dir)
    built.retain(masters.policies_from_customers(spark, sf_dir, AS_OF), RETENTION_AS_OF)
    return built


@query
def retention_applied(spark, sf_dir):
    """What is left in storage after the expired deliveries were deleted."""
    return after_deletion(spark, sf_dir).readings().select("vehicle_id", "customer_id", "event_ts", "ingest_ts")


@query
def retention_daily(spark, sf_dir):
    return after_deletion(spark, sf_dir).fact_vehicle_daily()


@query
def retention_health(spark, sf_dir):
    return after_deletion(spark, sf_dir).fleet_health(RETENTION_AS_OF)


@query
def retention_trips(spark, sf_dir):
    return after_deletion(spark, sf_dir).trip_summaries(masters.fences_from_nations(spark, sf_dir))

# ---- streaming -------------------------------------------------------------------------------------


def stream_source(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The landing table written as files and read back as a stream of several batches."""
    return tables.landing_stream(spark, in_batches(landing(spark, sf_dir), f"{root}/source"))


@query
def stream_dedup(spark, sf_dir):
    root = work_folder(spark, "dedup")
    kept = tables.LatestReadings(spark, f"{root}/out", SHARDS)
    tables.start_dedup(stream_source(spark, sf_dir, root), kept, f"{root}/checkpoint").awaitTermination()
    return kept.readings().select(*schema.SIGNAL_KEYS, "gps_speed_kph")


@query
def stream_fleet_status(spark, sf_dir):
    return streamed_tables(spark, sf_dir).fleet_status()


@query
def stream_late_counts(spark, sf_dir):
    root = work_folder(spark, "late")
    counts = tables.late_by_day(stream_source(spark, sf_dir, root))
    tables.start_update(counts, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return log.newest_version(log.read_log(spark, f"{root}/out"), ["metric_date", "arrived_late"])


def streamed_tables(spark: SparkSession, sf_dir: str) -> IncrementalTables:
    root = work_folder(spark, "tables")
    built = IncrementalTables(spark, f"{root}/tables", shards=SHARDS)
    tables.start_refresh(stream_source(spark, sf_dir, root), built, f"{root}/checkpoint").awaitTermination()
    return built


@query
def stream_daily_metrics(spark, sf_dir):
    return streamed_tables(spark, sf_dir).fact_vehicle_daily()


@query
def stream_trips(spark, sf_dir):
    return streamed_tables(spark, sf_dir).trip_summaries(masters.fences_from_nations(spark, sf_dir))


# ---- text ------------------------------------------------------------------------------------------


@query
def text_sentiment(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.sentiment(docs, text.lexicon(), "doc_id", "text")


@query
def text_summary(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.summary(docs, "doc_id", "text")


def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text around a JSON object, as a language model returns it; some without an object."""
    n = F.col("event_id")
    answer = F.to_json(
        F.struct(
            F.when(n % 4 == 0, "Wet").when(n % 4 == 1, "Potholed").otherwise("Dry").alias("road_condition"),
            F.when(n % 3 == 0, "Rain").otherwise("Clear").alias("weather"),
            F.when(n % 5 == 0, "Poor").otherwise("Good").alias("visibility"),
            F.concat(F.lit("truck, "), F.col("event_type")).alias("objects_detected"),
            F.when(n % 4 == 0, "HIGH").otherwise("LOW").alias("safety_risk"),
            F.when(n % 4 == 0, "Slow down.").alias("recommended_action"),
        )
    )
    reply = F.when(n % 10 == 9, F.lit("I cannot tell.")).otherwise(
        F.concat(F.lit("Here is the analysis:\n"), answer, F.lit("\nStay safe."))
    )
    return read_table(spark, sf_dir, "events").select("event_id", reply.alias("reply"))


@query
def structured_extract(spark, sf_dir):
    return text.structured_answers(model_answers(spark, sf_dir), "reply")
