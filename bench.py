"""Timing of the pipeline and its headline queries; prints one JSON line.

The raw table is landed and the curated and business tables are written once, as a deployment
would do; the reports then run on the written tables.  Every figure is one timed run, after one
untimed small query that starts the executor threads.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlark.operators import facts, quantiles, reports, retention, spatial, trips
from roadlark.plans import registry
from roadlark.plans.model import FleetModel
from roadlark.plans.refresh import IncrementalTables
from roadlark.session import build_session, work_folder
from roadlark.sources import masters
from roadlark.sources.events import landing, read_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = work_folder(spark, "bench")
    seconds: dict[str, float] = {}

    def timed(name: str, run: Callable[[], object]) -> None:
        started = time.time()
        run()
        seconds[name] = round(time.time() - started, 3)

    drain(read_table(spark, SF_DIR, "nation").groupBy("n_regionkey").count())
    timed("ingest_raw", lambda: landing(spark, SF_DIR).write.parquet(f"{root}/raw"))
    raw = spark.read.parquet(f"{root}/raw")
    live = FleetModel(
        raw,
        masters.fences_from_nations(spark, SF_DIR),
        masters.policies_from_customers(spark, SF_DIR, registry.AS_OF),
        masters.segments_from_suppliers(spark, SF_DIR),
        registry.AS_OF,
    )
    timed("curate_readings", lambda: live.readings.write.parquet(f"{root}/readings"))
    live.readings = spark.read.parquet(f"{root}/readings")
    for name in FleetModel.SAVED:
        timed(name, lambda: getattr(live, name).write.parquet(f"{root}/{name}"))
    for name in FleetModel.SAVED:
        setattr(live, name, spark.read.parquet(f"{root}/{name}"))

    timed("dedup_latest", lambda: drain(FleetModel.signal(live, "gps")))
    timed("interval_join_trips", lambda: drain(registry.trip_readings(live)))
    timed("geofence_match", lambda: drain(registry.fenced_readings(live)))
    timed(
        "monthly_segment_efficiency",
        lambda: drain(spatial.monthly_segment_efficiency(live.readings, live.segments)),
    )
    timed("telematics_health", lambda: drain(facts.telematics_health(live.readings)))
    timed("trip_boundaries", lambda: drain(trips.trip_boundaries(live.readings)))
    timed("late_distribution", lambda: drain(reports.share_of_total(live.signal("gps"), "arrived_late")))
    timed("driver_scorecard", lambda: drain(live.scorecard))
    timed("speed_quantiles", lambda: drain(quantiles.exact_quantiles(live.alerts, "speed_alert_level", "max_speed_kph")))
    timed("top_routes", lambda: drain(reports.top_routes(live.trips)))
    timed("kpi_row", lambda: drain(reports.kpi_row(live.trips, live.health)))
    timed(
        "retention_deleted",
        lambda: drain(retention.deleted_per_customer(raw, live.policies, registry.RETENTION_AS_OF)),
    )
    built = IncrementalTables(spark, f"{root}/tables", shards=registry.SHARDS)
    last_day = F.col("ingest_ts") >= F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    timed("refresh_first_load", lambda: built.load(raw.where(~last_day)))
    timed("refresh_last_day", lambda: built.apply(raw.where(last_day), 1))
    timed("status_lookup", lambda: drain(built.fleet_status(registry.TRACKED_VEHICLE)))
    timed("hex_cell", lambda: drain(registry.QUERIES["hex_cell"](spark, SF_DIR)))
    timed("text_sentiment", lambda: drain(registry.text_sentiment(spark, SF_DIR)))
    timed("text_summary", lambda: drain(registry.text_summary(spark, SF_DIR)))

    rows = raw.count()
    pipeline = sum(seconds[n] for n in ("ingest_raw", "curate_readings", *FleetModel.SAVED))
    result = {
        "metric": "pipeline and headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "raw_rows": rows,
        "pipeline_rows_per_sec": round(rows / pipeline),
        "ingest_rows_per_sec": round(rows / seconds["ingest_raw"]),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
