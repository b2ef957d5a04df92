"""What the optimizer must do for the plans to hold at scale."""

import re

import pyarrow.parquet as pq
from helpers import deliveries, plan_of
from pyspark.sql import functions as F

from roadlark.operators import curated, facts
from roadlark.plans import registry
from roadlark.sources import events, files
from roadlark.sources.files import write_clustered


def stored(spark, tmp_path):
    rows = [{"t": i * 3600, "vehicle_id": f"VH_{i % 7}", "gps_speed_kph": float(i)} for i in range(200)]
    write_clustered(deliveries(spark, rows), f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    df = stored(spark, tmp_path)
    gps = curated.signal_view(df.where("event_date = '2024-01-03' AND vehicle_id = 'VH_1'"), "gps")
    plan = plan_of(gps.select("gps_speed_kph", "arrived_late"))
    assert "EqualTo(vehicle_id,VH_1)" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(c.split(":")[0] for c in read.split(",")) == {"event_ts", "vehicle_id", "gps_speed_kph", "ingest_ts"}


def test_files_are_sorted_by_vehicle(spark, tmp_path):
    stored(spark, tmp_path)
    for part in spark.read.parquet(f"{tmp_path}/t").select("event_date").distinct().collect()[:3]:
        rows = spark.read.parquet(f"{tmp_path}/t/event_date={part[0]}").select("vehicle_id", "event_ts").collect()
        assert rows == sorted(rows)


def test_deduplication_is_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(registry.model(spark, sf_dir).signal("gps"))
    partial, exchange = plan.index(", Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial  # the plan is printed from the top down
    assert plan.count("Exchange hashpartitioning") == 1
    assert "j1939" not in plan


def test_daily_facts_combine_before_the_shuffle(spark, sf_dir):
    plan = plan_of(registry.model(spark, sf_dir).vehicle_daily)
    assert "HashAggregate" in plan and "partial_avg" in plan and "SortAggregate" not in plan


def test_aligning_signals_adds_no_shuffle(spark, sf_dir):
    plan = plan_of(registry.QUERIES["signal_align"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 2


def test_no_pairs_and_no_python(spark, sf_dir):
    for name in ("trip_summaries", "interval_join_trips", "geofence_match", "kpi_row", "distance_histogram", "text_summary"):
        plan = plan_of(registry.QUERIES[name](spark, sf_dir))
        for word in ("Cartesian", "NestedLoop", "Python"):
            assert word not in plan, (name, word)


def test_no_window_spans_the_readings_of_a_vehicle(spark, sf_dir):
    """Only the one-row-per-bucket table is partitioned by vehicle alone."""
    plan = plan_of(registry.QUERIES["trip_summaries"](spark, sf_dir))
    alone = re.findall(r"Exchange hashpartitioning\(vehicle_id#\d+, \d+\)", plan)
    assert len(alone) == 1


def test_hot_vehicle_is_spread(spark):
    """One vehicle owns most rows; its pieces still land in several tasks with the same trips."""
    rows = [{"t": i * 60, "vehicle_id": "hot", "tel_ignition_status": "OFF" if i % 50 == 0 else "ON"} for i in range(3000)]
    readings = curated.latest_readings(deliveries(spark, rows))
    from roadlark.operators import trips

    spans = trips.trip_boundaries(readings)
    assert spans.count() == 60
    spread = trips._with_bucket(readings, trips.BUCKET_SECONDS).repartition(8, "vehicle_id", "bucket")
    from pyspark.sql import functions as F

    assert spread.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_fact_types(spark, sf_dir):
    types = dict(registry.model(spark, sf_dir).vehicle_daily.dtypes)
    assert types["metric_date"] == "timestamp_ntz" and types["brake_events"] == "bigint"
    assert dict(facts.telematics_health(registry.model(spark, sf_dir).readings).dtypes)["all_can_healthy"] == "boolean"


def test_trips_read_and_deduplicate_once(spark, sf_dir):
    """The written intermediate table is built from one scan and one deduplication, and the final
    plan reads only that table and the fences."""
    from roadlark.operators import trips

    model = registry.model(spark, sf_dir)
    needed = trips.trip_runs(model.readings)
    plan = plan_of(needed)
    assert plan.count("FileScan parquet") == 1 and plan.count("WindowGroupLimit") == 2
    for build in (lambda: model.trips, lambda: trips.trip_boundaries(model.readings), lambda: trips.ignition_transitions(model.readings)):
        assert "/events.parquet" not in plan_of(build())


def test_a_box_meets_few_files_along_the_curve(spark, tmp_path):
    """A box over three columns overlaps under a tenth of the files, by their min/max values."""
    number = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n)) for k, n in enumerate((997, 1_000_000, 9000))]
    rows = spark.range(100_000).select(number[0].alias("vehicle"), number[1].alias("second"), (number[2] / 100).alias("lat"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, None)], rows.schema))
    columns = {c: F.col(c) for c in rows.columns}
    files.write_curved(rows, str(tmp_path / "t"), columns, 256)
    box = {"vehicle": (100, 180), "second": (300_000, 380_000), "lat": (20.0, 28.0)}
    met, every = 0, list((tmp_path / "t").glob("*.parquet"))
    for file in every:
        groups = pq.ParquetFile(file).metadata
        met += any(
            all(
                (stats := groups.row_group(g).column(k).statistics).has_min_max
                and stats.min <= high and stats.max >= low
                for k, (low, high) in enumerate(box.values())
            )
            for g in range(groups.num_row_groups)
        )
    assert len(every) >= 200 and 0 < met < len(every) / 10
    where = " AND ".join(f"{c} BETWEEN {low} AND {high}" for c, (low, high) in box.items())
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.where(where).count() == rows.where(where).count() > 0 and stored.count() == 100_001


def test_queries_keep_wide_rows_compiled_in_any_session(spark, sf_dir):
    name = "spark.sql.codegen.hugeMethodLimit"
    try:
        for given, expected in (("65535", "8000"), ("30000", "30000")):
            spark.conf.set(name, given)
            registry.QUERIES["dlq_split"](spark, sf_dir)
            assert spark.conf.get(name) == expected
    finally:
        spark.conf.set(name, "8000")


def test_wide_rows_are_built_by_many_tasks(spark, sf_dir):
    """A small file of events is one split, its projection is not one task."""
    messages = registry.damaged_messages(spark, sf_dir)
    assert messages.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    rows = [df.selectExpr("to_json(struct(*)) AS row") for df in (events.spread_landing(spark, sf_dir), events.landing(spark, sf_dir))]
    assert rows[0].exceptAll(rows[1]).isEmpty() and rows[1].exceptAll(rows[0]).isEmpty()
