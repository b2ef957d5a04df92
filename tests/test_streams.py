"""A stream leaves the same tables as one batch over all its rows."""

import pathlib
import random

import pyarrow.parquet as pq
import pytest
from helpers import deliveries
from pyspark.sql import functions as F
from test_trips import random_rows

from roadlark.operators import curated, facts, trips
from roadlark.plans.refresh import IncrementalTables
from roadlark.sources.masters import city_fences
from roadlark.streaming import log, tables


def noisy(seed):
    """Deliveries with corrections that change customer, ignition or speed of a reading."""
    rng = random.Random(seed)
    rows = random_rows(seed, vehicles=4, per_vehicle=40)
    for row in rng.sample(rows, 40):
        rows.append({**row, "lag": rng.randrange(2, 50000), "customer_id": "C", "j1939_vehicle_speed_kph": 1.0,
                     "tel_ignition_status": rng.choice(["ON", "OFF"])})
    rng.shuffle(rows)
    return [{**r, "offset": i} for i, r in enumerate(rows)]


def same(a, b):
    columns = sorted(a.columns)
    assert sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


@pytest.fixture()
def source(spark, tmp_path):
    raw = deliveries(spark, noisy(4))
    raw.repartition(3, "record_metadata.offset").write.parquet(f"{tmp_path}/source")
    return raw, f"{tmp_path}/source", str(tmp_path)


def test_refresh_stream(spark, source):
    raw, path, root = source
    built = IncrementalTables(spark, f"{root}/tables", shards=2)
    rows = tables.landing_stream(spark, path, files_per_batch=1)
    tables.start_refresh(rows, built, f"{root}/cp").awaitTermination()
    readings = curated.latest_readings(raw)
    same(built.readings(), readings)
    same(built.fact_vehicle_daily(), facts.fact_vehicle_daily(readings))
    fences = city_fences(spark)
    same(built.trip_summaries(fences), trips.trip_summaries(readings, fences))


def test_repeated_increment_changes_nothing(spark, source):
    raw, _, root = source
    built = IncrementalTables(spark, f"{root}/again", shards=2)
    part = raw.where("record_metadata.offset % 2 = 0")
    rest = raw.where("record_metadata.offset % 2 = 1")
    built.apply(part, 0)
    built.apply(rest, 1)
    before = built.fact_vehicle_daily().collect()
    built.apply(rest, 1)
    assert sorted(map(str, built.fact_vehicle_daily().collect())) == sorted(map(str, before))


def test_dedup_and_state_streams(spark, source):
    raw, path, root = source
    kept = tables.LatestReadings(spark, f"{root}/d", 2)
    tables.start_dedup(tables.landing_stream(spark, path, 1), kept, f"{root}/cp1").awaitTermination()
    same(kept.readings(), curated.latest_readings(raw))
    state = tables.newest_state(tables.landing_stream(spark, path, 1))
    tables.start_update(state, f"{root}/s", f"{root}/cp2").awaitTermination()
    same(log.newest_version(log.read_log(spark, f"{root}/s"), ["vehicle_id"]), tables.newest_state(raw))
    counts = tables.late_by_day(tables.landing_stream(spark, path, 1))
    tables.start_update(counts, f"{root}/l", f"{root}/cp3").awaitTermination()
    got = log.newest_version(log.read_log(spark, f"{root}/l"), ["metric_date", "arrived_late"])
    same(got, tables.late_by_day(raw))


def with_gaps(seed):
    """Deliveries of which some lack the vehicle or the event time."""
    rows = noisy(seed)
    for i, row in enumerate(rows):
        if i % 17 == 3:
            row["vehicle_id"] = None
        if i % 23 == 5:
            row["t"] = None
    return rows


def equal_to_rebuild(spark, built, raw):
    readings = curated.latest_readings(raw)
    policies = policies_of(spark)
    same(built.readings(), readings)
    same(built.fact_vehicle_daily(), facts.fact_vehicle_daily(readings))
    same(built.fact_customer_fleet(), facts.fact_customer_fleet(readings))
    same(built.dim_vehicle(policies), facts.dim_vehicle(readings, policies))
    same(built.dim_customer(policies, AS_OF), facts.dim_customer(readings, policies, AS_OF))
    same(built.fleet_health(AS_OF), facts.fleet_health(readings, AS_OF))
    fences = city_fences(spark)
    same(built.trip_summaries(fences), trips.trip_summaries(readings, fences))


AS_OF = "2024-01-03 00:00:00"


def policies_of(spark):
    rows = [("A", 1), ("B", 1), ("C", 2), ("CUST_0001", 1), ("none", 5)]
    days = "raw_retention_days", "curated_retention_days", "trip_retention_days", "video_retention_days"
    df = spark.createDataFrame(rows, "customer_id string, raw_retention_days long")
    return df.selectExpr(
        "*",
        "customer_id AS customer_name",
        *[f"raw_retention_days AS {d}" for d in days[1:]],
        "true AS tenant_isolation_enabled",
        "timestamp_ntz'2024-01-01 00:00:00' AS created_at",
    )


def test_increments_with_missing_keys_equal_a_rebuild(spark, tmp_path):
    raw = deliveries(spark, with_gaps(6))
    built = IncrementalTables(spark, str(tmp_path / "t"), shards=3)
    number = "record_metadata.offset"
    for batch in range(2):
        built.apply(raw.where(f"{number} % 2 = {batch}"), batch)
    late = deliveries(spark, [{**r, "offset": 10_000 + i} for i, r in enumerate(with_gaps(7))])
    built.apply(late, 3)
    equal_to_rebuild(spark, built, raw.union(late))


def test_retention_deletes_and_all_tables_follow(spark, tmp_path):
    from roadlark.operators import retention

    rows = [{**r, "t": None if r["t"] is None else r["t"] * 40} for r in with_gaps(8)]
    raw = deliveries(spark, rows)
    built = IncrementalTables(spark, str(tmp_path / "t"), shards=3)
    built.apply(raw, 0)
    stored = built.read("deliveries")
    policies, total = policies_of(spark), stored.count()
    kept = retention.retained(stored, policies, "2024-01-02 12:00:00").drop("batch_id", "event_date")
    kept.write.parquet(f"{tmp_path}/kept")
    deleted = built.retain(policies, "2024-01-02 12:00:00")
    left = built.read("deliveries").count()
    assert 0 < deleted < total and left + deleted == total
    equal_to_rebuild(spark, built, spark.read.schema(raw.schema).parquet(f"{tmp_path}/kept"))
    assert built.retain(policies, "2024-01-02 12:00:00") == 0


def test_retention_judges_rows_by_the_policies_in_use_only(spark, tmp_path, monkeypatch):
    from roadlark.operators import retention

    raw = deliveries(spark, [{**r, "t": None if r["t"] is None else r["t"] * 40} for r in with_gaps(8)])
    as_of = "2024-01-02 12:00:00"
    unused = policies_of(spark).where("customer_id = 'A'").withColumn("customer_id", F.explode(F.transform(F.sequence(F.lit(1), F.lit(500)), lambda n: n.cast("string"))))
    longer = policies_of(spark).where("customer_id = 'A'").withColumn("raw_retention_days", F.lit(9).cast("long"))
    policies = policies_of(spark).union(longer).union(unused)
    built = IncrementalTables(spark, str(tmp_path / "t"), shards=3)
    built.apply(raw, 0)
    expected = retention.expired(built.read("deliveries"), policies, as_of).count()
    judged, retained = [], retention.retained

    def seen(rows, policies, as_of):
        judged.extend(policies.collect())
        return retained(rows, policies, as_of)

    monkeypatch.setattr(retention, "retained", seen)
    assert built.retain(policies, as_of) == expected > 0
    assert {r.customer_id for r in judged} <= {r.customer_id for r in raw.select("customer_id").collect()}
    assert [r.raw_retention_days for r in judged if r.customer_id == "A"] == [1]


def left_files(root):
    """Part files by folder, with their times."""
    out = {}
    for file in pathlib.Path(root).rglob("part-*"):
        out.setdefault(str(file.parent.relative_to(root)), []).append((file.name, file.stat().st_mtime_ns))
    return {folder: sorted(files) for folder, files in out.items()}


def test_one_vehicle_day_rewrites_its_own_folders(spark, tmp_path):
    rows = [{**r, "t": r["t"] * 40} for r in noisy(9)]
    raw = deliveries(spark, rows)
    built = IncrementalTables(spark, str(tmp_path / "t"), shards=3)
    built.apply(raw, 0)
    before = left_files(built.root)
    late = deliveries(spark, [{**rows[0], "offset": 50_000, "lag": 40_000, "j1939_vehicle_speed_kph": 2.0}])
    built.apply(late, 1)
    after = left_files(built.root)
    changed = sorted(f for f in after.keys() | before.keys() if after.get(f) != before.get(f))
    tables_hit = [f.split("/")[0] for f in changed]
    assert sorted(tables_hit) == ["daily", "deliveries", "fleet", "parts", "readings", "runs", "spans", "vehicles"]
    assert len(before) > 20
    equal_to_rebuild(spark, built, raw.union(late))


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["_follow", "late"])
def test_interrupted_retention_is_finished(spark, tmp_path, monkeypatch, step):
    from roadlark.operators import retention

    raw = deliveries(spark, [{**r, "t": r["t"] * 40} for r in noisy(8)])
    built = IncrementalTables(spark, str(tmp_path / "t"), shards=2)
    built.apply(raw, 0)
    as_of, policies = "2024-01-02 12:00:00", policies_of(spark)
    total = built.read("deliveries").count()
    kept = retention.retained(raw, policies, as_of)
    place = IncrementalTables._place

    def stop(self, *args):
        if step == "late":  # after some tables have changed
            if args[0] in ("parts", "vehicles"):
                raise Stopped
            return place(self, *args)
        raise Stopped

    with monkeypatch.context() as patch:
        patch.setattr(IncrementalTables, "_place" if step == "late" else step, stop)
        with pytest.raises(Stopped):
            built.retain(policies, as_of)
    built = IncrementalTables(spark, built.root, shards=2)
    deleted = built.retain(policies, as_of)
    assert deleted == (0 if step in ("_place", "late") else total - kept.count())
    equal_to_rebuild(spark, built, kept)
    # No file below the root holds an expired reading.
    for file in pathlib.Path(built.root).rglob("part-*.parquet"):
        assert "_stage" not in str(file)
        if "event_ts" in pq.read_schema(file).names:
            found = spark.read.parquet(f"{built.root}/{file.relative_to(built.root).parts[0]}")
            assert retention.expired(found, policies, as_of).isEmpty()
            break
    for name in ("deliveries", "readings"):
        assert retention.expired(built.read(name), policies, as_of).isEmpty()


def test_wider_batches(spark, tmp_path):
    """Three widths, and fields that grow from int to long and from float to double."""
    path = str(tmp_path / "log")
    log.write_batch(spark.createDataFrame([(1, 1.5)], "a int, b float"), path, 0)
    log.write_batch(spark.createDataFrame([(1 << 40, "x")], "a long, c string"), path, 1)
    log.write_batch(spark.createDataFrame([(2, 0.1, "y", True)], "a int, b double, c string, d boolean"), path, 2)
    read = log.read_log(spark, path)
    assert dict(read.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "boolean", "batch_id": "int"}
    assert sorted(map(tuple, read.collect()), key=lambda r: r[-1]) == [
        (1, 1.5, None, None, 0),
        (1 << 40, None, "x", None, 1),
        (2, 0.1, "y", True, 2),
    ]
    with pytest.raises(ValueError):
        log.write_batch(spark.createDataFrame([("z",)], "a string"), path, 3)


def test_a_change_writes_each_row_once(spark, tmp_path):
    """Staged folders become the tables' own: the same files, not copies of them."""
    rows = [{**r, "t": r["t"] * 40} for r in noisy(9)]
    built = IncrementalTables(spark, str(tmp_path / "t"), shards=3)
    built.apply(deliveries(spark, rows), 0)
    staged, ready = {}, built.ready

    def look():
        ready()
        staged.update(left_files(f"{built.root}/_stage"))

    built.ready = look
    late = [{**r, "offset": 50_000 + i, "lag": 40_000} for i, r in enumerate(rows[:20])]
    built.apply(deliveries(spark, late), 1)
    after = left_files(built.root)
    placed = {f: v for f, v in staged.items() if "=" in f}
    assert placed and all(after[f] == v for f, v in placed.items())


def test_touched_folders_are_a_filter_not_a_join(spark, tmp_path):
    """Also for folders of missing values, and for many folders of several levels."""
    from roadlark.streaming.folders import among

    cells = [(None, 0), (None, None), (3, 1), (4, 1), (5, None), (6, 0), (6, 1)]
    rows = spark.sql("SELECT IF(a = 9, NULL, a) AS a, IF(b = 9, NULL, b) AS b FROM (SELECT explode(sequence(0, 9)) AS a) "
                     "CROSS JOIN (SELECT explode(sequence(0, 9)) AS b)")
    hit = among(["a", "b"], cells)
    inside = sorted(map(tuple, rows.where(hit).collect()), key=str)
    assert inside == sorted(cells, key=str)
    assert rows.where(~hit).count() == 100 - len(cells)
    many = [(n, n + 1) for n in range(1000)]
    big = spark.range(1001).selectExpr("CAST(id AS INT) AS a", "CAST(id + 1 AS INT) AS b")
    assert big.where(among(["a", "b"], many)).count() == 1000

    raw = deliveries(spark, with_gaps(6))
    built = IncrementalTables(spark, str(tmp_path / "t"), shards=3)
    built.apply(raw, 0)
    plans, stage = [], built.stage

    def look(name, rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        stage(name, rows)

    built.stage = look
    built.apply(deliveries(spark, [{**r, "offset": 10_000 + i} for i, r in enumerate(with_gaps(7))]), 1)
    assert len(plans) == 7 and not [p for p in plans if "LeftSemi" in p or "LeftAnti" in p]
