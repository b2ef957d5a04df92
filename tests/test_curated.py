from helpers import at, deliveries
from pyspark.sql import functions as F

from roadlark.functions import rules, timing
from roadlark.operators import curated, facts, retention
from roadlark.sources.masters import generated_policies


def test_latest_delivery_wins_and_ties_use_the_offset(spark):
    raw = deliveries(
        spark,
        [
            {"t": 1, "lag": 5, "gps_speed_kph": 1.0},
            {"t": 1, "lag": 9, "gps_speed_kph": 2.0},
            {"t": 1, "lag": 9, "gps_speed_kph": 3.0, "offset": 50},
            {"t": 2, "lag": 5, "gps_speed_kph": 4.0},
            {"t": 2, "lag": None, "gps_speed_kph": 5.0},
            {"t": None, "gps_speed_kph": 6.0},
            {"t": None, "gps_speed_kph": 7.0, "offset": 60},
        ],
    )
    once = curated.latest_readings(raw)
    assert sorted(r.gps_speed_kph for r in once.collect()) == [3.0, 5.0, 7.0]
    assert sorted(curated.latest_readings(once).collect(), key=str) == sorted(once.collect(), key=str)


def test_late_flag_counts_second_boundaries(spark):
    raw = deliveries(
        spark,
        [
            {"t": 0.9, "lag": 25400.2, "device_id": "a"},  # .9 -> 25401.1: 25401 boundaries
            {"t": 0, "lag": 25400.9, "device_id": "b"},
            {"t": 0, "lag": -25401, "device_id": "c"},
            {"t": 0, "lag": None, "device_id": "d"},
            {"t": None, "device_id": "e"},
        ],
    )
    got = {r.device_id: r.arrived_late for r in curated.signal_view(raw, "gps").collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False, "e": False}


def test_minutes_count_boundaries(spark):
    df = spark.createDataFrame([(at(59), at(61))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(timing.minutes_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_health_of_missing_can_value(spark):
    raw = deliveries(spark, [{"t": 1, "tel_can_bus_health": None}, {"t": 2}])
    row = facts.telematics_health(raw).first()
    assert row.all_can_healthy is False and row.has_tamper_alert is False


def test_strict_health_makes_ok_a_warning(spark):
    raw = deliveries(spark, [{"t": 1}])
    assert facts.fleet_health(raw, "2024-01-02").first().health_status == "HEALTHY"
    assert facts.fleet_health(raw, "2024-01-02", rules.STRICT_CAN).first().health_status == "WARNING"


def test_vehicle_of_two_customers(spark):
    raw = deliveries(
        spark,
        [
            {"t": 1, "customer_id": "A", "tel_gsm_signal_dbm": -80.0, "tel_tamper_alert": True},
            {"t": 2, "customer_id": "B", "tel_gsm_signal_dbm": -60.0},
        ],
    )
    rows = facts.fleet_health(raw, "2024-01-02").collect()
    assert {(r.customer_id, r.avg_gsm_signal_dbm, r.health_status) for r in rows} == {
        ("A", -70.0, "CRITICAL"),
        ("B", -70.0, "CRITICAL"),
    }


def test_customer_without_policy(spark):
    raw = deliveries(spark, [{"t": 1, "customer_id": "CUST_0000"}, {"t": 1, "customer_id": "CUST_0100", "vehicle_id": "x"}])
    policies = generated_policies(spark, 100, "2024-01-01")
    names = {r.customer_id: r.customer_name for r in facts.dim_vehicle(raw, policies).collect()}
    assert names == {"CUST_0000": "Customer 0", "CUST_0100": None}
    sizes = {r.customer_id: r.fleet_size for r in facts.dim_customer(raw, policies, "2024-01-02").collect()}
    assert len(sizes) == 100 and sizes["CUST_0000"] == 1 and sizes["CUST_0099"] is None


def test_retention_keeps_or_deletes_every_row(spark):
    raw = deliveries(
        spark,
        [
            {"t": 0, "customer_id": "CUST_0000"},
            {"t": 86400 * 10, "customer_id": "CUST_0000"},
            {"t": 0, "customer_id": "nobody"},
            {"t": None, "customer_id": "CUST_0000"},
            {"t": 0, "customer_id": None},
        ],
    )
    policies = generated_policies(spark, 3, "2024-01-01")
    as_of = "2024-03-31 00:00:01"  # 90 days after the first row, plus a second
    kept, gone = retention.retained(raw, policies, as_of), retention.expired(raw, policies, as_of)
    assert (kept.count(), gone.count()) == (4, 1)
    counts = {r.customer_id: r.deleted for r in retention.deleted_per_customer(raw, policies, as_of).collect()}
    assert counts == {"CUST_0000": 1, "CUST_0001": 0, "CUST_0002": 0}
    assert retention.deletion_message(raw, policies, as_of).first()[0].endswith("deleted: 1")


def test_retention_takes_the_shortest_of_several_policies(spark):
    raw = deliveries(spark, [{"t": 0, "customer_id": "CUST_0001"}])
    policies = generated_policies(spark, 3, "2024-01-01")
    shorter = policies.where("customer_id = 'CUST_0001'").withColumn("raw_retention_days", F.lit(5).cast("bigint"))
    assert retention.retained(raw, policies.union(shorter), "2024-01-10").count() == 0
    assert retention.retained(raw, policies, "2024-01-10").count() == 1
