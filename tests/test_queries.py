"""A cross-section of the registered queries against their SQL; ``checks.compare`` runs them all."""

import datetime

import pytest

import __spark_entry__ as entry_point
from checks.compare import connect, difference
from checks.oracles import ORACLES

NAMES = [
    "dedup_latest",
    "j1939_signals",
    "late_distribution",
    "fact_vehicle_daily",
    "fact_customer_fleet",
    "dim_customer",
    "fleet_health",
    "customer360",
    "trip_summaries",
    "interval_join_trips",
    "geofence_match",
    "monthly_segment_efficiency",
    "driver_scorecard",
    "speed_quantiles",
    "kpi_row",
    "partition_skew",
    "dlq_split",
    "ingest_stream",
    "stream_trips",
    "retention_propagate",
    "mask_email",
    "sql_fleet_report",
    "json_typed",
    "text_summary",
]


# Of all others, an eighth that changes from day to day; those that build tables are left to
# ``checks.compare`` and the stream tests.
OTHERS = [n for n in sorted(ORACLES) if n not in NAMES and not n.startswith(("refresh_", "retention_", "stream_"))]
TODAY = OTHERS[datetime.date.today().toordinal() % 8 :: 8]

# Ten suppliers give no road segment with two ends.
NEEDS_MORE = {"monthly_segment_efficiency": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, sf_dir, name):
    data = NEEDS_MORE.get(name, sf_dir)
    problem, rows = difference(spark, connect(data), name, data)
    assert problem is None
    assert rows > 0


@pytest.mark.parametrize("name", TODAY)
def test_others_equal_sql(spark, sf_dir, name):
    assert difference(spark, connect(sf_dir), name, sf_dir)[0] is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_saved_model_gives_the_same_tables(spark, sf_dir, tmp_path):
    from roadlark.plans.registry import model

    live = model(spark, sf_dir)
    saved = live.saved(spark, str(tmp_path))
    for name in ("vehicle_daily", "trips", "health"):
        a, b = getattr(live, name), getattr(saved, name)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
