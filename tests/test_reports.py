import statistics

import pytest
from pyspark.sql import functions as F

from roadlark.functions import rules
from roadlark.operators import payloads, quantiles, reports, text


def test_quantiles_of_one_large_continuous_group(spark):
    """All rows in one group, no two values equal, most of them in a thousandth of the range."""
    import numpy as np

    n = 200_000
    value = F.when(F.col("id") % 100 == 0, F.col("id") * 1.5).otherwise(F.pow(F.rand(3), F.lit(3.0)) + F.col("id") * 1e-12)
    df = spark.range(n).select(F.when(F.col("id") >= 7, "a").alias("g"), value.alias("v")).persist()
    values = {}
    for g, v in df.collect():
        values.setdefault(g, []).append(v)
    rows = {r.g: r for r in quantiles.exact_quantiles(df, "g", "v").collect()}
    assert set(rows) == {"a", None}
    for g, row in rows.items():
        assert row.n == len(values[g])
        for name, p in quantiles.BOX_PLOT.items():
            assert row[name] == pytest.approx(np.quantile(values[g], p), abs=6e-5)


def test_quantiles_equal_numpy(spark):
    import numpy as np

    values = {"a": [1.5, 2.5, 2.5, 9.0, 4.0], "b": [7.0], "c": [1.0, 2.0]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs] + [("a", None)], "g string, v double")
    for row in quantiles.exact_quantiles(df, "g", "v").collect():
        for name, p in quantiles.BOX_PLOT.items():
            assert row[name] == pytest.approx(np.quantile(values[row.g], p))
        assert row.n == len(values[row.g])


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 5, 9.99, 10]] + [(None,)], "v double")
    got = {r.bin: r.n for r in quantiles.histogram(df, "v", 10).collect()}
    assert got == {1: 2, 2: 1, 6: 1, 10: 2}
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r.bin, r.n) for r in quantiles.histogram(same, "v", 10).collect()] == [(1, 2)]


def test_descending_lists_put_missing_first(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 1, None), ("c", 1, 7.0)], "vehicle_id string, trip_num int, distance_km double")
    rows = df.orderBy(reports._desc("distance_km")).collect()
    assert [r.vehicle_id for r in rows] == ["b", "c", "a"]


def test_scorecard_repeats_trips_per_health_row(spark):
    trips = spark.createDataFrame(
        [("A", "v", 20.0, 50.0, 90.0, 10.0, 2.0), ("A", "v", 24.0, 60.0, 95.0, 30.0, 6.0)],
        "customer_id string, vehicle_id string, fuel_efficiency_l_per_100km double, avg_speed_kph double,"
        " max_speed_kph double, distance_km double, fuel_consumed_l double",
    )
    # Two devices with equal health fall into one group and repeat the trips.
    health = spark.createDataFrame([("A", "v", "HEALTHY", 0)] * 2, "customer_id string, vehicle_id string, health_status string, max_dtc_count bigint")
    row = reports.driver_scorecard(trips, health).first()
    assert (row.total_trips, row.total_km, row.avg_fuel_eff, row.driver_grade) == (4, 80.0, 22.0, "A - Excellent")
    alone = reports.driver_scorecard(trips, health.where("false")).first()
    assert (alone.total_trips, alone.health_status, alone.driver_grade) == (2, None, "C - Needs Improvement")


def test_grades(spark):
    df = spark.createDataFrame(
        [(20.0, 0), (20.0, 1), (30.0, 1), (30.0, 2), (44.9, 9), (45.0, 0), (None, 0)], "e double, d bigint"
    )
    got = [r[0][0] for r in df.select(rules.driver_grade(F.col("e"), F.col("d"))).collect()]
    assert got == ["A", "B", "B", "C", "C", "D", "D"]


def test_payload_is_permissive(spark):
    df = spark.createDataFrame([('{"speed_kph": 72, "event": "MOVING"}',), ("{broken",), (None,), ('{"speed_kph": "x"}',)], "payload string")
    rows = payloads.typed_payload(df.select(payloads.as_variant(F.col("payload")).alias("payload"))).collect()
    assert [r.speed_kph for r in rows] == [72, None, None, None]
    assert rows[0].event_type == "MOVING" and rows[0].engine_rpm is None


def test_sentiment(spark):
    docs = spark.createDataFrame([(1, "Excellent, GOOD and bad!"), (2, "nothing here"), (3, ""), (4, None)], "id int, t string")
    got = {r.id: r for r in text.sentiment(docs, text.lexicon(), "id", "t").collect()}
    assert got[1].sentiment_score == pytest.approx(statistics.mean([1, 1, -1])) and got[1].word_count == 4
    assert got[2].sentiment_score == 0 and got[3].word_count == 0 and got[4].word_count == 0


def test_summary_keeps_text_order(spark):
    docs = spark.createDataFrame([(1, "Odd one. Brake brake noise! Quiet day\nBrake again")], "id int, t string")
    assert text.summary(docs, "id", "t").first().summary == "Brake brake noise. Brake again"


def test_structured_answers(spark):
    df = spark.createDataFrame([(1, 'Sure: {"weather": "Rain", "other": 1} done'), (2, "none"), (3, None)], "id int, t string")
    got = {r.id: r.weather for r in text.structured_answers(df, "t").collect()}
    assert got == {1: "Rain", 2: None, 3: None}


def test_texts_of_all_scripts_keep_their_row(spark):
    rows = [(1, "plain good text"), (2, ""), (3, None), (4, "12 34"), (5, "Плохой путь. Путь хорош"), (6, "Élan naïve très bad")]
    docs = spark.createDataFrame(rows, "id int, t string")
    scored = {r.id: r for r in text.sentiment(docs, text.lexicon(), "id", "t").collect()}
    assert {i: r.word_count for i, r in scored.items()} == {1: 3, 2: 0, 3: 0, 4: 0, 5: 4, 6: 4}
    assert scored[6].sentiment_score == -1
    summaries = {r.id: r.summary for r in text.summary(docs, "id", "t", sentences=1).collect()}
    assert summaries == {1: "plain good text", 2: "", 3: None, 4: "", 5: "Плохой путь", 6: "Élan naïve très bad"}


def test_text_scoring_shuffles_nothing(spark):
    docs = spark.createDataFrame([(1, "a")], "id int, t string")
    for df in (text.sentiment(docs, text.lexicon(), "id", "t"), text.summary(docs, "id", "t")):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_sql_functions_agree_with_the_column_rules(spark, sf_dir):
    from roadlark.functions import geo
    from roadlark.plans.registry import model
    from roadlark.plans.sql import register

    register(spark, model(spark, sf_dir))
    points = spark.createDataFrame(
        [(12.97, 77.59, 28.61, 77.2), (0.0, 0.0, 0.0, 0.0), (10.0, 179.9, 10.0, -179.9), (None, 1.0, 2.0, 3.0)],
        "a double, b double, c double, d double",
    )
    rows = points.select(
        F.expr("haversine_km(a, b, c, d)").alias("sql"), geo.haversine_km(*map(F.col, "abcd")).alias("column")
    ).collect()
    for r in rows:
        assert (r.sql is None) == (r.column is None) and (r.sql is None or r.sql == pytest.approx(r.column, abs=1e-3))
    report = spark.sql("SELECT * FROM get_customer_fleet_report('CUST_0003')").collect()
    far = [r.total_distance_km for r in report]
    assert len(far) > 0 and far == sorted(far, reverse=True)
    fast = [r.max_speed_kph for r in spark.sql("SELECT * FROM get_speed_violations('CUST_0003', 80)").collect()]
    assert fast == sorted(fast, reverse=True)
