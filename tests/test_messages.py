import json

from helpers import at, deliveries
from pyspark.sql import functions as F

from roadlark import schema
from roadlark.sources import envelopes
from roadlark.sources.files import list_files
from roadlark.streaming import ingest, log


def messages(spark, values):
    return spark.createDataFrame([(None, v, 0, i, at(i)) for i, v in enumerate(values)], ingest.MESSAGE)


GOOD = {"record_metadata": {"offset": 7, "key": "VH_1"}, "record_content": {"vehicle_id": "VH_1", "event_ts": "2024-01-01T00:00:00.123", "gps_speed_kph": 5, "extra": 1}}


def broken():
    return [
        "not json",
        "[1, 2]",
        None,
        "{}",
        json.dumps({"record_metadata": {"key": "k"}}),
        json.dumps({"record_content": GOOD["record_content"]}),
        json.dumps({**GOOD, "record_content": {"event_ts": "2024-01-01T00:00:00.123"}}),
        json.dumps({**GOOD, "record_content": {"vehicle_id": "v", "event_ts": "soon"}}),
    ]


def test_every_message_is_a_row_or_a_dead_letter(spark):
    parsed = envelopes.parse(messages(spark, [json.dumps(GOOD), *broken()]))
    good = envelopes.flatten(parsed, F.col("ingest_ts")).collect()
    dead = envelopes.dead_letters(parsed, ingest_ts=F.col("ingest_ts")).collect()
    assert len(good) == 1 and len(dead) == len(broken())
    assert good[0].vehicle_id == "VH_1" and good[0].event_ts == at(0.123) and good[0].record_metadata.offset == 7
    assert good[0].gps_latitude is None
    assert all(r.error_message for r in dead)
    assert {r.vehicle_key for r in envelopes.dead_letters_by_key(envelopes.dead_letters(parsed)).collect()} >= {"k", None}


def test_round_trip(spark, sf_dir):
    from roadlark.sources.events import landing

    rows = landing(spark, sf_dir)
    back = envelopes.flatten(envelopes.parse(envelopes.to_envelope(rows)), F.col("ingest_ts"))
    columns = schema.names(schema.ALL_FIELDS)
    assert rows.select(columns).exceptAll(back.select(columns)).count() == 0


def test_old_field_list_leaves_new_columns_missing(spark):
    event = {**GOOD, "record_content": {**GOOD["record_content"], "j1939_def_level_pct": 50.5}}
    source = messages(spark, [json.dumps(event)])
    old = envelopes.flatten(envelopes.parse(source, schema.PHASE1_CONTENT))
    new = envelopes.flatten(envelopes.parse(source))
    assert len(old.columns) == 50 and len(new.columns) == 55
    assert sorted(r.j1939_def_level_pct or 0 for r in envelopes.evolve(old, new).collect()) == [0, 50.5]


def test_key_partition_equals_md5(spark):
    import hashlib

    keys = [f"VH_{i:07d}" for i in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for n in (1, 7, 10, 1000):
        got = {r.k: r.p for r in df.select("k", envelopes.key_partition(F.col("k"), n).alias("p")).collect()}
        assert got == {k: int(hashlib.md5(k.encode()).hexdigest(), 16) % n for k in keys}


def test_message_stream(spark, tmp_path):
    for part in range(3):
        messages(spark, [json.dumps(GOOD), *broken()[:2]]).write.mode("append").parquet(f"{tmp_path}/in")
    source = ingest.file_messages(spark, f"{tmp_path}/in", files_per_batch=1)
    ingest.start_ingest(source, f"{tmp_path}/rows", f"{tmp_path}/dead", f"{tmp_path}/cp").awaitTermination()
    assert log.read_log(spark, f"{tmp_path}/rows").count() == 3
    assert log.read_log(spark, f"{tmp_path}/dead").count() == 6
    audited = ingest.start_ingest(source, f"{tmp_path}/r2", f"{tmp_path}/d2", f"{tmp_path}/cp2", audit_path=f"{tmp_path}/audit")
    audited.awaitTermination()
    audit = log.read_log(spark, f"{tmp_path}/audit").groupBy().sum("landed", "dead").first()
    assert tuple(audit) == (3, 6)
    # A restart with nothing new adds nothing.
    ingest.start_ingest(source, f"{tmp_path}/rows", f"{tmp_path}/dead", f"{tmp_path}/cp").awaitTermination()
    assert log.read_log(spark, f"{tmp_path}/rows").count() == 3


def test_file_listing(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"12345")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b.jpg").write_bytes(b"1")
    (tmp_path / "c.txt").write_bytes(b"1")
    got = {(r.relative_path, r.size) for r in list_files(spark, str(tmp_path)).collect()}
    assert got == {("a.jpg", 5), ("deep/b.jpg", 1)}


def test_landing_has_all_columns(spark):
    assert len(deliveries(spark, []).columns) == 55


def one(spark, metadata=None, **content):
    event = {
        "record_metadata": {**GOOD["record_metadata"], **(metadata or {})},
        "record_content": {**GOOD["record_content"], **content},
    }
    return envelopes.parse(messages(spark, [json.dumps(event)]))


def test_reasons_name_the_field(spark):
    assert one(spark, gps_latitude="abc").first()._error == "unreadable value in gps_latitude: abc"
    assert one(spark, event_ts="soon").first()._error == "unreadable value in event_ts: soon"
    assert one(spark, {"offset": "x"}).first()._error == "unreadable value in record_metadata"
    assert envelopes.parse(messages(spark, ['{"a": '])).first()._error == envelopes.NOT_JSON


def test_forms_of_time(spark):
    forms = {
        "2024-01-01 00:00:05": 5,
        "2024-01-01T00:00:05.123456789": 5.123456,
        "2024-01-01T00:00:05Z": 5,
        "2024-01-01T02:00:05+02:00": 5,
    }
    for text, seconds in forms.items():
        parsed = one(spark, event_ts=text)
        assert parsed.first()._error is None
        assert envelopes.flatten(parsed).first().event_ts == at(seconds)


def test_all_metadata_is_kept(spark):
    more = {"push time": 9, "headers": {"a": [1, "x"]}, "note": 'say "hi"', "none": None}
    row = envelopes.flatten(one(spark, more)).first()
    assert json.loads(row.record_metadata.other) == more and row.record_metadata.offset == 7
    landed = envelopes.flatten(one(spark, more))
    again = envelopes.flatten(envelopes.parse(envelopes.to_envelope(landed))).first()
    assert json.loads(again.record_metadata.other) == more and again.record_metadata.key == "VH_1"
    assert envelopes.flatten(one(spark)).first().record_metadata.other is None


def test_log_of_batches_of_different_width(spark, tmp_path):
    narrow = envelopes.flatten(envelopes.parse(messages(spark, [json.dumps(GOOD)]), schema.PHASE1_CONTENT))
    log.write_batch(narrow, str(tmp_path), 0)
    log.write_batch(envelopes.flatten(one(spark, j1939_def_level_pct=50.5)), str(tmp_path), 1)
    for table in (log.read_log(spark, str(tmp_path)), log.read_log(spark, str(tmp_path), schema.LANDING)):
        assert set(schema.names(schema.ALL_FIELDS)) <= set(table.columns)
        assert sorted((r.batch_id, r.j1939_def_level_pct) for r in table.collect()) == [(0, None), (1, 50.5)]


def test_long_ids_are_not_cut(spark):
    from roadlark.sources.events import project_events
    from roadlark.sources.masters import padded

    events = spark.range(2).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-01 00:00:00' AS ts",
        "10000000 + id AS user_id",
        "'view' AS event_type",
        "1D AS value",
        "'{\"k\": 1}' AS props",
    )
    got = {r.vehicle_id for r in project_events(events).collect()}
    assert got == {"VH_10000000", "VH_10000001"}
    assert spark.range(1).select(padded(F.lit(123456789), 7)).first()[0] == "123456789"
