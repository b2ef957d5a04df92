"""Small hand-made telemetry tables."""

from datetime import datetime, timedelta

from roadlark import schema

START = datetime(2024, 1, 1)
DEFAULTS = {
    "customer_id": "CUST_0001",
    "vehicle_id": "VH_1",
    "device_id": "DEV_1",
    "tel_ignition_status": "ON",
    "tel_can_bus_health": "OK",
    "tel_tamper_alert": False,
}


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def deliveries(spark, rows):
    """``rows``: dicts of column values; ``t`` is the event time in seconds, ``lag`` the delay."""
    records = []
    for number, row in enumerate(rows):
        row = {**DEFAULTS, **row}
        t, lag, offset = row.pop("t", None), row.pop("lag", 1), row.pop("offset", number)
        record = {f.name: row.get(f.name) for f in schema.CONTENT.fields}
        record["event_ts"] = None if t is None else at(t)
        record["ingest_ts"] = None if t is None or lag is None else at(t + lag)
        record["record_metadata"] = {"offset": offset, "key": row["vehicle_id"]}
        records.append(tuple(record[f.name] for f in schema.LANDING.fields))
    return spark.createDataFrame(records, schema.LANDING)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
