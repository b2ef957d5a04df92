"""Queries on semi-structured payload columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output column -> (path in the payload, type).
PAYLOAD_FIELDS = {
    "speed_kph": ("$.speed_kph", "int"),
    "latitude": ("$.lat", "double"),
    "longitude": ("$.lon", "double"),
    "vehicle_model": ("$.model", "string"),
    "engine_rpm": ("$.engine_rpm", "int"),
    "event_type": ("$.event", "string"),
}


def as_variant(text: Column) -> Column:
    """Malformed text becomes NULL instead of failing the query."""
    return F.try_parse_json(text)


def payload_field(payload: Column, path: str, dtype: str) -> Column:
    return F.try_variant_get(payload, path, dtype)


def typed_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Payload paths as typed columns, newest event first in any later ordering."""
    fields = [payload_field(F.col(payload), path, t).alias(n) for n, (path, t) in PAYLOAD_FIELDS.items()]
    return df.select(*[c for c in df.columns if c != payload], *fields)


def with_event(df: DataFrame, event: str, payload: str = "payload") -> DataFrame:
    return df.where(payload_field(F.col(payload), "$.event", "string") == event)
