"""Event envelopes: JSON text ``{"record_metadata": {...}, "record_content": {...}}``.

Parsing is permissive: a message either becomes a landing row or a dead letter with the reason.
All functions are stateless projections and work on batches and streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlark import schema

MAX_ERROR_CHARS = 1000
NOT_JSON = "message is not a JSON object"
NO_CONTENT = "record_content is missing"
NO_METADATA = "record_metadata is missing"
NO_KEY = "record_content has no "
BAD_FIELD = "unreadable value in "
KNOWN_METADATA = [f.name for f in schema.METADATA.fields if f.name != "other"]
_TEXTS = "map<string,string>"


def _envelope(content: T.StructType) -> T.StructType:
    """Times are read as text: they come in several forms, and a cast reads them all."""
    known = T.StructType([f for f in schema.METADATA.fields if f.name != "other"])
    fields = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
        for f in content.fields
    ]
    return T.StructType(
        [
            T.StructField("record_metadata", known),
            T.StructField("record_content", T.StructType(fields)),
            T.StructField("_corrupt", T.StringType()),
        ]
    )


def _time(text: Column) -> Column:
    """A time with ``T`` or a blank, any number of digits after the second, and with or without a
    zone; times without one are UTC, like the session."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def to_envelope(landing: DataFrame) -> DataFrame:
    """Landing rows as messages (``key``, ``value``, ``partition``, ``offset``, ``ingest_ts``).

    Missing values are left out, as producers do.
    """
    fields = [c for c in landing.columns if c not in ("record_metadata", "ingest_ts")]
    times = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    known = F.to_json(F.struct(*[f"record_metadata.{name}" for name in KNOWN_METADATA]))
    other = F.col("record_metadata.other")
    # Both are JSON objects: the second one's members go on behind those of the first.
    comma = F.when(known == "{}", F.lit("{")).otherwise(F.concat(known.substr(F.lit(1), F.length(known) - 1), F.lit(",")))
    metadata = F.when(F.coalesce(other, F.lit("{}")) == "{}", known).otherwise(
        F.concat(comma, F.substring(other, 2, 2**31 - 1))
    )
    content = F.to_json(F.struct(*fields), times)
    return landing.select(
        F.col("record_metadata.key").alias("key"),
        F.concat(
            F.lit('{"record_metadata":'), metadata, F.lit(',"record_content":'), content, F.lit("}")
        ).alias("value"),
        F.col("record_metadata.partition").alias("partition"),
        F.col("record_metadata.offset").alias("offset"),
        "ingest_ts",
    )


def parse(messages: DataFrame, fields: T.StructType = schema.CONTENT, value: str = "value") -> DataFrame:
    """Add ``_event`` (typed envelope), ``_error`` (NULL for a usable message) and ``_other``.

    ``fields`` is the active field list: other keys of the content are ignored, absent ones NULL.
    Exploding a one-element array keeps the optimizer from copying the parser into every place
    that reads one of its fields, so each message is parsed once.
    """
    event = F.from_json(
        F.col(value), _envelope(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    content = F.col("_event.record_content")
    # What follows is only looked at where the reader found something that does not fit.
    raw = F.from_json(F.get_json_object(value, "$.record_content"), _TEXTS)
    read = F.from_json(F.to_json(content), _TEXTS)
    names = F.array(*[F.lit(f.name) for f in fields.fields])

    def unread(maps: Column) -> Column:
        """The fields that the message has and the reader has not."""
        present = F.array_intersect(F.map_keys(maps["raw"]), names)
        return F.filter(
            present, lambda n: F.element_at(maps["raw"], n).isNotNull() & F.element_at(maps["read"], n).isNull()
        )

    def misfit(maps: Column) -> Column:
        first = F.get(unread(maps), 0)
        named = F.concat(F.lit(BAD_FIELD), first, F.lit(": "), F.element_at(maps["raw"], first))
        return F.coalesce(named, F.lit(BAD_FIELD + "record_metadata"))

    whole = F.get_json_object(value, "$").startswith("{")
    corrupt = F.col("_event._corrupt").isNotNull()

    def missing(part: str) -> Column:
        return F.col(f"_event.{part}").isNull() & F.get_json_object(value, f"$.{part}").isNull()

    error = (
        F.when(F.col("_event").isNull() | (corrupt & ~F.coalesce(whole, F.lit(False))), F.lit(NOT_JSON))
        .when(missing("record_metadata"), F.lit(NO_METADATA))
        .when(missing("record_content"), F.lit(NO_CONTENT))
        # The lambda's argument is made once; its body stays out of the code that all messages run.
        .when(corrupt, F.get(F.transform(F.array(F.struct(raw.alias("raw"), read.alias("read"))), misfit), 0))
    )
    for name in ("vehicle_id", "event_ts"):
        error = error.when(content[name].isNull(), F.lit(NO_KEY + name))
    if "event_ts" in fields.names:
        when = content["event_ts"]
        error = error.when(_time(when).isNull(), F.concat(F.lit(BAD_FIELD + "event_ts: "), when))
    return messages.select("*", F.explode(F.array(event)).alias("_event")).withColumns(
        {"_error": error, "_other": _other_metadata(value)}
    )


def _other_metadata(value: str) -> Column:
    """The members of a message's metadata that have no column of their own, as one JSON object."""
    whole = F.from_json(F.get_json_object(value, "$.record_metadata"), _TEXTS)
    further = F.filter(F.map_keys(whole), lambda k: ~k.isin(KNOWN_METADATA))

    def member(key: Column) -> Column:
        text = F.element_at(whole, key)
        # The reader gives nested values and numbers as their JSON text, strings without quotes.
        plain = F.coalesce(F.schema_of_variant(F.try_parse_json(text)).isNotNull(), F.lit(False))
        quoted = F.get_json_object(F.to_json(F.array(text)), "$")
        body = F.when(plain, text).otherwise(quoted.substr(F.lit(2), F.length(quoted) - 2))
        name = F.get_json_object(F.to_json(F.array(key)), "$")
        return F.concat(name.substr(F.lit(2), F.length(name) - 2), F.lit(":"), F.coalesce(body, F.lit("null")))

    joined = F.array_join(F.transform(further, member), ",")
    return F.when(F.size(further) > 0, F.concat(F.lit("{"), joined, F.lit("}")))


def flatten(parsed: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Usable messages as landing rows; the ingest time defaults to now."""
    fields = parsed.schema["_event"].dataType["record_content"].dataType.names
    times = {f.name for f in schema.CONTENT.fields if isinstance(f.dataType, T.TimestampNTZType)}

    def typed(name: str) -> Column:
        column = F.col(f"_event.record_content.{name}")
        return (_time(column) if name in times else column).alias(name)

    known = [F.col(f"_event.record_metadata.{name}").alias(name) for name in KNOWN_METADATA]
    when = F.current_timestamp().cast("timestamp_ntz") if ingest_ts is None else ingest_ts
    return parsed.where("_error IS NULL").select(
        F.struct(*known, F.col("_other").alias("other")).alias("record_metadata"),
        *[typed(name) for name in fields],
        when.alias("ingest_ts"),
    )


def dead_letters(
    parsed: DataFrame, topic: str = "VEHICLE_TELEMETRY", value: str = "value", ingest_ts: Column | None = None
) -> DataFrame:
    """Rejected messages with the reason.  The raw parts are kept as text for a later replay."""
    when = F.current_timestamp().cast("timestamp_ntz") if ingest_ts is None else ingest_ts
    metadata = F.coalesce(F.get_json_object(value, "$.record_metadata"), F.lit("{}"))
    content = F.coalesce(F.get_json_object(value, "$.record_content"), F.col(value))
    return parsed.where("_error IS NOT NULL").select(
        metadata.alias("record_metadata"),
        content.alias("record_content"),
        F.substring("_error", 1, MAX_ERROR_CHARS).alias("error_message"),
        F.lit(topic).alias("source_topic"),
        F.col("partition").alias("source_partition"),
        when.alias("dlq_ingest_ts"),
    )


def dead_letters_by_key(letters: DataFrame, n: int = 10) -> DataFrame:
    """First dead letters with the vehicle key read from their metadata."""
    key = F.try_variant_get(F.try_parse_json("record_metadata"), "$.key", "string")
    return (
        letters.select("error_message", "source_topic", "source_partition", "dlq_ingest_ts", key.alias("vehicle_key"))
        .orderBy("dlq_ingest_ts", "vehicle_key", "error_message", "source_partition")
        .limit(n)
    )


def evolve(*batches: DataFrame) -> DataFrame:
    """Batches written before and after a schema change as one table, gaps filled with NULL."""
    table = batches[0]
    for batch in batches[1:]:
        table = table.unionByName(batch, allowMissingColumns=True)
    return table


def ingest_audit(parsed: DataFrame, phase: Column) -> DataFrame:
    """Produced, ingested and dead-letter counts per phase with the ingested share in percent."""
    ok = F.count_if(F.col("_error").isNull())
    return parsed.groupBy(phase.alias("phase")).agg(
        F.count("*").alias("produced"),
        ok.alias("ingested"),
        F.count_if(F.col("_error").isNotNull()).alias("dead_letters"),
        F.round(ok * 100.0 / F.count("*"), 1).alias("ingested_pct"),
    )


def key_partition(key: Column, partitions: int) -> Column:
    """md5(key) modulo the partition count, on the full 128 bits.

    ``(hi * 2^64 + lo) mod n`` from the two 64-bit halves, so nothing overflows.
    """

    def half(start: int) -> Column:
        digits = F.substring(F.md5(key.cast("binary")), start, 16)
        return (F.conv(digits, 16, 10).cast("decimal(20,0)") % F.lit(partitions)).cast("bigint")

    return F.pmod(half(1) * F.lit(2**64 % partitions) + half(17), F.lit(partitions))
