"""Message streams into the landing table and the dead-letter table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadlark import schema
from roadlark.sources import envelopes
from roadlark.streaming.log import write_batch

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ingest_ts", T.TimestampNTZType()),
    ]
)


# A backlog is worked off in batches of this many files or Kafka offsets unless told otherwise.
FILES_PER_BATCH = 1000
OFFSETS_PER_BATCH = 50_000_000


def file_messages(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Messages from Parquet files as they appear in a folder."""
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages from Kafka; needs Spark's Kafka package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    limits = {"maxOffsetsPerTrigger": str(OFFSETS_PER_BATCH), **options}
    records = reader.option("subscribe", topic).options(**limits).load()
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("partition").cast("bigint").alias("partition"),
        "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("ingest_ts"),
    )


def start_ingest(
    messages: DataFrame,
    landing_path: str,
    dead_letter_path: str,
    checkpoint: str,
    fields: T.StructType = schema.CONTENT,
    trigger: dict | None = None,
    audit_path: str | None = None,
) -> StreamingQuery:
    """Parse each micro-batch once and write its good and bad messages.

    Offsets and retries are the checkpoint's business; both outputs overwrite the folder of their
    batch, so a repeated batch neither loses nor doubles a row.  With ``audit_path`` a row of totals
    per batch (landed, dead) is written there; the two writes count their rows as these pass
    (observed metrics), so the audit reads nothing again.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        parsed = envelopes.parse(batch, fields).persist()
        try:
            when = F.coalesce("ingest_ts", F.current_timestamp().cast("timestamp_ntz"))
            outputs = {
                "landed": (envelopes.flatten(parsed, when), landing_path),
                "dead": (envelopes.dead_letters(parsed, ingest_ts=when), dead_letter_path),
            }
            totals = {}
            for name, (rows, path) in outputs.items():
                seen = Observation(f"{name}-{batch_id}")
                write_batch(rows.observe(seen, F.count(F.lit(1)).alias("rows")), path, batch_id)
                totals[name] = seen.get["rows"]
            if audit_path:
                row = batch.sparkSession.createDataFrame([tuple(totals.values())], "landed long, dead long")
                write_batch(row.coalesce(1), audit_path, batch_id)
        finally:
            parsed.unpersist()

    writer = messages.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
