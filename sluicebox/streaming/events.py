"""Event stream: read messages, parse, mark, clean. Every step works on batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.contracts import EVENT_SCHEMA, EVENT_TOPICS, EVENT_TYPES, MESSAGE_SCHEMA, WATERMARK
from sluicebox.functions.dates import to_timestamp
from sluicebox.functions.text import lowered, titled


def read_kafka_events(
    spark: SparkSession, servers: str, topics: Sequence[str] = EVENT_TOPICS, **options: str
) -> DataFrame:
    """Subscribe to the event topics, from the latest offsets. Needs the Kafka connector on the class path."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        **options,
    }
    return spark.readStream.format("kafka").options(**settings).load()


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same columns from JSON files, for tests and for replaying stored messages."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message columns as text plus the payload's fields; unreadable JSON gives NULL fields."""
    return messages.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("raw_json"),
        F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("event"),
    ).select("topic", "partition", "offset", "kafka_timestamp", "message_key", "raw_json", "event.*")


def with_stream_metadata(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_system": F.lit("kafka"),
            "source_file": F.col("topic"),
            "batch_id": F.col("offset").cast("string"),
            "record_hash": F.sha2(F.coalesce("raw_json", F.lit("")), 256),
            "is_malformed": F.isnull("event_id"),
        }
    )


def bronze_events(messages: DataFrame) -> DataFrame:
    return with_stream_metadata(parse_messages(messages))


def standardised(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "event_timestamp": to_timestamp("event_timestamp"),
            "event_type": lowered("event_type"),
            "city": titled("city"),
            "device_type": lowered("device_type"),
        }
    )


def acceptable(events: DataFrame) -> DataFrame:
    """Identified, timed events of a known type, without a negative price or a quantity below one."""
    present = ("event_id", "customer_id", "event_timestamp")
    return (
        events.filter(~F.col("is_malformed"))
        .dropna(subset=list(present))
        .filter(F.col("event_type").isin(*EVENT_TYPES))
        .filter("coalesce(price, 0) >= 0 AND coalesce(quantity, 1) > 0")
    )


def once_per_event(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """One row per event id.

    On a stream the id is forgotten once the watermark has passed it, so state stays bounded; the same id
    arriving later than that is taken as new. On a batch, all copies of an id fold into one.
    """
    if events.isStreaming:
        return events.withWatermark("event_timestamp", watermark).dropDuplicatesWithinWatermark(["event_id"])
    return events.dropDuplicates(["event_id"])


def clean_events(bronze: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Silver events from Bronze events."""
    return once_per_event(acceptable(standardised(bronze)), watermark)


def metric_events(messages: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Input of the windowed metrics: identified and timed events, otherwise as sent."""
    timed = parse_messages(messages).withColumn("event_timestamp", to_timestamp("event_timestamp"))
    return once_per_event(timed.dropna(subset=["event_id", "event_timestamp"]), watermark)
