"""The event log: key, value and timestamp of every event, from Kafka or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.schemas import ENVELOPE
from tripweave.sources.tables import CODEC

#: A task reads whole row groups: small ones spread a large file over many tasks.
LOG_ROW_GROUPS = {"parquet.block.size": str(4 << 20)}


def kafka_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    log = spark.readStream.format("kafka").options(**options).load()
    return log.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "timestamp"
    )


def file_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Files of (key, value, timestamp) rows, the columns the Kafka source has."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def text_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Files with one JSON value per line; a file's events carry its modification time."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(
        F.get_json_object("value", "$.ingestion_id").alias("key"),
        "value",
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def append_events(events: DataFrame, path: str) -> None:
    """Publish (key, value, timestamp) rows as files of the log."""
    log = events.select(*ENVELOPE.names).write.mode("append")
    log.options(**CODEC, **LOG_ROW_GROUPS).parquet(path)


def append_events_to_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Publish to a topic; the key keeps an ingestion's events in one topic partition."""
    (
        events.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
