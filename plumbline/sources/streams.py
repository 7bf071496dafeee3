"""Unbounded sources of raw event payloads; each yields a column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Topic and start position of the event stream.
EVENT_TOPIC = "user_events"
START_POSITION = "earliest"


def kafka_events(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = EVENT_TOPIC,
    starting_offsets: str = START_POSITION,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Payloads from a Kafka topic; needs the Kafka connector jar.

    ``starting_offsets`` counts on the first start only: later starts go on from the
    checkpoint.  Offsets that have expired on the broker do not stop the stream.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def replay_events(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same payloads from text files, one payload per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)
