"""Message streams: each gives a column ``value`` with the message text or bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# What one micro-batch takes unless told otherwise.
MESSAGES_PER_TRIGGER = 1_000_000
FILES_PER_TRIGGER = 1_000


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_messages_per_trigger: int | None = MESSAGES_PER_TRIGGER,
    **options: str,
) -> DataFrame:
    """Subscribe to a topic. Needs the Kafka connector package on the class path.

    ``max_messages_per_trigger`` bounds a micro-batch, and with it the events of one
    key that are folded at once; None lifts the bound.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if max_messages_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_messages_per_trigger)
    return reader.load()


def file_source(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = FILES_PER_TRIGGER
) -> DataFrame:
    """Text files with one message per line, new files as they come, a bounded number per micro-batch."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
