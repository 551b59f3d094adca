"""Message envelopes ``(key, value, timestamp)``: broker, files, encode, decode."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlift import schema
from eventlift.functions import iso_utc

DEFAULT_TOPIC = "user_events"


def stream_messages(
    spark: SparkSession,
    kind: str = "kafka",
    *,
    servers: str = "localhost:9092",
    topic: str = DEFAULT_TOPIC,
    path: str | None = None,
    starting_offsets: str = "latest",
    max_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Streaming envelopes from a broker (``kind="kafka"``) or a folder (``"files"``).

    ``max_per_trigger`` limits a micro-batch, in offsets for the broker and files for the
    folder; there is no limit unless given.  Messages that have aged out of the topic
    stop the stream unless ``fail_on_data_loss`` is false.  The broker source needs
    the Kafka connector on the session's class path.
    """
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.options(**(options or {})).load().select(*schema.ENVELOPE.names)
    if kind == "files":
        if path is None:
            raise ValueError("kind='files' needs a path")
        reader = spark.readStream.schema(schema.ENVELOPE)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.options(**(options or {})).parquet(path)
    raise ValueError(f"unknown message source {kind!r}: use 'kafka' or 'files'")


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a folder of envelope files."""
    return spark.read.schema(schema.ENVELOPE).parquet(path)


def arrival_time(received_at: Column | None = None) -> Column:
    """The time that ``encode_envelope`` stamps."""
    if received_at is None:
        return F.coalesce(F.try_to_timestamp("received_at"), F.current_timestamp())
    return received_at.cast("timestamp")


def encode_envelope(events: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Events to envelopes: JSON body stamped with ``received_at``, keyed by user.

    A given ``received_at`` is used for every row; otherwise a row keeps its own,
    and the current time fills a missing one.
    """
    arrival = arrival_time(received_at)
    text = iso_utc(arrival)
    body = [
        text.alias(name) if name == "received_at" else F.col(name) for name in schema.EVENT.names
    ]
    return events.select(
        F.col("user_id").alias("key"),
        F.to_json(F.struct(*body)).cast("binary").alias("value"),
        arrival.alias("timestamp"),
    )


def decode_envelope(messages: DataFrame) -> DataFrame:
    """Binary body to text; the broker's time becomes ``kafka_timestamp``."""
    return messages.select(
        F.col("value").cast("string").alias("json_value"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
