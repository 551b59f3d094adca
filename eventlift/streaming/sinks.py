"""Streaming and batch writers of the lake."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlift.sources.lake import read_raw_lake
from eventlift.sources.messages import arrival_time, encode_envelope

DEFAULT_TRIGGER = "30 seconds"
PARTITIONS = ["event_date", "event_hour"]


def _trigger(interval: str | None) -> dict:
    """A processing-time interval, or everything available and stop for ``None``."""
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    name: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet with its own checkpoint; exactly once per micro-batch."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(trigger))
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def spread_by_hour(events: DataFrame, files_per_hour: int = 8) -> DataFrame:
    """Group rows by date and hour for writing, each hour over several tasks.

    Without it every task of a micro-batch writes a file into every hour it touches;
    with the hour alone as key one task would write the whole current hour.
    """
    share = F.pmod(F.xxhash64("session_id", "event_id"), F.lit(files_per_hour))
    return events.repartition(*PARTITIONS, share)


def write_raw_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: str | None = DEFAULT_TRIGGER,
    files_per_hour: int = 8,
) -> StreamingQuery:
    """Append parsed events to the raw lake, partitioned by event date and hour."""
    return start_append(
        spread_by_hour(events, files_per_hour),
        path,
        checkpoint,
        name="raw",
        trigger=trigger,
        partition_by=PARTITIONS,
    )


def write_raw(events: DataFrame, path: str, mode: str = "append") -> None:
    """Batch form of the raw sink.

    The rebalance hint lets adaptive execution size the files: small hours share a
    task, a large hour is split over many.
    """
    events.hint("rebalance", *PARTITIONS).write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


def compact_raw(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite a lake of many small stream files into evenly sized ones elsewhere."""
    write_raw(read_raw_lake(spark, source), target, mode="overwrite")


def write_messages(
    messages: DataFrame, path: str, mode: str = "append", order_by: str = "timestamp"
) -> None:
    """Envelopes to files: ranges of (key, time), in order within a key.

    Ranges, not hashes, of the key: a user with very many messages spans several
    consecutive files and the rest stay together.  One call is one batch of arrivals; a
    stream that reads the folder should take such a batch in one trigger, because its
    files are ordered by user and each covers the whole time span.
    """
    (
        messages.repartitionByRange("key", order_by)
        .sortWithinPartitions("key", order_by)
        .write.mode(mode)
        .parquet(path)
    )


def dealt_messages(events: DataFrame) -> DataFrame:
    """Envelopes of events in the ranges and order of ``write_messages``.

    Dealing into ranges computes its input twice, once for a sample; so events are dealt and sorted first and
    encoded once, after it.
    """
    order = "user_id", arrival_time()
    return encode_envelope(events.repartitionByRange(*order).sortWithinPartitions(*order))


def write_event_messages(events: DataFrame, path: str, mode: str = "append") -> None:
    """Events to files of envelopes; one call is one batch of arrivals, as for ``write_messages``."""
    dealt_messages(events).write.mode(mode).parquet(path)


def publish_messages(
    messages: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> None:
    """Envelopes to a broker topic; equal keys go to one topic partition, in order."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**(options or {}))
        .save()
    )


def write_json_days(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Newline-delimited JSON under one folder per event day."""
    day = F.to_date(F.try_to_timestamp("timestamp")).alias("day")
    (
        events.select("*", day)
        .hint("rebalance", "day")
        .write.mode(mode)
        .partitionBy("day")
        .json(path)
    )
