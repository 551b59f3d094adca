"""Pipeline health as data: ingest counts, latency, active sessions, volume over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlift.functions import exact_percentile
from eventlift.operators.users import as_of_column


def ingest_counts(raw: DataFrame) -> DataFrame:
    """Events taken in by type."""
    return raw.groupBy("event_type").agg(F.count(F.lit(1)).alias("events_ingested"))


def ingest_latency(raw: DataFrame, fraction: float = 0.95) -> DataFrame:
    """Exact percentile of receive time minus event time in milliseconds, one row."""
    received = F.try_to_timestamp("received_at")
    millis = F.floor((F.unix_micros(received) - F.unix_micros("event_timestamp")) / F.lit(1000))
    output = f"latency_p{round(fraction * 100)}_ms"
    return exact_percentile(raw.select(millis.alias("ms")), [], "ms", fraction, output)


def active_sessions(events: DataFrame, as_of, minutes: int = 30) -> DataFrame:
    """Distinct sessions with an event in the ``minutes`` before ``as_of``, one row."""
    end = as_of_column(as_of)
    start = end - F.make_dt_interval(mins=F.lit(minutes))
    # The date bounds prune partitions; the time bounds are exact.
    recent = events.where(
        F.col("event_date").between(F.to_date(start), F.to_date(end))
        & (F.col("event_timestamp") > start)
        & (F.col("event_timestamp") <= end)
    )
    return recent.agg(F.count_distinct("session_id").alias("active_sessions"))


def events_over_time(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Events per tumbling window."""
    return (
        events.groupBy(F.window("event_timestamp", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_count")
    )
