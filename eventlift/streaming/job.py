"""The streaming job: one message source, four continuous outputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventlift.operators.ingest import accepted_events, rejected_events, validate_events
from eventlift.operators.quality import FUTURE_TOLERANCE, dedup_stream, present_events
from eventlift.streaming.aggregates import (
    active_users,
    events_per_minute,
    realtime_metrics,
    session_metrics,
    stream_funnel,
)
from eventlift.streaming.sinks import DEFAULT_TRIGGER, start_append, write_raw_stream


def start_all(
    events: DataFrame,
    output: str,
    checkpoints: str,
    *,
    trigger: str | None = DEFAULT_TRIGGER,
    realtime_trigger: str | None = "1 minute",
    dedup: bool = False,
    approx: bool = False,
    files_per_hour: int = 8,
    future_tolerance: str | None = FUTURE_TOLERANCE,
    activity: bool = False,
) -> list[StreamingQuery]:
    """Start the raw sink and the three windowed metrics on parsed events.

    Each query owns its path and checkpoint.  ``dedup`` counts redelivered events once
    in the metrics; the raw lake keeps every copy, late events included.  Events whose clock is ahead of the
    broker's by more than ``future_tolerance`` stay out of the metrics, whose watermark they would move, and
    are in the raw lake; ``None`` lets them in.  ``activity`` adds active users and events per minute.
    ``files_per_hour`` is how many tasks write an hour of the raw lake.
    """
    present = events if future_tolerance is None else present_events(events, future_tolerance)
    metrics = lambda watermark: dedup_stream(present, watermark) if dedup else present
    tables = {
        "session_metrics": (session_metrics(metrics("1 hour")), trigger),
        "realtime_metrics": (realtime_metrics(metrics("5 minutes"), approx=approx), realtime_trigger),
        "funnel_metrics": (stream_funnel(metrics("1 hour"), approx=approx), trigger),
    }
    if activity:
        tables["active_users"] = (active_users(metrics("5 minutes")), realtime_trigger)
        tables["events_per_minute"] = (events_per_minute(metrics("5 minutes")), realtime_trigger)
    queries = [
        write_raw_stream(
            events, f"{output}/raw", f"{checkpoints}/raw", trigger=trigger, files_per_hour=files_per_hour
        )
    ]
    for name, (frame, interval) in tables.items():
        queries.append(
            start_append(
                frame, f"{output}/{name}", f"{checkpoints}/{name}", name=name, trigger=interval
            )
        )
    return queries


def start_dead_letters(
    events: DataFrame, output: str, checkpoints: str, *, trigger: str | None = DEFAULT_TRIGGER
) -> StreamingQuery:
    """Append events that break a rule, with the reasons, to their own table."""
    return start_append(
        rejected_events(validate_events(events)),
        f"{output}/rejected",
        f"{checkpoints}/rejected",
        name="rejected",
        trigger=trigger,
    )


def valid_only(events: DataFrame) -> DataFrame:
    """The events an ingest service would have let through."""
    return accepted_events(validate_events(events))


def await_all(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Wait until all queries have ended; the first failure stops the rest and is raised.

    Only these queries are waited for: what other queries of the session ended with before is none of theirs.
    """
    running = list(queries)
    try:
        while any(q.isActive for q in running):
            for query in running:
                query.awaitTermination(0.2)  # raises its failure
        for query in running:
            if query.exception() is not None:
                raise query.exception()
    finally:
        for query in running:
            if query.isActive:
                query.stop()
