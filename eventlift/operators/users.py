"""User dimension: lifetime measures, modes, ratios and segment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlift.functions import percent, ratio, round_n
from eventlift.operators.activity import activity_rollup, measure

_SUMMED = [
    "events",
    "interaction_events",
    "flow_events",
    "quizzes_started",
    "quizzes_completed",
    "results_shared",
    "ctas_clicked",
    "match_score_sum",
    "match_score_count",
    "total_time_ms_sum",
    "total_time_ms_count",
]


def as_of_column(as_of: dt.datetime | dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def _most_frequent(kind: str) -> Column:
    """Value with the highest count; the smallest value on a tie; NULL without any."""
    ranked = (
        f"CASE WHEN kind = '{kind}' AND value IS NOT NULL"
        " THEN named_struct('rank', -events, 'value', value) END"
    )
    return F.expr(f"min({ranked}).value")


def user_metrics(source: DataFrame) -> DataFrame:
    """Per user: first and last event, distinct sessions and days, sums, modes.

    Two distinct counts and two modes need four groupings below the user.  They share
    one pass: each rollup row becomes four ``(kind, value)`` rows, the first of which
    carries the measures; counts are combined per (user, kind, value), which spreads a
    heavy user over all its sessions, and only those results meet per user.
    """
    activity = activity_rollup(source)
    summed = [c for c in _SUMMED if c != "events"]
    carried = ["first_event_at", "last_event_at", *summed]
    kinds = F.expr(
        "explode(array("
        "named_struct('kind', 'session', 'value', session_id),"
        "named_struct('kind', 'day', 'value', CAST(event_date AS STRING)),"
        "named_struct('kind', 'device', 'value', device_type),"
        "named_struct('kind', 'zone', 'value', user_timezone))) AS k"
    )
    long_rows = activity.select("user_id", "events", *carried, kinds).selectExpr(
        "user_id",
        "k.kind",
        "k.value",
        "events",
        *[f"CASE WHEN k.kind = 'session' THEN {c} END AS {c}" for c in carried],
    )
    combined = long_rows.groupBy("user_id", "kind", "value").agg(
        F.min("first_event_at").alias("first_event_at"),
        F.max("last_event_at").alias("last_event_at"),
        *[F.expr(f"sum({c}) AS {c}") for c in _SUMMED],
    )
    distinct = lambda kind: F.expr(f"count(CASE WHEN kind = '{kind}' THEN value END)")
    return combined.groupBy("user_id").agg(
        F.min("first_event_at").alias("first_seen_at"),
        F.max("last_event_at").alias("last_seen_at"),
        distinct("session").alias("total_sessions"),
        distinct("day").alias("active_days"),
        F.expr("sum(CASE WHEN kind = 'session' THEN events END)").alias("total_events"),
        *[F.expr(f"sum({c}) AS {c}") for c in summed],
        _most_frequent("device").alias("primary_device"),
        _most_frequent("zone").alias("primary_timezone"),
    )


def user_segment() -> Column:
    completed, shared = F.col("quizzes_completed"), F.col("results_shared")
    return (
        F.when((completed >= 3) & (shared > 0), F.lit("power_user"))
        .when(completed >= 1, F.lit("engaged"))
        .when(F.col("quizzes_started") >= 1, F.lit("explorer"))
        .otherwise(F.lit("visitor"))
    )


def dim_users(source: DataFrame, as_of=None) -> DataFrame:
    """The user dimension from the fact table or its activity rollup.

    ``as_of`` is the moment the "days since" columns count to; now unless given.
    """
    moment = as_of_column(as_of)
    days = lambda start, end: F.datediff(end, start).cast("long")
    first, last = F.col("first_seen_at"), F.col("last_seen_at")
    started, completed = F.col("quizzes_started"), F.col("quizzes_completed")
    return user_metrics(source).select(
        "user_id",
        "first_seen_at",
        "last_seen_at",
        days(first, last).alias("user_tenure_days"),
        days(first, moment).alias("days_since_first_seen"),
        days(last, moment).alias("days_since_last_seen"),
        "total_sessions",
        "active_days",
        "total_events",
        "interaction_events",
        "flow_events",
        round_n(ratio(F.col("total_events"), F.col("total_sessions")), 1).alias("avg_events_per_session"),
        round_n(ratio(F.col("total_sessions"), F.col("active_days")), 2).alias("sessions_per_active_day"),
        "quizzes_started",
        "quizzes_completed",
        F.when(started > 0, round_n(percent(completed, started), 1))
        .otherwise(F.lit(0.0))
        .alias("quiz_completion_rate"),
        "results_shared",
        "ctas_clicked",
        user_segment().alias("user_segment"),
        "primary_device",
        "primary_timezone",
        ratio(F.col("match_score_sum"), F.col("match_score_count")).alias("avg_match_score"),
        ratio(F.col("total_time_ms_sum"), F.col("total_time_ms_count")).alias("avg_completion_time_ms"),
        moment.alias("updated_at"),
    )


def user_segments(users: DataFrame) -> DataFrame:
    """Users, events and shares per segment."""
    return users.groupBy("user_segment").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("total_events").alias("total_events"),
        F.sum("results_shared").alias("results_shared"),
    )


def user_primary_device(source: DataFrame) -> DataFrame:
    """Most used device per user, counted per (user, device) first."""
    per_device = (
        source.where(F.col("device_type").isNotNull())
        .groupBy("user_id", "device_type")
        .agg(measure(source, "events").alias("events"))
    )
    best = F.min(F.struct((-F.col("events")).alias("rank"), F.col("device_type")))
    return per_device.groupBy("user_id").agg(
        best["device_type"].alias("primary_device"),
        (-best["rank"]).alias("device_events"),
    )
