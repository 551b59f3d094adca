"""Result tables behind dashboards: cards, trends, breakdowns and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlift import schema
from eventlift.functions import percent, round_n
from eventlift.operators.activity import measure

ADOPTION_BASELINE_PCT = 30.0


def latest_metrics(metrics: DataFrame, days: int = 30) -> DataFrame:
    """The newest ``days`` rows of the KPI table."""
    return metrics.orderBy(F.col("event_date").desc()).limit(days)


def kpi_cards(metrics: DataFrame) -> DataFrame:
    """The newest day's headline numbers and the adoption delta to the baseline."""
    return latest_metrics(metrics, 1).select(
        "event_date",
        F.col("feature_adoption_rate_pct").alias("adoption_rate_pct"),
        (F.col("feature_adoption_rate_pct") - ADOPTION_BASELINE_PCT).alias("adoption_delta_pct"),
        "avg_events_per_session",
        "quiz_completion_rate_pct",
        "avg_session_duration_seconds",
        "avg_match_score",
        "share_rate_pct",
    )


def engagement_trends(metrics: DataFrame) -> DataFrame:
    """Completion and depth over time, oldest day first."""
    return metrics.select(
        "event_date",
        "dau",
        "feature_adoption_rate_pct",
        "quiz_completion_rate_pct",
        "avg_events_per_session",
        "avg_session_duration_seconds",
    ).orderBy("event_date")


def metrics_last_n_days(metrics: DataFrame, days: int | None = 7) -> DataFrame:
    """KPI rows of the ``days`` days up to the newest one; all of them for ``None``.

    The KPI table has one row per day, so a window over all of it stays small.
    """
    if days is None:
        return metrics.orderBy(F.col("event_date").desc())
    newest = F.max("event_date").over(Window.partitionBy(F.lit(0)))
    return (
        metrics.withColumn("__newest", newest)
        .where(F.col("event_date") > F.date_sub("__newest", days))
        .drop("__newest")
        .orderBy(F.col("event_date").desc())
    )


def event_breakdown(fact: DataFrame) -> DataFrame:
    """Events, users and sessions by type and category.

    Users and sessions are counted from combined (type, user, session) rows.
    """
    per_session = fact.groupBy("event_type", "event_category", "user_id", "session_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_session.groupBy("event_type", "event_category").agg(
        F.sum("n").alias("event_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
    )


def device_distribution(source: DataFrame) -> DataFrame:
    """Sessions, share of sessions and completion rate per device class.

    Anything but a declared class counts as ``unknown``, so the share's total runs over
    four rows at most.
    """
    declared = F.col("device_type").isin(schema.DEVICE_TYPES)
    device = F.when(declared, F.col("device_type")).otherwise(F.lit(schema.DEFAULT_DEVICE))
    per_session = source.groupBy(device.alias("device_type"), "session_id").agg(
        F.least(measure(source, "quizzes_completed"), F.lit(1)).alias("completed")
    )
    devices = per_session.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("completed").alias("completed_sessions")
    )
    everything = Window.partitionBy(F.lit(0))
    return devices.select(
        "device_type",
        "sessions",
        round_n(percent(F.col("sessions"), F.sum("sessions").over(everything)), 2).alias("share_pct"),
        round_n(percent(F.col("completed_sessions"), F.col("sessions")), 2).alias("completion_rate_pct"),
    )


def hourly_pattern(fact: DataFrame) -> DataFrame:
    """Events per hour of day, all 24 hours present."""
    hours = fact.sparkSession.range(24).select(F.col("id").cast("int").alias("hour_of_day"))
    counts = fact.groupBy(F.col("event_hour").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return (
        hours.join(counts, "hour_of_day", "left")
        .select("hour_of_day", F.coalesce("event_count", F.lit(0)).alias("event_count"))
        .orderBy("hour_of_day")
    )


def events_this_hour(fact: DataFrame, as_of) -> DataFrame:
    """Events in the clock hour that contains ``as_of``, one row."""
    moment = F.lit(as_of).cast("timestamp")
    return fact.where(
        (F.col("event_date") == F.to_date(moment)) & (F.col("event_hour") == F.hour(moment))
    ).agg(F.count(F.lit(1)).alias("event_count"))
