"""Daily engagement: active users, adoption, session depth and the KPI table.

``source`` is the fact table or its activity rollup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlift.functions import exact_percentile, percent, ratio, round_n
from eventlift.operators.activity import measure, measures, other_type
from eventlift.operators.users import as_of_column


def _reached(column: str) -> Column:
    return F.when(F.col(column) > 0, F.lit(1)).otherwise(F.lit(0))


def daily_active_users(source: DataFrame) -> DataFrame:
    return source.groupBy("event_date").agg(F.count_distinct("user_id").alias("dau"))


def feature_adoption(source: DataFrame) -> DataFrame:
    """Distinct users and sessions with an interaction or flow event, per day.

    Events are combined per user and session first, so the two distinct counts expand
    session rows and not events.
    """
    adopted = (
        source.groupBy("event_date", "user_id", "session_id")
        .agg((measure(source, "interaction_events") + measure(source, "flow_events")).alias("n"))
        .where(F.col("n") > 0)
    )
    return adopted.groupBy("event_date").agg(
        F.count_distinct("user_id").alias("feature_users"),
        F.count_distinct("session_id").alias("feature_sessions"),
        F.sum("n").alias("total_interactions"),
    )


def daily_funnel_users(source: DataFrame) -> DataFrame:
    """Distinct users who started, completed and shared, per day."""
    steps = {
        "started_users": "quizzes_started",
        "completed_users": "quizzes_completed",
        "shared_users": "results_shared",
    }
    per_user = source.groupBy("event_date", "user_id").agg(*measures(source, *steps.values()))
    return per_user.groupBy("event_date").agg(
        *[F.sum(_reached(column)).alias(name) for name, column in steps.items()]
    )


def session_engagement(source: DataFrame) -> DataFrame:
    """One row per session, user and day."""
    bits = measure(source, "type_bits")
    return (
        source.withColumn("__other", other_type(source))
        .groupBy("session_id", "user_id", "event_date")
        .agg(
            measure(source, "events").alias("events_in_session"),
            (F.bit_count(bits) + F.count_distinct("__other")).alias("unique_event_types"),
            *measures(source, "slider_adjustments", "option_selections"),
            measure(source, "max_step").alias("max_step_reached"),
            measure(source, "max_total_steps").alias("total_steps"),
            measure(source, "max_total_time_ms").alias("session_duration_ms"),
            measure(source, "max_match_score").alias("final_match_score"),
            F.least(measure(source, "quizzes_completed"), F.lit(1)).cast("int").alias("completed_quiz"),
            F.least(measure(source, "results_shared"), F.lit(1)).cast("int").alias("shared_result"),
            (measure(source, "interaction_events") + measure(source, "flow_events")).alias(
                "feature_interactions"
            ),
            measure(source, "quizzes_started").alias("quizzes_started"),
        )
    )


def median_session_duration(source: DataFrame) -> DataFrame:
    """Exact median of session durations per day, in milliseconds.

    Sessions without a duration do not count, so only events that carry one are read.
    """
    duration = "max_total_time_ms" if "type_bits" in source.columns else "total_time_ms"
    sessions = (
        source.where(F.col(duration).isNotNull())
        .groupBy("event_date", "user_id", "session_id")
        .agg(F.max(duration).alias("ms"))
    )
    return exact_percentile(sessions, ["event_date"], "ms", 0.5, "median_session_duration_ms")


def _session_progress() -> Column:
    return F.when(
        F.col("total_steps") > 0, percent(F.col("max_step_reached"), F.col("total_steps"))
    )


def session_summary(source: DataFrame) -> DataFrame:
    """Session averages and rates per day."""
    summary = session_engagement(source).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.avg("events_in_session").alias("avg_events_per_session"),
        F.avg("unique_event_types").alias("avg_unique_actions"),
        F.avg("slider_adjustments").alias("avg_slider_adjustments"),
        F.avg("option_selections").alias("avg_option_selections"),
        F.avg(_session_progress()).alias("avg_progress_pct"),
        (F.avg("session_duration_ms") / F.lit(1000.0)).alias("avg_session_duration_seconds"),
        F.sum("completed_quiz").alias("completed_sessions"),
        (F.avg("completed_quiz") * 100).alias("completion_rate_pct"),
        F.avg("final_match_score").alias("avg_match_score"),
        F.sum("shared_result").alias("shared_sessions"),
        (F.avg("shared_result") * 100).alias("share_rate_pct"),
    )
    return (
        summary.join(median_session_duration(source), "event_date", "left")
        .withColumn(
            "median_session_duration_seconds", F.col("median_session_duration_ms") / F.lit(1000.0)
        )
        .drop("median_session_duration_ms")
    )


def engagement_metrics(source: DataFrame, calculated_at=None) -> DataFrame:
    """The daily KPI table.

    All parts share the day as their key and every part covers a subset of the active
    days, so instead of joining four aggregates of the events, sessions are summed per
    user and day, and users per day, in one chain.  Only the exact median, which needs
    the single values, is joined: one row per day on each side.
    """
    sessions = session_engagement(source)
    progress = _session_progress()
    user_days = sessions.groupBy("event_date", "user_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("events_in_session").alias("events"),
        F.sum("slider_adjustments").alias("sliders"),
        F.sum("feature_interactions").alias("interactions"),
        F.sum("quizzes_started").alias("started"),
        F.sum("completed_quiz").alias("completed"),
        F.sum("shared_result").alias("shared"),
        F.sum(progress).alias("progress_sum"),
        F.count(progress).alias("progress_n"),
        F.sum(F.col("session_duration_ms").cast("long")).alias("duration_sum"),
        F.count("session_duration_ms").alias("duration_n"),
        F.sum("final_match_score").alias("score_sum"),
        F.count("final_match_score").alias("score_n"),
    )
    total = lambda name: F.sum(name).alias(name)
    days = user_days.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("dau"),
        *[
            F.sum(_reached(column)).alias(name)
            for name, column in {
                "feature_users": "interactions",
                "started_users": "started",
                "completed_users": "completed",
                "shared_users": "shared",
            }.items()
        ],
        total("sessions"),
        total("events"),
        total("sliders"),
        total("interactions"),
        total("shared"),
        total("progress_sum"),
        total("progress_n"),
        total("duration_sum"),
        total("duration_n"),
        total("score_sum"),
        total("score_n"),
    )
    days = days.join(median_session_duration(source), "event_date", "left")

    adopters = F.col("feature_users")
    per_session = lambda name: ratio(F.col(name), F.col("sessions"))
    or_zero = lambda column: F.coalesce(column, F.lit(0.0))
    return days.select(
        "event_date",
        "dau",
        "feature_users",
        # No adopter on an active day gives NULL here, not 0.
        round_n(percent(F.when(adopters > 0, adopters), F.col("dau")), 2).alias(
            "feature_adoption_rate_pct"
        ),
        F.col("interactions").alias("total_interactions"),
        or_zero(per_session("events")).alias("avg_events_per_session"),
        or_zero(per_session("sliders")).alias("avg_slider_adjustments"),
        or_zero(ratio(F.col("progress_sum"), F.col("progress_n"))).alias("avg_progress_pct"),
        or_zero(ratio(F.col("duration_sum"), F.col("duration_n")) / F.lit(1000.0)).alias(
            "avg_session_duration_seconds"
        ),
        or_zero(F.col("median_session_duration_ms") / F.lit(1000.0)).alias(
            "median_session_duration_seconds"
        ),
        or_zero(ratio(F.col("score_sum"), F.col("score_n"))).alias("avg_match_score"),
        F.col("started_users").alias("quiz_starts"),
        F.col("completed_users").alias("quiz_completions"),
        F.when(
            F.col("started_users") > 0,
            round_n(percent(F.col("completed_users"), F.col("started_users")), 2),
        )
        .otherwise(F.lit(0.0))
        .alias("quiz_completion_rate_pct"),
        F.col("shared_users").alias("result_shares"),
        or_zero(per_session("shared") * 100).alias("share_rate_pct"),
        as_of_column(calculated_at).alias("calculated_at"),
    ).orderBy(F.col("event_date").desc())


def engagement_window(source: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Events of the ``days`` days before ``as_of``; a filter on the partition column."""
    end = F.to_date(as_of_column(as_of))
    return source.where((F.col("event_date") >= F.date_sub(end, days)) & (F.col("event_date") < end))
