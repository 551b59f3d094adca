"""Staging view and event fact table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlift import schema
from eventlift.functions import percent, ratio, round_n
from eventlift.operators.quality import is_human

_REQUIRED = ("event_id", "user_id", "session_id", "event_type")
_NOT_FLATTENED = {"extra"}
_CONTEXT_KEPT = {
    "page_url": "page_url",
    "page_path": "page_path",
    "referrer": "referrer",
    "device_type": "device_type",
    "screen_width": "screen_width",
    "screen_height": "screen_height",
    "timezone": "user_timezone",
    "locale": "user_locale",
}


def staged_rows(raw: DataFrame, include_bot_traffic: bool = False) -> DataFrame:
    """Raw rows that staging keeps: all keys present and, unless asked not to, no bots."""
    # One IS NOT NULL per column, which Parquet can evaluate; dropna() would not push.
    kept = raw.where(reduce(and_, [F.col(c).isNotNull() for c in _REQUIRED]))
    return kept if include_bot_traffic else kept.where(is_human(F.col("context.user_agent")))


def stg_events(raw: DataFrame, include_bot_traffic: bool = False) -> DataFrame:
    """Flatten raw events, drop rows without keys and, unless asked not to, bots.

    A projection and a filter only: the null tests and the column list reach the
    Parquet scan, nested fields included.
    """
    return staged_rows(raw, include_bot_traffic).selectExpr(
        *_REQUIRED,
        "feature_name",
        "CAST(event_timestamp AS TIMESTAMP) AS event_timestamp",
        "CAST(processed_at AS TIMESTAMP) AS processed_at",
        "event_date",
        "CAST(event_hour AS INT) AS event_hour",
        *[f"event_properties.{n} AS {n}" for n in schema.PROPERTIES.names if n not in _NOT_FLATTENED],
        *[f"context.{name} AS {alias}" for name, alias in _CONTEXT_KEPT.items()],
    )


def event_category(event_type: str = "event_type") -> Column:
    branches = " ".join(
        f"WHEN '{t}' THEN '{category}'" for category, types in schema.CATEGORY_TYPES.items() for t in types
    )
    return F.expr(f"CASE {event_type} {branches} ELSE '{schema.OTHER_CATEGORY}' END")


def flow_progress_pct() -> Column:
    return F.when(
        F.col("total_steps") > 0, round_n(percent(F.col("step_number"), F.col("total_steps")), 1)
    )


def slider_change_magnitude() -> Column:
    return F.abs(F.col("slider_value") - F.col("previous_value"))


def fact_events(stg: DataFrame) -> DataFrame:
    """Staged events with category, flow progress and derived measures."""
    wide, high = F.col("screen_width"), F.col("screen_height")
    on_step = F.col("time_on_step_ms")
    return stg.select(
        "event_id",
        "user_id",
        "session_id",
        "event_type",
        "feature_name",
        "event_timestamp",
        "event_date",
        "event_hour",
        "processed_at",
        event_category().alias("event_category"),
        "step_number",
        "total_steps",
        flow_progress_pct().alias("flow_progress_pct"),
        "slider_value",
        "previous_value",
        slider_change_magnitude().alias("slider_change_magnitude"),
        "option_id",
        "option_label",
        "recommendation_id",
        "recommendation_name",
        "match_score",
        "share_platform",
        "time_on_step_ms",
        "total_time_ms",
        F.when(on_step > 0, round_n(on_step / F.lit(1000.0), 2)).alias("time_on_step_seconds"),
        "device_type",
        "page_path",
        "referrer",
        "user_timezone",
        "user_locale",
        "screen_width",
        "screen_height",
        F.when((wide > 0) & (high > 0), round_n(ratio(wide, high), 2)).alias("screen_aspect_ratio"),
    )


def event_category_counts(fact: DataFrame) -> DataFrame:
    return fact.groupBy("event_category").agg(F.count(F.lit(1)).alias("event_count"))


def slider_stats(fact: DataFrame) -> DataFrame:
    """Slider movement per feature and day."""
    moved = F.col("slider_change_magnitude")
    return (
        fact.where(moved.isNotNull())
        .groupBy("feature_name", "event_date")
        .agg(
            F.count(F.lit(1)).alias("slider_moves"),
            F.avg(moved).alias("avg_change"),
            F.max(moved).alias("max_change"),
        )
    )
