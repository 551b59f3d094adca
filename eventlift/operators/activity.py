"""The shared measures of all batch marts, and the rollup that holds them.

A measure is an expression on fact rows together with the way its partial results
merge.  ``measure(df, name)`` therefore aggregates fact rows and already rolled-up
rows alike, and every mart accepts either: the fact table directly, or the
``activity_rollup`` of it when several marts are built and one scan should serve all.

All measures have fixed-width buffers, so their aggregation is hash-based with partial
results before the shuffle: a session or user with a huge share of the events adds one
row per task, not its events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlift import schema

ROLLUP_KEYS = ["event_date", "user_id", "session_id", "device_type", "user_timezone", "other_type"]


def _quoted(types: Sequence[str]) -> str:
    return ", ".join(f"'{t}'" for t in types)


def _one_if(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def _is(*types: str) -> str:
    return _one_if(f"event_type IN ({_quoted(types)})")


def _in_category(name: str) -> str:
    return _is(*schema.CATEGORY_TYPES[name])


def _type_bit() -> str:
    """One bit per declared type; no bit for an undeclared one (see ``other_type``)."""
    branches = [f"WHEN '{name}' THEN {1 << i}" for i, name in enumerate(schema.EVENT_TYPES)]
    return f"CASE event_type {' '.join(branches)} ELSE 0 END"


#: name -> (merge function, SQL expression on fact rows)
_MEASURES = {
    "first_event_at": ("min", "event_timestamp"),
    "last_event_at": ("max", "event_timestamp"),
    "events": ("sum", "1"),
    "interaction_events": ("sum", _in_category("interaction")),
    "flow_events": ("sum", _in_category("flow")),
    "quizzes_started": ("sum", _is("quiz_started")),
    "quizzes_completed": ("sum", _is("quiz_completed")),
    "results_viewed": ("sum", _is("result_viewed")),
    "results_shared": ("sum", _is("result_shared")),
    "ctas_clicked": ("sum", _is("cta_clicked")),
    "slider_adjustments": ("sum", _is("slider_adjusted")),
    "option_selections": ("sum", _is("option_selected")),
    "entry_events": ("sum", _is("feature_view", "page_view", "quiz_started")),
    "first_questions": ("sum", _one_if("event_type = 'question_viewed' AND step_number = 1")),
    "mid_quiz_events": ("sum", _one_if("flow_progress_pct >= 50")),
    "type_bits": ("bit_or", _type_bit()),
    "max_step": ("max", "step_number"),
    "max_total_steps": ("max", "total_steps"),
    "max_total_time_ms": ("max", "total_time_ms"),
    "total_time_ms_sum": ("sum", "CAST(total_time_ms AS BIGINT)"),
    "total_time_ms_count": ("sum", _one_if("total_time_ms IS NOT NULL")),
    "max_match_score": ("max", "match_score"),
    "match_score_sum": ("sum", "match_score"),
    "match_score_count": ("sum", _one_if("match_score IS NOT NULL")),
}


def is_rollup(df: DataFrame) -> bool:
    return "type_bits" in df.columns


def measure_sql(df: DataFrame, name: str) -> str:
    """Aggregate expression of a measure over fact rows or rollup rows."""
    merge, expression = _MEASURES[name]
    return f"{merge}({name if is_rollup(df) else expression})"


def measure(df: DataFrame, name: str) -> Column:
    return F.expr(measure_sql(df, name))


def measures(df: DataFrame, *names: str) -> list[Column]:
    return [F.expr(f"{measure_sql(df, name)} AS {name}") for name in names]


def other_type(df: DataFrame) -> Column:
    """The event type where it is not a declared one, else NULL."""
    if is_rollup(df):
        return F.col("other_type")
    declared = _quoted(schema.EVENT_TYPES)
    return F.expr(f"CASE WHEN event_type NOT IN ({declared}) THEN event_type END")


def activity_rollup(fact: DataFrame) -> DataFrame:
    """Fact rows summed up per day, user, session, device, time zone and undeclared type.

    Ordinary traffic gives one row per session and day.  Undeclared types are part of
    the key, so that distinct types stay exactly countable: the declared ones from
    ``type_bits``, the others from the key.
    """
    if is_rollup(fact):
        return fact
    return (
        fact.withColumn("other_type", other_type(fact))
        .groupBy(*ROLLUP_KEYS)
        .agg(*measures(fact, *_MEASURES))
    )
