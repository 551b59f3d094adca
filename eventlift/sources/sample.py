"""Adapter from a plain ``events`` table to canonical raw events.

The table holds ``event_id, ts, user_id, event_type, value, props``.  Integer rules
on ``event_id``, ``user_id`` and ``props.k`` spread its rows over all event types,
devices, bots, missing users and redeliveries (see FIXTURES.md), so that every
operator meets its edge cases on data derived row by row from the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventlift import schema

# Fixed values of the mapping.
USE_CASES = ["analytics", "engineering", "ml", "realtime"]
FEATURES = ["opensource", "cloud", "sql", "python", "governance", "lowcode"]
TOOLS = ["databricks", "snowflake", "duckdb", "kafka", "airflow", "metabase"]
PLATFORMS = ["twitter", "linkedin", "email", "copy_link"]
# Chosen for the mode: a value that two remainders share, and undeclared ones.
ZONES = ["UTC", "UTC", "Europe/Vienna", "Australia/Perth", "Africa/Lagos", "Nowhere/Undeclared", "America/Lima"]
LOCALES = ["nl-NL", "nl-NL", "pt-BR", "sv-SE", "x-test"]
DEVICE_AGENTS = {
    "desktop": "Mozilla/5.0 (X11; Linux x86_64)",
    "mobile": "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0) Mobile/15E148",
    "tablet": "Mozilla/5.0 (iPad; CPU OS 17_0)",
}
BOT_AGENT = "Googlebot/2.1"

# Event types of each base type, picked by ``k`` modulo the length of the list.
BASE_TYPES = {
    "view": ["page_view", "feature_view", "question_viewed", "question_viewed"],
    "signup": ["session_start", "quiz_started", "quiz_started", "quiz_started"],
    "click": [
        "slider_adjusted",
        "slider_adjusted",
        "option_selected",
        "option_deselected",
        "cta_clicked",
        "slider_adjusted",
        "slider_adjusted",
        "option_selected",
        "option_deselected",
        "link_clicked",
    ],
    "purchase": [
        "quiz_completed",
        "quiz_completed",
        "quiz_step_completed",
        "result_viewed",
        "result_shared",
        "result_saved",
    ],
    "error": [
        "quiz_abandoned",
        "session_end",
        "unknown_type",
        "quiz_step_completed",
        "quiz_step_completed",
    ],
}


def _array(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _pick(values: list[str], index: str) -> str:
    """Look a constant up by position; a literal array keeps the generated code short."""
    return f"element_at({_array(values)}, CAST({index} AS INT) + 1)"


def _type_rule() -> str:
    branches = " ".join(
        f"WHEN '{base}' THEN {_pick(types, f'k % {len(types)}')}" for base, types in BASE_TYPES.items()
    )
    return f"CASE base {branches} ELSE 'unknown_type' END"


_PROPERTY_RULES = {
    "question_id": "CASE event_type WHEN 'question_viewed' THEN 1 + id % 4"
    " WHEN 'slider_adjusted' THEN IF(id % 2 = 0, 1, 4)"
    " WHEN 'option_selected' THEN IF(id % 2 = 0, 2, 3)"
    " WHEN 'option_deselected' THEN IF(id % 2 = 0, 2, 3) END",
    "step_number": "CASE WHEN event_type IN"
    " ('question_viewed', 'quiz_step_completed', 'quiz_abandoned') THEN 1 + id % 4 END",
    "total_steps": "CASE WHEN event_type IN"
    " ('quiz_started', 'question_viewed', 'quiz_step_completed') THEN 4 END",
    "slider_value": "CASE WHEN event_type = 'slider_adjusted' THEN k END",
    "previous_value": "CASE WHEN event_type = 'slider_adjusted' THEN (k * 7) % 101 END",
    "option_id": "CASE WHEN event_type IN ('option_selected', 'option_deselected') THEN"
    f" IF(id % 2 = 0, {_pick(USE_CASES, '(id div 2) % 4')}, {_pick(FEATURES, '(id div 2) % 6')}) END",
    "recommendation_id": "CASE WHEN event_type IN"
    " ('quiz_completed', 'result_viewed', 'result_shared', 'result_saved')"
    f" THEN {_pick(TOOLS, 'id % 6')} END",
    "match_score": "CASE WHEN event_type IN ('quiz_completed', 'result_viewed') THEN 65 + k % 35 END",
    "time_on_step_ms": "CASE WHEN event_type IN ('question_viewed', 'quiz_step_completed')"
    " THEN 1000 + k * 100 END",
    "total_time_ms": "CASE event_type WHEN 'quiz_completed' THEN 45000 + k * 750"
    " WHEN 'session_end' THEN 10000 + k * 500 END",
    "share_platform": f"CASE WHEN event_type = 'result_shared' THEN {_pick(PLATFORMS, 'id % 4')} END",
    "cta_id": "CASE WHEN event_type = 'cta_clicked' THEN 'learn_more' END",
}

# ``device_no`` numbers the device classes in the order of DEVICE_AGENTS.
_CONTEXT_RULES = {
    "user_agent": f"CASE WHEN id % 50 = 7 THEN '{BOT_AGENT}' WHEN id % 5 <> 0"
    f" THEN {_pick(list(DEVICE_AGENTS.values()), 'device_no')} END",
    "device_type": _pick(list(DEVICE_AGENTS), "device_no"),
    "screen_width": "element_at(array(1920, 390, 820), device_no + 1)",
    "screen_height": "element_at(array(1080, 844, 1180), device_no + 1)",
    "timezone": _pick(ZONES, "id % 7"),
    "locale": _pick(LOCALES, "id % 5"),
}


def _flat_fields(prefix: str, struct_type: T.StructType, rules: Mapping[str, str]) -> list[str]:
    return [
        f"CAST({rules[f.name]} AS {f.dataType.simpleString()}) AS {prefix}{f.name}"
        for f in struct_type.fields
        if f.name in rules
    ]


def _struct(prefix: str, struct_type: T.StructType, rules: Mapping[str, str]) -> str:
    values = [
        f"'{f.name}', {prefix + f.name if f.name in rules else f'CAST(NULL AS {f.dataType.simpleString()})'}"
        for f in struct_type.fields
    ]
    return f"named_struct({', '.join(values)})"


def _iso(column: str) -> str:
    return f"""date_format({column}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")"""


def raw_events_from_table(events: DataFrame) -> DataFrame:
    """Canonical raw rows (``schema.RAW`` plus the integer ``id``), redeliveries included.

    Everything is a per-row expression; nothing shuffles.  Nested fields are computed as
    plain columns first and only then put into structs, so that a query which reads a few
    of them computes only those.
    """
    base = (
        events.selectExpr(
            "event_id AS id",
            "user_id AS u",
            "CAST(ts AS TIMESTAMP) AS event_timestamp",
            "event_type AS base",
            "CAST(get_json_object(props, '$.k') AS INT) AS k",
        )
        .selectExpr(
            "id",
            "u",
            "k",
            "event_timestamp",
            "to_date(event_timestamp) AS event_date",
            "hour(event_timestamp) AS event_hour",
            f"{_type_rule()} AS event_type",
            "CASE WHEN (id + u) % 20 < 11 THEN 0 WHEN (id + u) % 20 < 18 THEN 1 ELSE 2 END AS device_no",
            "timestamp_micros(unix_micros(event_timestamp) + k * 10000) AS arrived",
            "explode(IF(id % 20 = 0, array(0, 60), array(0))) AS delay",
        )
        .selectExpr(
            "*",
            "concat_ws('', 'u', u, IF(u % 3 = 0, '', concat_ws('', '_', day(event_date)))) AS mapped_user",
            *_flat_fields("p_", schema.PROPERTIES, _PROPERTY_RULES),
            *_flat_fields("c_", schema.CONTEXT, _CONTEXT_RULES),
        )
    )
    return base.selectExpr(
        "CAST(id AS STRING) AS event_id",
        "IF(id % 97 = 0, NULL, mapped_user) AS user_id",
        "concat_ws('', mapped_user, '-', event_date,"
        " IF(u % 2 = 0 AND event_hour >= 12, 'b', 'a')) AS session_id",
        "event_type",
        f"{_struct('p_', schema.PROPERTIES, _PROPERTY_RULES)} AS event_properties",
        f"IF(id % 4 = 0, 'pricing_page', '{schema.DEFAULT_FEATURE}') AS feature_name",
        f"{_struct('c_', schema.CONTEXT, _CONTEXT_RULES)} AS context",
        f"{_iso('event_timestamp')} AS timestamp",
        f"{_iso('arrived')} AS received_at",
        "arrived AS kafka_timestamp",
        "event_timestamp",
        "timestamp_micros(unix_micros(event_timestamp) + (1 + k % 9 + delay) * 1000000) AS processed_at",
        "event_date",
        "event_hour",
        "id",
    )
