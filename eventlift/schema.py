"""The declared event contract: types, enumerations and validation limits."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# These must equal the wire contract, so they are plain literals.
# --------------------------------------------------------------------------

#: Accepted event types, grouped by the category the fact table gives them.
CATEGORY_TYPES = {
    "view": ["page_view", "feature_view"],
    "flow": ["quiz_started", "quiz_step_completed", "quiz_completed", "quiz_abandoned"],
    "interaction": ["slider_adjusted", "option_selected", "option_deselected", "question_viewed"],
    "outcome": ["result_viewed", "result_shared", "result_saved"],
    "engagement": ["cta_clicked", "link_clicked"],
    "session": ["session_start", "session_end"],
}
OTHER_CATEGORY = "other"

EVENT_TYPES = [t for group in CATEGORY_TYPES.values() for t in group]
DEVICE_TYPES = ["desktop", "mobile", "tablet", "unknown"]

DEFAULT_FEATURE = "product_configurator"
DEFAULT_DEVICE = "unknown"

#: Step number of each event type in the streaming funnel.
STREAM_FUNNEL_STEPS = {
    "quiz_started": 1,
    "question_viewed": 2,
    "quiz_step_completed": 3,
    "quiz_completed": 4,
    "result_viewed": 5,
    "result_shared": 6,
}

#: (order, key, label) of the seven-step batch funnel.
FUNNEL_STEPS = [
    (1, "feature_view", "Feature Viewed"),
    (2, "quiz_started", "Quiz Started"),
    (3, "question_1", "First Question"),
    (4, "mid_quiz", "Mid-Quiz (50%)"),
    (5, "quiz_completed", "Quiz Completed"),
    (6, "result_viewed", "Result Viewed"),
    (7, "result_shared", "Result Shared"),
]

#: Inclusive numeric limits, (field, low, high); None leaves a side open.
RANGE_RULES = [
    ("context.screen_width", 0, None),
    ("context.screen_height", 0, None),
    ("context.viewport_width", 0, None),
    ("context.viewport_height", 0, None),
    ("event_properties.step_number", 1, None),
    ("event_properties.total_steps", 1, None),
    ("event_properties.slider_value", 0, 100),
    ("event_properties.previous_value", 0, 100),
    ("event_properties.match_score", 0, 100),
    ("event_properties.time_on_step_ms", 0, None),
    ("event_properties.total_time_ms", 0, None),
]

MAX_BATCH_EVENTS = 1000

# With or without hyphens, braces and the URN prefix; no line end may follow.
UUID_PATTERN = r"^(urn:uuid:)?\{?[0-9a-fA-F]{8}(-?[0-9a-fA-F]{4}){3}-?[0-9a-fA-F]{12}\}?\z"

# --------------------------------------------------------------------------
# Spark types; field names and order are fixed by the wire contract.
# --------------------------------------------------------------------------

_TEXT, _INT, _REAL, _TIME = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CONTEXT = _struct(
    {
        "page_url": _TEXT,
        "page_path": _TEXT,
        "referrer": _TEXT,
        "user_agent": _TEXT,
        "device_type": _TEXT,
        "screen_width": _INT,
        "screen_height": _INT,
        "viewport_width": _INT,
        "viewport_height": _INT,
        "timezone": _TEXT,
        "locale": _TEXT,
    }
)

#: Real numbers are double, not 32-bit float: same formulas, no float rounding.
PROPERTIES = _struct(
    {
        "question_id": _INT,
        "step_number": _INT,
        "total_steps": _INT,
        "slider_value": _REAL,
        "previous_value": _REAL,
        "option_id": _TEXT,
        "option_label": _TEXT,
        "selected_options": T.ArrayType(_TEXT),
        "recommendation_id": _TEXT,
        "recommendation_name": _TEXT,
        "match_score": _REAL,
        "time_on_step_ms": _INT,
        "total_time_ms": _INT,
        "share_platform": _TEXT,
        "cta_id": _TEXT,
        "cta_label": _TEXT,
        "extra": T.MapType(_TEXT, _TEXT),
    }
)

#: One event as it travels in JSON.
EVENT = _struct(
    {
        "event_id": _TEXT,
        "user_id": _TEXT,
        "session_id": _TEXT,
        "event_type": _TEXT,
        "event_properties": PROPERTIES,
        "feature_name": _TEXT,
        "context": CONTEXT,
        "timestamp": _TEXT,
        "received_at": _TEXT,
    }
)

#: One row of the raw lake: the event plus ingest metadata and partition keys.
RAW = T.StructType(
    EVENT.fields
    + _struct(
        {
            "kafka_timestamp": _TIME,
            "event_timestamp": _TIME,
            "processed_at": _TIME,
            "event_date": T.DateType(),
            "event_hour": _INT,
        }
    ).fields
)

#: Message contract shared by the broker source and the file source.
ENVELOPE = _struct({"key": _TEXT, "value": T.BinaryType(), "timestamp": _TIME})
