"""Seven-step conversion funnel, daily and overall.

``source`` is the fact table or its activity rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlift import schema
from eventlift.functions import percent, ratio, round_n
from eventlift.operators.activity import measure
from eventlift.operators.users import as_of_column

#: funnel step -> the measure that shows it was reached, in step order
_STEP_MEASURES = {
    "feature_view": "entry_events",
    "quiz_started": "quizzes_started",
    "question_1": "first_questions",
    "mid_quiz": "mid_quiz_events",
    "quiz_completed": "quizzes_completed",
    "result_viewed": "results_viewed",
    "result_shared": "results_shared",
}
_DAILY_COUNTS = {
    "step1_feature_view": "feature_view",
    "step2_quiz_started": "quiz_started",
    "step3_first_question": "question_1",
    "step4_mid_quiz": "mid_quiz",
    "step5_completed": "quiz_completed",
    "step6_result_viewed": "result_viewed",
    "step7_result_shared": "result_shared",
}


def _reached_flags(source: DataFrame):
    return [
        F.least(measure(source, name), F.lit(1)).cast("int").alias(f"reached_{step}")
        for step, name in _STEP_MEASURES.items()
    ]


def funnel_progress(source: DataFrame) -> DataFrame:
    """Steps reached per user, session and day (0/1), and the longest total time."""
    return source.groupBy("user_id", "session_id", "event_date").agg(
        *_reached_flags(source),
        measure(source, "max_total_time_ms").alias("completion_time_ms"),
    )


def funnel_daily(source: DataFrame) -> DataFrame:
    """Per day: distinct users, sessions at each step, mean time of completers."""
    finished = F.when(F.col("reached_quiz_completed") == 1, F.col("completion_time_ms"))
    return (
        funnel_progress(source)
        .groupBy("event_date")
        .agg(
            F.count_distinct("user_id").alias("total_users"),
            *[F.sum(f"reached_{step}").alias(name) for name, step in _DAILY_COUNTS.items()],
            F.avg(finished).alias("avg_completion_time_ms"),
        )
    )


def funnel_rates(source: DataFrame) -> DataFrame:
    """Daily counts with percent of users, step conversion, drop-off and timing.

    Steps are independent flags per session and day while the base is distinct users,
    so a percentage may exceed 100.
    """
    counts = list(_DAILY_COUNTS)
    rate = lambda part, whole: percent(F.col(part), F.col(whole))
    pairs = list(zip(counts, counts[1:]))
    columns = [round_n(rate(c, "total_users"), 2).alias(f"step{i}_pct") for i, c in enumerate(counts, 1)]
    columns += [
        round_n(rate(after, before), 2).alias(f"conv_{i}_to_{i + 1}")
        for i, (before, after) in enumerate(pairs, 1)
    ]
    columns += [
        round_n(F.lit(100.0) - rate(after, before), 2).alias(f"dropoff_{i}_to_{i + 1}")
        for i, (before, after) in enumerate(pairs[:4], 1)
    ]
    return funnel_daily(source).select(
        "event_date",
        "total_users",
        *counts,
        *columns,
        round_n(rate("step5_completed", "step1_feature_view"), 2).alias("overall_completion_rate"),
        round_n(rate("step7_result_shared", "step5_completed"), 2).alias("share_after_completion_rate"),
        round_n(F.col("avg_completion_time_ms") / F.lit(1000.0), 1).alias("avg_completion_time_seconds"),
    )


def funnel_analysis(source: DataFrame, calculated_at=None) -> DataFrame:
    """The daily funnel mart, newest day first."""
    return (
        funnel_rates(source)
        .withColumn("calculated_at", as_of_column(calculated_at))
        .orderBy(F.col("event_date").desc())
    )


def funnel_long(source: DataFrame) -> DataFrame:
    """Overall funnel, one row per step, counting distinct users at every step.

    Flags are combined per user, then summed to a single row, which is unpivoted onto
    the fixed step list; the previous step is a neighbouring column, not a window.
    """
    per_user = source.groupBy("user_id").agg(*_reached_flags(source))
    names = [name for _, name, _ in schema.FUNNEL_STEPS]
    total = per_user.agg(*[F.coalesce(F.sum(f"reached_{n}"), F.lit(0)).alias(n) for n in names])
    rows = []
    for order, name, label in schema.FUNNEL_STEPS:
        previous = F.col(names[order - 2]) if order > 1 else None
        conversion = F.lit(1.0) if previous is None else ratio(F.col(name), previous)
        rows.append(
            F.struct(
                F.lit(order).alias("step_order"),
                F.lit(name).alias("step_key"),
                F.lit(label).alias("step_name"),
                F.col(name).alias("users_reached"),
                conversion.alias("conversion_from_previous"),
                (F.lit(1.0) - conversion).alias("dropoff_rate"),
                percent(F.col(name), F.col(names[0])).alias("percent_of_initial"),
            )
        )
    drop = F.col("dropoff_rate") * 100
    band = (
        F.when((F.col("step_order") == 1) | drop.isNull(), F.lit(None).cast("string"))
        .when(drop < 12, F.lit("green"))
        .when(drop < 20, F.lit("amber"))
        .otherwise(F.lit("red"))
    )
    return (
        total.select(F.explode(F.array(*rows)).alias("s"))
        .select("s.*")
        .withColumn("dropoff_band", band)
        .orderBy("step_order")
    )
