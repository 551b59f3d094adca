"""Quiz answers per session and the tool recommendation they lead to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tools in the order that decides ties, and the points they earn.
TOOLS = ["databricks", "snowflake", "duckdb", "kafka", "airflow", "metabase"]
FEATURES = ["opensource", "cloud", "sql", "python", "governance", "lowcode"]
BASE_SCORE = 50
MAX_SCORE = 200
MAX_PERCENT = 99
DEFAULT_TEAM_SIZE = 10
DEFAULT_BUDGET = 100
SMALL_TEAM = 5
MEDIUM_TEAM = 25
LOW_BUDGET = 50
HIGH_BUDGET = 300

TEAM_POINTS = {
    "small": {"duckdb": 30, "metabase": 20},
    "medium": {"airflow": 20, "metabase": 25},
    "large": {"databricks": 25, "snowflake": 30, "kafka": 20},
}
USE_CASE_POINTS = {
    "analytics": {"snowflake": 35, "metabase": 30, "duckdb": 20},
    "engineering": {"airflow": 35, "databricks": 25},
    "ml": {"databricks": 40},
    "realtime": {"kafka": 45},
}
FEATURE_POINTS = {
    "opensource": {"duckdb": 15, "airflow": 15, "kafka": 15, "metabase": 15},
    "cloud": {"snowflake": 15, "databricks": 15},
    "sql": {"snowflake": 20, "duckdb": 20},
    "python": {"airflow": 15, "databricks": 15},
    "governance": {},
    "lowcode": {"metabase": 25},
}
BUDGET_POINTS = {
    "low": {"duckdb": 30, "metabase": 20},
    "high": {"databricks": 20, "snowflake": 25},
}


def session_answers(events: DataFrame) -> DataFrame:
    """Last answer of every session to each of the four questions.

    Team size and budget are the last slider values of questions 1 and 4, the use case
    the last option of question 2.  Features are the selection sent with the completed
    third step; without one, the known features whose last event under question 3 selected them: each
    feature is a last-writer-wins register over selections and deselections.
    Missing answers take the form's defaults.  Only fixed-size state per session.
    """
    position = F.struct("event_timestamp", "event_id")
    kind = F.col("event_type")

    def last_where(value: str, condition: Column) -> Column:
        hit = condition & F.col(value).isNotNull()
        return F.max_by(F.when(hit, F.col(value)), F.when(hit, position))

    def slider(question: int) -> Column:
        return last_where(
            "slider_value", (kind == "slider_adjusted") & (F.col("question_id") == question)
        )

    toggled = kind.isin("option_selected", "option_deselected") & (F.col("question_id") == 3)

    def register(feature: str) -> Column:
        hit = toggled & (F.col("option_id") == feature)
        on = F.max_by(F.when(hit, kind == "option_selected"), F.when(hit, position))
        return F.when(on, F.lit(feature)).alias(f"__{feature}")

    seen = [register(f) for f in FEATURES]
    sent = last_where(
        "selected_options", (kind == "quiz_step_completed") & (F.col("step_number") == 3)
    )
    return (
        events.groupBy("session_id")
        .agg(
            slider(1).alias("__team"),
            last_where(
                "option_id", (kind == "option_selected") & (F.col("question_id") == 2)
            ).alias("__use_case"),
            sent.alias("__sent"),
            slider(4).alias("__budget"),
            *seen,
        )
        .select(
            "session_id",
            F.coalesce("__team", F.lit(float(DEFAULT_TEAM_SIZE))).alias("team_size"),
            F.coalesce("__use_case", F.lit("")).alias("use_case"),
            F.coalesce(
                "__sent", F.array_compact(F.array(*[F.col(f"__{f}") for f in FEATURES]))
            ).alias("features"),
            F.coalesce("__budget", F.lit(float(DEFAULT_BUDGET))).alias("budget"),
        )
    )


def _points(tool: str, band: Column, table: dict[str, dict[str, int]]) -> Column | None:
    """Points of ``tool`` for the band it falls in, from the fixed table."""
    earned = [(name, points[tool]) for name, points in table.items() if tool in points]
    if not earned:
        return None
    return reduce(
        lambda chain, item: chain.when(band == item[0], F.lit(item[1])),
        earned[1:],
        F.when(band == earned[0][0], F.lit(earned[0][1])),
    ).otherwise(F.lit(0))


def recommendation_scores(answers: DataFrame) -> DataFrame:
    """Score all tools for each session's answers and pick the best.

    Zero counts as "not answered" for team size and budget, so a budget of 0 scores
    like the default.  A feature listed twice counts twice.
    """
    given = lambda column, default: F.coalesce(
        F.nullif(F.col(column).cast("double"), F.lit(0.0)), F.lit(float(default))
    )
    team, budget = given("team_size", DEFAULT_TEAM_SIZE), given("budget", DEFAULT_BUDGET)
    banded = answers.select(
        "*",
        F.when(team <= SMALL_TEAM, F.lit("small"))
        .when(team <= MEDIUM_TEAM, F.lit("medium"))
        .otherwise(F.lit("large"))
        .alias("__team_band"),
        F.when(budget <= LOW_BUDGET, F.lit("low"))
        .when(budget >= HIGH_BUDGET, F.lit("high"))
        .otherwise(F.lit("none"))
        .alias("__budget_band"),
        F.coalesce("features", F.array().cast("array<string>")).alias("__features"),
    )
    times_listed = lambda name: F.size(F.filter("__features", lambda f: f == name))

    def score(tool: str) -> Column:
        parts = [
            _points(tool, F.col("__team_band"), TEAM_POINTS),
            _points(tool, F.col("use_case"), USE_CASE_POINTS),
            _points(tool, F.col("__budget_band"), BUDGET_POINTS),
        ]
        parts += [
            times_listed(name) * F.lit(points[tool])
            for name, points in FEATURE_POINTS.items()
            if tool in points
        ]
        parts = [F.coalesce(p, F.lit(0)) for p in parts if p is not None]
        return reduce(lambda a, b: a + b, parts, F.lit(BASE_SCORE))

    scored = banded.withColumns({f"score_{tool}": score(tool) for tool in TOOLS}).withColumn(
        "best_score", F.greatest(*[f"score_{tool}" for tool in TOOLS])
    )
    winner = F.coalesce(
        *[F.when(F.col(f"score_{tool}") == F.col("best_score"), F.lit(tool)) for tool in TOOLS]
    )
    rounded = F.floor(F.col("best_score") / F.lit(float(MAX_SCORE)) * 100 + 0.5)
    return scored.select(
        *answers.columns,
        *[f"score_{tool}" for tool in TOOLS],
        winner.alias("recommendation_id"),
        F.least(F.lit(MAX_PERCENT).cast("long"), rounded).alias("match_score"),
    )
