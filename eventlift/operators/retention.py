"""Do users who complete the quiz come back more often?"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlift.functions import count_if, percent, ratio
from eventlift.operators.activity import measure

COMPLETERS = "completers"
NON_COMPLETERS = "non_completers"


def retention_flags(users: DataFrame) -> DataFrame:
    """Completer and return flags of every user of the dimension."""
    flag = lambda condition: F.when(condition, F.lit(1)).otherwise(F.lit(0))
    return users.select(
        "user_id",
        "user_segment",
        (F.col("quizzes_completed") > 0).alias("is_completer"),
        "total_sessions",
        "active_days",
        "days_since_last_seen",
        flag(F.col("total_sessions") > 1).alias("returned"),
        flag(F.col("active_days") > 1).alias("returned_different_day"),
    )


def _group_totals(users: DataFrame) -> DataFrame:
    """One row with the totals of both groups, each prefixed by its group name."""
    flags = retention_flags(users)
    completer = F.col("is_completer")
    sums = []
    for group, member in ((COMPLETERS, completer), (NON_COMPLETERS, ~completer)):
        sums.append(F.coalesce(count_if(member), F.lit(0)).alias(f"{group}_users"))
        for column in ("total_sessions", "active_days", "returned", "returned_different_day"):
            sums.append(F.sum(F.when(member, F.col(column))).alias(f"{group}_{column}"))
    return flags.agg(*sums)


def retention_comparison(users: DataFrame) -> DataFrame:
    """Both groups side by side; a group without users still has its row."""

    def group_row(group: str):
        of = lambda column: F.col(f"{group}_{column}")
        n = of("users")
        return F.struct(
            F.lit(group).alias("user_group"),
            n.alias("user_count"),
            ratio(of("total_sessions"), n).alias("avg_sessions"),
            ratio(of("active_days"), n).alias("avg_active_days"),
            percent(of("returned"), n).alias("return_rate_pct"),
            percent(of("returned_different_day"), n).alias("next_day_return_rate_pct"),
        )

    rows = F.array(group_row(COMPLETERS), group_row(NON_COMPLETERS))
    return _group_totals(users).select(F.explode(rows).alias("g")).select("g.*")


def retention_lift(users: DataFrame) -> DataFrame:
    """Return rates of both groups and the completers' relative lift, one row."""
    rate = lambda group, column: percent(F.col(f"{group}_{column}"), F.col(f"{group}_users"))
    lift = lambda a, b: ratio(F.col(a) - F.col(b), F.col(b)) * 100
    return (
        _group_totals(users)
        .select(
            rate(COMPLETERS, "returned").alias("completer_return_rate_pct"),
            rate(NON_COMPLETERS, "returned").alias("non_completer_return_rate_pct"),
            rate(COMPLETERS, "returned_different_day").alias("completer_next_day_rate_pct"),
            rate(NON_COMPLETERS, "returned_different_day").alias("non_completer_next_day_rate_pct"),
        )
        .withColumn(
            "retention_lift_pct", lift("completer_return_rate_pct", "non_completer_return_rate_pct")
        )
        .withColumn(
            "next_day_lift_pct",
            lift("completer_next_day_rate_pct", "non_completer_next_day_rate_pct"),
        )
    )


def retention_within(source: DataFrame, window_days: int = 7) -> DataFrame:
    """Share of users active again within ``window_days`` of their first day, per group.

    The window function runs on one row per user and active day, so its largest group
    is the number of days in the data.
    """
    days = (
        source.where(F.col("event_date").isNotNull())
        .groupBy("user_id", "event_date")
        .agg(measure(source, "quizzes_completed").alias("completed"))
    )
    next_day = F.lead("event_date").over(Window.partitionBy("user_id").orderBy("event_date"))
    per_user = (
        days.withColumn("next_date", next_day)
        .groupBy("user_id")
        .agg(
            F.min("event_date").alias("first_date"),
            F.min("next_date").alias("second_date"),
            F.sum("completed").alias("completed"),
        )
    )
    back = F.datediff("second_date", "first_date") <= window_days
    return (
        per_user.groupBy(
            F.when(F.col("completed") > 0, F.lit(COMPLETERS))
            .otherwise(F.lit(NON_COMPLETERS))
            .alias("user_group")
        )
        .agg(F.count(F.lit(1)).alias("user_count"), count_if(back).alias("returned_users"))
        .withColumn("return_rate_pct", percent(F.col("returned_users"), F.col("user_count")))
    )
