"""Materialise the marts in dependency order.

    raw -> stg_events (view) -> fact_events -> activity -> dim_users
                                                        -> engagement_metrics
                                                        -> funnel_analysis

The activity rollup is written once and read by the three marts below it, so the fact
table is scanned a single time for all of them, and a lost executor costs a re-read of
the rollup instead of a recomputation from raw events.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlift.operators import serving
from eventlift.operators.activity import activity_rollup
from eventlift.operators.engagement import engagement_metrics, engagement_window
from eventlift.operators.facts import fact_events, staged_rows, stg_events
from eventlift.operators.funnel import funnel_analysis, funnel_long
from eventlift.operators.quality import dedup_events
from eventlift.operators.retention import retention_comparison, retention_within
from eventlift.operators.sessions import quality_sessions
from eventlift.operators.users import dim_users
from eventlift.plans.gate import Gate
from eventlift.plans.publish import Publication, published

TABLES = ["fact_events", "activity", "dim_users", "engagement_metrics", "funnel_analysis"]


@dataclass(frozen=True)
class Variables:
    """Job settings of a mart run."""

    include_bot_traffic: bool = False
    dedup: bool = False
    min_events_per_session: int = 1
    max_session_duration_hours: float = 24
    retention_window_days: int = 7
    engagement_window_days: int = 30
    #: shuffle the fact table into even files per day; for lakes of many small files
    gather_facts: bool = False


def stage(raw: DataFrame, variables: Variables = Variables()) -> DataFrame:
    """Raw rows to the staging view, redeliveries removed when asked.

    The earliest copy is chosen among the rows that staging keeps, so rows it drops are never shuffled.
    """
    if not variables.dedup:
        return stg_events(raw, variables.include_bot_traffic)
    once = dedup_events(staged_rows(raw, variables.include_bot_traffic))
    return stg_events(once, include_bot_traffic=True)


def build_marts(
    spark: SparkSession,
    raw: DataFrame,
    output: str,
    *,
    as_of=None,
    variables: Variables = Variables(),
    days: tuple[dt.date, dt.date] | None = None,
    gate: Gate | None = None,
) -> dict[str, DataFrame]:
    """Write all marts under ``output``, publish them together and return them as read back.

    ``days`` (first, last) refreshes only those days of the fact table and the rollup,
    pruning the raw scan to their partitions; the small marts are then rebuilt from the
    whole rollup.  New versions are written beside the published ones, so a run that fails, or whose
    fact rows break the ``gate``, leaves what readers see as it was.  The gate's metrics are taken while the
    fact table is written.
    """
    run = Publication(spark, output)
    if days is not None:
        raw = raw.where(F.col("event_date").between(*days))

    staged = stage(raw, variables)
    staged.createOrReplaceTempView("stg_events")
    # rows that were shuffled would leave a file of every task in every day
    gather = variables.gather_facts or variables.dedup
    facts, seen = gate.watch(fact_events(staged)) if gate else (fact_events(staged), None)
    fact = run.write("fact_events", facts, by_day=True, days=days, gather=gather)
    if gate:
        gate.decide(seen)

    source = fact.where(F.col("event_date").between(*days)) if days else fact
    activity = run.write("activity", activity_rollup(source), by_day=True, days=days, gather=True)

    run.write("dim_users", dim_users(activity, as_of))
    run.write("engagement_metrics", engagement_metrics(activity, as_of))
    run.write("funnel_analysis", funnel_analysis(activity, as_of))
    run.publish()
    return load_marts(spark, output)


def load_marts(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """The published marts."""
    found = published(spark, output)
    return {name: found[name] for name in TABLES}


#: Tables behind the dashboard and the retention report, made from published marts.
REPORTS = [
    "retention_comparison",
    "retention_within",
    "kpi_cards",
    "funnel_steps",
    "event_breakdown",
    "device_distribution",
    "hourly_pattern",
    "recent_engagement",
    "quality_sessions",
]


def build_reports(
    spark: SparkSession, output: str, *, as_of=None, variables: Variables = Variables()
) -> dict[str, DataFrame]:
    """Write the report and serving tables from the published marts and publish them together."""
    run = Publication(spark, output)
    marts = {name: run.read(name) for name in TABLES}
    retention = retention_report(marts, variables)
    recent = windowed_marts(marts, as_of, variables)
    frames = {
        "retention_comparison": retention["comparison"],
        "retention_within": retention["within_window"],
        "kpi_cards": serving.kpi_cards(marts["engagement_metrics"]),
        "funnel_steps": funnel_long(marts["activity"]),
        "event_breakdown": serving.event_breakdown(marts["fact_events"]),
        "device_distribution": serving.device_distribution(marts["fact_events"]),
        "hourly_pattern": serving.hourly_pattern(marts["fact_events"]),
        "recent_engagement": recent["engagement_metrics"],
        "quality_sessions": recent["sessions"],
    }
    for name in REPORTS:
        run.write(name, frames[name])
    run.publish()
    found = published(spark, output)
    return {name: found[name] for name in REPORTS}


def retention_report(
    marts: dict[str, DataFrame], variables: Variables = Variables()
) -> dict[str, DataFrame]:
    """Completer comparison and windowed return rates from written marts."""
    return {
        "comparison": retention_comparison(marts["dim_users"]),
        "within_window": retention_within(marts["activity"], variables.retention_window_days),
    }


def windowed_marts(
    marts: dict[str, DataFrame], as_of, variables: Variables = Variables()
) -> dict[str, DataFrame]:
    """The trailing engagement window and its sessions of acceptable quality."""
    recent = engagement_window(marts["activity"], as_of, variables.engagement_window_days)
    return {
        "engagement_metrics": engagement_metrics(recent, as_of),
        "sessions": quality_sessions(
            recent, variables.min_events_per_session, variables.max_session_duration_hours
        ),
    }
