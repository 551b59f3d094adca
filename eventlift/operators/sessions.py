"""Sessions from gaps, step timing, device classes and the session quality filter.

Gap sessions and step timing are order-dependent per user or session.  A window over
all rows of a user would put the busiest user into one task, so both work on time
slots: rows are summed up per (key, slot) with partial aggregation, the ordered scan
runs over slots only, and its result is joined back on (key, slot), where adaptive
execution can split a skewed slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlift.operators.activity import is_rollup, measure

SESSION_GAP_SECONDS = 30 * 60


def _slot(ts: str, seconds: float) -> Column:
    """Start of the row's time slot in microseconds."""
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, F.lit(int(seconds * 1_000_000)))


def _slot_sessions(events: DataFrame, user: str, ts: str, gap_seconds: float) -> DataFrame:
    """One row per user and slot with the session that slot belongs to.

    Slots are as long as the gap, so two events of one slot are always closer than the
    gap: no session starts inside a slot, only at its first event.
    """
    slots = (
        events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
        .groupBy(user, _slot(ts, gap_seconds).alias("__slot"))
        .agg(
            F.min(ts).alias("__first"),
            F.max(ts).alias("__last"),
            F.count(F.lit(1)).alias("__events"),
        )
    )
    by_slot = Window.partitionBy(user).orderBy("__slot")
    idle = F.unix_micros("__first") - F.unix_micros(F.lag("__last").over(by_slot))
    opens = idle.isNull() | (idle >= int(gap_seconds * 1_000_000))
    so_far = by_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        slots.withColumn("__opens", opens)
        .withColumn("session_seq", F.sum(F.col("__opens").cast("int")).over(so_far))
        .withColumn(
            "session_start",
            F.last(F.when(F.col("__opens"), F.col("__first")), ignorenulls=True).over(so_far),
        )
    )


def sessionize(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: float = SESSION_GAP_SECONDS,
) -> DataFrame:
    """Add ``session_seq`` (1, 2, ... per user) and ``session_start``.

    An event belongs to the running session while less than ``gap_seconds`` have passed
    since the user's previous event.  Rows without user or time keep NULLs.
    """
    sessions = _slot_sessions(events, user, ts, gap_seconds).select(
        user, "__slot", "session_seq", "session_start"
    )
    return (
        events.withColumn("__slot", _slot(ts, gap_seconds))
        .join(sessions, [user, "__slot"], "left")
        .select(*events.columns, "session_seq", "session_start")
    )


def gap_sessions(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: float = SESSION_GAP_SECONDS,
) -> DataFrame:
    """One row per gap session: start, end and number of events."""
    return (
        _slot_sessions(events, user, ts, gap_seconds)
        .groupBy(user, "session_seq")
        .agg(
            F.min("__first").alias("session_start"),
            F.max("__last").alias("session_end"),
            F.sum("__events").alias("event_count"),
        )
    )


def session_window_counts(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "event_timestamp",
    gap_seconds: float = SESSION_GAP_SECONDS,
) -> DataFrame:
    """Gap sessions through Spark's ``session_window``.

    Spark merges sessions that touch, the rule here is strictly less than the gap, so
    the window is one microsecond shorter.  A static frame is summed per user and slot
    first, each slot spanning from its first event to the gap after its last; on a
    stream the window works on the events themselves, whose sessions Spark keeps as
    merged state.
    """
    micros = int(gap_seconds * 1_000_000)
    if events.isStreaming:
        window = F.session_window(ts, f"{micros - 1} microseconds")
        return (
            events.groupBy(user, window.alias("w"))
            .agg(
                F.min(ts).alias("session_start"),
                F.max(ts).alias("session_end"),
                F.count(F.lit(1)).alias("event_count"),
            )
            .drop("w")
        )
    slots = (
        events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
        .groupBy(user, _slot(ts, gap_seconds).alias("__slot"))
        .agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"), F.count(F.lit(1)).alias("__n"))
    )
    span = F.concat(
        (F.unix_micros("__last") - F.unix_micros("__first") + F.lit(micros - 1)).cast("string"),
        F.lit(" microseconds"),
    )
    return (
        slots.groupBy(user, F.session_window("__first", span).alias("w"))
        .agg(
            F.min("__first").alias("session_start"),
            F.max("__last").alias("session_end"),
            F.sum("__n").alias("event_count"),
        )
        .drop("w")
    )


# Events that restart the step clock, and those that restart the flow clock.
STEP_ANCHORS = ["session_start", "quiz_started", "question_viewed", "quiz_step_completed"]
FLOW_ANCHORS = ["session_start", "quiz_started"]
STEP_TIMED = ["question_viewed", "quiz_step_completed"]
FLOW_TIMED = ["quiz_completed", "session_end"]


def derive_step_timing(
    events: DataFrame,
    session: str = "session_id",
    ts: str = "event_timestamp",
    tie: str = "event_id",
    range_bits: int = 20,
) -> DataFrame:
    """Add ``derived_time_on_step_ms`` and ``derived_total_time_ms`` to every event.

    A step event gets the time since the latest step anchor before it in its session, a
    flow event the time since the latest flow anchor; others, and rows without session or
    time, get NULL.  Events are in the order of time and ``tie``.

    A segmented prefix scan: the instants of a session (microseconds that hold an anchor or a timed
    event, however many events) are cut into ranges of ``2 ** range_bits`` microseconds.  Within a range a
    window finds the latest earlier anchor; one row a range and session is scanned for the
    anchor carried into each range.  So a window holds ``2 ** range_bits`` narrow rows at most, or the ranges of
    one session, and a session with a large share of all events is spread over tasks by its time: events
    meet the result in a join on session and instant.
    """
    kind = F.col("event_type")
    timed = kind.isin(sorted({*STEP_TIMED, *FLOW_TIMED}))
    located = F.col(session).isNotNull() & F.col(ts).isNotNull()
    tie_of = lambda types: F.min(F.when(kind.isin(types), F.col(tie)))
    instants = (
        events.where(located & (timed | kind.isin(STEP_ANCHORS)))
        .groupBy(F.col(session).alias("__session"), F.unix_micros(ts).alias("__at"))
        .agg(tie_of(STEP_ANCHORS).alias("__step_tie"), tie_of(FLOW_ANCHORS).alias("__flow_tie"))
        .withColumn("__range", F.shiftright("__at", range_bits))
    )
    latest = lambda tie_column: F.max(F.when(F.col(tie_column).isNotNull(), F.col("__at")))
    within = Window.partitionBy("__session", "__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    scanned = instants.withColumns(
        {"__step_from": latest("__step_tie").over(within), "__flow_from": latest("__flow_tie").over(within)}
    )
    before = Window.partitionBy("__session").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        instants.groupBy("__session", "__range")
        .agg(latest("__step_tie").alias("__s"), latest("__flow_tie").alias("__f"))
        .select(
            "__session",
            "__range",
            F.max("__s").over(before).alias("__step_carried"),
            F.max("__f").over(before).alias("__flow_carried"),
        )
    )
    anchors = scanned.join(carried, ["__session", "__range"]).select(
        "__session",
        "__at",
        "__step_tie",
        "__flow_tie",
        F.coalesce("__step_from", "__step_carried").alias("__step_from"),
        F.coalesce("__flow_from", "__flow_carried").alias("__flow_from"),
    )

    def elapsed(types, anchor: str) -> Column:
        # an anchor of the same instant counts where it comes first
        since = F.when(F.col(f"__{anchor}_tie") < F.col(tie), F.col("__at")).otherwise(F.col(f"__{anchor}_from"))
        millis = F.floor((F.unix_micros(ts) - since) / F.lit(1000))
        return F.when(kind.isin(types), millis)

    met = (F.col(session) == F.col("__session")) & (F.unix_micros(ts) == F.col("__at"))
    return events.join(anchors, met, "left").select(
        *events.columns,
        elapsed(STEP_TIMED, "step").alias("derived_time_on_step_ms"),
        elapsed(FLOW_TIMED, "flow").alias("derived_total_time_ms"),
    )


# User-agent patterns, tested on lower-case text, tablet first.
TABLET_PATTERN = "(tablet|ipad|playbook|silk)|(android(?!.*mobi))"
MOBILE_PATTERN = "mobile|android|iphone|ipod|blackberry|opera mini|iemobile"


def device_from_user_agent(user_agent: Column) -> Column:
    agent = F.lower(user_agent)
    return (
        F.when(agent.isNull(), F.lit("unknown"))
        .when(agent.rlike(TABLET_PATTERN), F.lit("tablet"))
        .when(agent.rlike(MOBILE_PATTERN), F.lit("mobile"))
        .otherwise(F.lit("desktop"))
    )


def quality_sessions(
    source: DataFrame, min_events: int = 1, max_duration_hours: float = 24
) -> DataFrame:
    """Sessions with enough events and a plausible duration."""
    first, last = (
        (F.min("first_event_at"), F.max("last_event_at"))
        if is_rollup(source)
        else (F.min("event_timestamp"), F.max("event_timestamp"))
    )
    return (
        source.groupBy("session_id", "user_id")
        .agg(
            measure(source, "events").alias("event_count"),
            first.alias("session_start"),
            last.alias("session_end"),
        )
        .withColumn(
            "duration_seconds",
            (F.unix_micros("session_end") - F.unix_micros("session_start")) / F.lit(1_000_000.0),
        )
        .where(
            (F.col("event_count") >= min_events)
            & (F.col("duration_seconds") <= max_duration_hours * 3600)
        )
    )
