"""Windowed aggregates that run unchanged on static and on streaming frames.

On a static frame the watermark is ignored and the functions are the batch definition
of each metric.  On a stream they emit a window once the watermark has passed its end.

Exact distinct counts are not available as a streaming aggregate, and collecting a set
per window would put all users of a busy window into one state row.  The distinct
metrics therefore aggregate twice: first per (window, group, id), state spread over the
ids, then per (window, group), where Spark adds up partial counts before the shuffle.
The second step groups by the same window column, so both follow one watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlift import schema
from eventlift.functions import count_if

TIME = "event_timestamp"


def _timed(events: DataFrame, watermark: str) -> DataFrame:
    """Set the watermark unless the stream already carries one (after de-duplication)."""
    if "spark.watermarkDelayMs" in events.schema[TIME].metadata:
        return events
    return events.withWatermark(TIME, watermark)


def _bounds(df: DataFrame, *rest) -> DataFrame:
    return df.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest
    )


def session_metrics(events: DataFrame, width: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """Hourly metrics per session, user, feature and device."""
    is_type = lambda name: F.col("event_type") == name
    seconds = F.unix_seconds("session_end") - F.unix_seconds("session_start")
    started = F.col("quizzes_started")
    return (
        _timed(events, watermark)
        .groupBy(
            F.window(TIME, width).alias("window"),
            "session_id",
            "user_id",
            "feature_name",
            F.col("context.device_type").alias("device_type"),
        )
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.min(TIME).alias("session_start"),
            F.max(TIME).alias("session_end"),
            count_if(is_type("quiz_started")).alias("quizzes_started"),
            count_if(is_type("quiz_completed")).alias("quizzes_completed"),
            count_if(is_type("slider_adjusted")).alias("slider_interactions"),
            count_if(is_type("option_selected")).alias("option_selections"),
            F.max("event_properties.total_time_ms").alias("total_time_ms"),
            F.max("event_properties.match_score").alias("final_match_score"),
            F.max("event_properties.recommendation_id").alias("recommendation_id"),
            count_if(is_type("result_shared")).alias("shares"),
        )
        .withColumns(
            {
                "session_duration_seconds": seconds,
                "completion_rate": F.when(started > 0, F.col("quizzes_completed") / started).otherwise(
                    F.lit(0.0)
                ),
            }
        )
    )


def _distinct_per_window(
    events: DataFrame, window: Column, groups: list[str], extra: dict[str, Column] | None = None
) -> DataFrame:
    """Counts of events, users and sessions per window and group, plus summed extras.

    Every event becomes a user row and a session row; extras ride on the user rows.
    """
    extra = extra or {}
    ids = F.array(
        F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("id")),
        F.struct(F.lit("session").alias("kind"), F.col("session_id").alias("id")),
    )
    rows = events.select(
        window.alias("w"), *groups, *[c.alias(n) for n, c in extra.items()], F.explode(ids).alias("k")
    )
    per_id = rows.groupBy("w", *groups, "k.kind", "k.id").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in extra]
    )
    user, session = F.col("kind") == "user", F.col("kind") == "session"
    known = F.col("id").isNotNull()
    return per_id.groupBy("w", *groups).agg(
        F.sum(F.when(user, F.col("n"))).alias("event_count"),
        count_if(user & known).alias("unique_users"),
        count_if(session & known).alias("unique_sessions"),
        *[F.sum(F.when(user, F.col(name))).alias(name) for name in extra],
    )


def realtime_metrics(
    events: DataFrame, width: str = "1 minute", watermark: str = "5 minutes", approx: bool = False
) -> DataFrame:
    """Events, distinct users and sessions, and mean step time per minute and type.

    ``approx=True`` uses sketches in a single aggregation, for windows so wide that
    state per id is too much.
    """
    on_step = F.col("event_properties.time_on_step_ms")
    groups = ["feature_name", "event_type"]
    timed = _timed(events, watermark)
    window = F.window(TIME, width)
    if approx:
        counts = timed.groupBy(window.alias("w"), *groups).agg(
            F.count(F.lit(1)).alias("event_count"),
            F.approx_count_distinct("user_id").alias("unique_users"),
            F.approx_count_distinct("session_id").alias("unique_sessions"),
            F.avg(on_step).alias("avg_time_on_step_ms"),
        )
        return _bounds(
            counts, *groups, "event_count", "unique_users", "unique_sessions", "avg_time_on_step_ms"
        )
    extra = {
        "time_sum": on_step.cast("long"),
        "time_n": F.when(on_step.isNotNull(), F.lit(1)).otherwise(F.lit(0)),
    }
    counts = _distinct_per_window(timed, window, groups, extra)
    mean = F.col("time_sum").cast("double") / F.nullif(F.col("time_n"), F.lit(0))
    return _bounds(
        counts,
        *groups,
        "event_count",
        "unique_users",
        "unique_sessions",
        mean.alias("avg_time_on_step_ms"),
    )


def stream_funnel(
    events: DataFrame, width: str = "1 hour", watermark: str = "1 hour", approx: bool = False
) -> DataFrame:
    """Distinct users and sessions per funnel event type and hour, with the step number."""
    steps = schema.STREAM_FUNNEL_STEPS
    groups = ["feature_name", "event_type"]
    timed = _timed(events.where(F.col("event_type").isin(list(steps))), watermark)
    window = F.window(TIME, width)
    if approx:
        counts = timed.groupBy(window.alias("w"), *groups).agg(
            F.count(F.lit(1)).alias("event_count"),
            F.approx_count_distinct("user_id").alias("unique_users"),
            F.approx_count_distinct("session_id").alias("unique_sessions"),
        )
    else:
        counts = _distinct_per_window(timed, window, groups)
    step = F.lit(0)
    for name, number in steps.items():
        step = F.when(F.col("event_type") == name, F.lit(number)).otherwise(step)
    return counts.select(
        *groups,
        "unique_users",
        "unique_sessions",
        F.col("event_count").alias("total_events"),
        F.col("w.start").alias("window_start"),
        step.alias("funnel_step"),
    )


def active_users(
    events: DataFrame, width: str = "5 minutes", slide: str = "1 minute", watermark: str = "5 minutes"
) -> DataFrame:
    """Distinct users in the trailing ``width``, every ``slide``; windows without users have no row.

    ``width`` must be a whole number of slides.  Raw events are never multiplied: they are first
    reduced to distinct (slide, user).  A static frame is then swept: a user's slide opens
    the windows that end with it and closes them where the user's next slide takes over, which is +1 at one window
    and -1 at another, and a running sum over windows gives the counts.  The sum runs within days, on
    top of the sum of the days before, so no task holds more than a day of windows.  On a stream the
    distinct pairs go through the sliding window, with state per window and user.
    """
    known = _timed(events, watermark).where(F.col("user_id").isNotNull())
    if events.isStreaming:
        pairs = known.groupBy(F.window(TIME, slide).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("n"))
        pairs = pairs.select(F.window_time("s").alias("at"), "user_id")
        per_user = pairs.groupBy(F.window("at", width, slide).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
        return _bounds(per_user.groupBy("w").agg(F.count(F.lit(1)).alias("active_users")), "active_users")

    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    micros = lambda interval: F.unix_micros(epoch + F.expr(f"INTERVAL {interval}")) - F.unix_micros(epoch)
    unit = micros(slide)
    slides = F.when(micros(width) % unit == 0, F.expr("__width DIV __unit")).otherwise(
        F.raise_error(F.lit("width must be a whole number of slides"))
    )
    pairs = known.where(F.col(TIME).isNotNull()).groupBy(F.floor(F.unix_micros(TIME) / unit).alias("at"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    later = F.lead("at").over(Window.partitionBy("user_id").orderBy("at"))
    spans = (
        pairs.select("at", later.alias("later"), unit.alias("__unit"), micros(width).alias("__width"))
        .withColumn("n", slides)
        .select((F.col("at") - F.col("n") + 1).alias("start"), F.least(F.col("at") + 1, F.col("later") - F.col("n") + 1).alias("stop"))
    )
    changes = (
        spans.select(F.inline(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("change")), F.struct(F.col("stop").alias("at"), F.lit(-1).alias("change")))))
        .groupBy("at")
        .agg(F.sum("change").alias("change"))
        .withColumn("part", F.expr("at DIV 1440"))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    carried = changes.groupBy("part").agg(F.sum("change").alias("total"), F.min("at").alias("first")).select(
        "part",
        F.coalesce(F.sum("total").over(before), F.lit(0)).alias("carried"),
        F.lead("first").over(Window.orderBy("part")).alias("next_first"),
    )
    own = Window.partitionBy("part").orderBy("at")
    counts = (
        changes.join(carried, "part")
        .select(
            "at",
            (F.col("carried") + F.sum("change").over(own)).alias("active_users"),
            F.coalesce(F.lead("at").over(own), "next_first").alias("until"),
        )
        .where("active_users > 0")
        .select(F.explode(F.sequence("at", F.col("until") - 1)).alias("at"), "active_users")
    )
    return counts.select(
        F.timestamp_micros(F.col("at") * unit).alias("window_start"),
        F.timestamp_micros(F.col("at") * unit + micros(width)).alias("window_end"),
        "active_users",
    )


def events_per_minute(events: DataFrame, watermark: str = "5 minutes") -> DataFrame:
    """Events per minute over all features and types."""
    counts = (
        _timed(events, watermark)
        .groupBy(F.window(TIME, "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    return _bounds(counts, "event_count")
