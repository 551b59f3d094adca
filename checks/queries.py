"""Every operator as a query over the driver's ``events`` table.

``queries()`` maps a key to ``f(spark, sf_dir) -> DataFrame``.  Results are flattened to
types both engines print alike: times, dates and arrays as text, doubles to 6 places.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlift import schema
from eventlift.operators import (
    activity,
    engagement,
    facts,
    funnel,
    health,
    ingest,
    quality,
    retention,
    scoring,
    serving,
    sessions,
    users,
)
from eventlift.plans import gate as gates
from eventlift.plans import marts
from eventlift.sources import (
    decode_envelope,
    encode_envelope,
    raw_events_from_table,
    read_event_files,
    read_raw_lake,
    stream_messages,
)
from eventlift.streaming import aggregates, fanout, job, sinks

AS_OF = "2024-02-01 00:00:00"

# Agents for the device classifier, chosen by event id.
AGENTS = [
    "Mozilla/5.0 (Linux; Android 10; Pixel 4) Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 13; SM-X700) Safari/537.36",
    "Mozilla/5.0 (iPad; CPU OS 17_0 like Mac OS X)",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0) Mobile/15E148",
    "Mozilla/5.0 (Linux; U) Silk/3.1 Kindle",
    "Opera/9.80 (J2ME/MIDP; Opera Mini/7.1)",
    "Mozilla/5.0 (BlackBerry; U)",
    "Mozilla/5.0 (X11; Linux x86_64) Firefox/120.0",
    "Mobile gateway for Android tab",
]


def flat(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        text = f"`{field.name}`"
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = f"date_format({text}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        elif isinstance(field.dataType, T.DateType):
            text = f"CAST({text} AS STRING)"
        elif isinstance(field.dataType, T.DoubleType):
            text = f"round({text} * 1000000D, 0) / 1000000D"
        elif isinstance(field.dataType, T.ArrayType):
            text = f"array_join({text}, ',')"
        columns.append(f"{text} AS `{field.name}`")
    return df.selectExpr(*columns)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return raw_events_from_table(spark.read.parquet(f"{sf_dir}/events.parquet"))


def stg(spark, sf_dir):
    return facts.stg_events(raw(spark, sf_dir))


def fact(spark, sf_dir):
    return facts.fact_events(stg(spark, sf_dir))


def dims(spark, sf_dir):
    return users.dim_users(fact(spark, sf_dir), AS_OF)


def kpis(spark, sf_dir):
    return engagement.engagement_metrics(fact(spark, sf_dir), AS_OF).drop("calculated_at")


def dirty(spark, sf_dir):
    """Raw events with broken fields, in request batches; batch 0 is over the limit."""
    return (
        raw(spark, sf_dir)
        .withColumns(
            {
                "user_id": F.expr(
                    "CASE WHEN id % 90 = 7 THEN '   ' WHEN id % 30 = 2 THEN concat('  ', user_id, ' ')"
                    " ELSE user_id END"
                ),
                "session_id": F.expr("IF(id % 120 = 10, NULL, session_id)"),
                "timestamp": F.expr("IF(id % 110 = 9, 'not a time', timestamp)"),
                "event_properties": F.col("event_properties")
                .withField(
                    "slider_value",
                    F.expr("event_properties.slider_value + IF(id % 6 = 1, 200, 0)"),
                )
                .withField("step_number", F.expr("IF(id % 80 = 5, 0, event_properties.step_number)")),
                "context": F.col("context")
                .withField("device_type", F.expr("IF(id % 60 = 11, 'phone', context.device_type)"))
                .withField("screen_width", F.expr("IF(id % 70 = 3, -1, context.screen_width)")),
                "batch_id": F.expr("IF(id < 1500, 0, id div 400)"),
            }
        )
        .withColumn("header_user_agent", F.expr("concat('hdr/', batch_id)"))
    )


def validated(spark, sf_dir):
    return ingest.validate_events(dirty(spark, sf_dir), uuid_ids=False)


def requests(spark, sf_dir):
    """The broken events as request rows with their lists, and two requests without events."""
    events = F.collect_list(F.struct(*schema.EVENT.names)).alias("events")
    full = dirty(spark, sf_dir).groupBy("batch_id", "header_user_agent").agg(events)
    kind = full.schema["events"].dataType.simpleString()
    empty = spark.range(1).select(
        F.inline(
            F.expr(
                f"array(named_struct('batch_id', -1, 'header_user_agent', 'hdr/x', 'events', CAST(array() AS {kind})),"
                f" named_struct('batch_id', -2, 'header_user_agent', 'hdr/x', 'events', CAST(NULL AS {kind})))"
            )
        )
    )
    return full.unionByName(empty)


# -- ingest ---------------------------------------------------------------


def ingest_reconcile(spark, sf_dir):
    """Totals by way of the exploded requests: what the receipts refuse is not accepted here either."""
    rows = ingest.validate_events(ingest.explode_batches(requests(spark, sf_dir)), uuid_ids=False)
    return ingest.ingest_totals(rows)


def future_events(spark, sf_dir):
    """Some clocks set years ahead."""
    ahead = F.expr("IF(id % 150 = 4, event_timestamp + INTERVAL 2200 DAYS, event_timestamp)")
    wild = raw(spark, sf_dir).withColumn("event_timestamp", ahead)
    return quality.future_events(wild).select("event_id", "event_timestamp", "kafka_timestamp")


def scan_raw(spark, sf_dir):
    return raw(spark, sf_dir).groupBy("event_date", "event_hour").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_timestamp").alias("first_event_at"),
        F.max("processed_at").alias("last_processed_at"),
    )


def _body(name: str):
    return F.get_json_object(F.col("value").cast("string"), f"$.{name}")


def envelope_encode(spark, sf_dir):
    return encode_envelope(raw(spark, sf_dir)).select(
        "key",
        _body("event_id").alias("event_id"),
        _body("event_type").alias("event_type"),
        _body("context.device_type").alias("device_type"),
        _body("received_at").alias("received_at"),
        F.col("timestamp").alias("sent_at"),
    )


def envelope_decode(spark, sf_dir):
    decoded = decode_envelope(encode_envelope(raw(spark, sf_dir)))
    field = lambda name: F.get_json_object("json_value", f"$.{name}")
    return decoded.select(
        field("event_id").alias("event_id"),
        field("session_id").alias("session_id"),
        field("timestamp").alias("event_time_text"),
        "kafka_timestamp",
    )


def parse_events(spark, sf_dir):
    """Round trip with some bodies that are no JSON."""
    messages = encode_envelope(raw(spark, sf_dir))
    broken = F.unix_micros("timestamp") % 211 == 5
    messages = messages.withColumn(
        "value", F.when(broken, F.lit("oops{").cast("binary")).otherwise(F.col("value"))
    )
    return ingest.parse_events(messages, F.lit(AS_OF).cast("timestamp")).select(
        "event_id",
        "user_id",
        "session_id",
        "event_type",
        "event_properties.step_number",
        "event_properties.slider_value",
        "event_properties.option_id",
        "context.device_type",
        "context.user_agent",
        "kafka_timestamp",
        "event_timestamp",
        "processed_at",
        "event_date",
        "event_hour",
    )


def enrich_user_agent(spark, sf_dir):
    return ingest.enrich_user_agent(dirty(spark, sf_dir)).select(
        "event_id", "batch_id", "context.user_agent"
    )


def apply_defaults(spark, sf_dir):
    source = raw(spark, sf_dir).withColumns(
        {
            "event_id": F.expr("IF(id % 17 = 0, NULL, event_id)"),
            "feature_name": F.expr("IF(id % 13 = 0, NULL, feature_name)"),
            "timestamp": F.expr("IF(id % 19 = 0, NULL, timestamp)"),
            "event_properties": F.expr("IF(id % 29 = 0, NULL, event_properties)"),
            "context": F.expr(
                "CASE WHEN id % 23 = 0 THEN NULL ELSE context END"
            ),
        }
    )
    return ingest.apply_defaults(source, F.lit(AS_OF).cast("timestamp")).select(
        "id",
        (F.length("event_id") == 36).alias("generated_id"),
        "feature_name",
        "timestamp",
        "context.device_type",
        "event_properties.step_number",
        F.size("event_properties.extra").alias("extra_size"),
    )


def validate_events(spark, sf_dir):
    return validated(spark, sf_dir).select("event_id", "user_id", "reject_reasons")


def rejected_events(spark, sf_dir):
    return ingest.rejected_events(validated(spark, sf_dir)).select(
        "event_id", "event_type", "processed_at", "reject_reasons"
    )


def dedup_events(spark, sf_dir):
    return quality.dedup_events(raw(spark, sf_dir)).select(
        "event_id", "user_id", "event_type", "event_timestamp", "processed_at"
    )


def stg_deduped(spark, sf_dir):
    """Staging as the mart job runs it: filters, then de-duplication, then the flat columns."""
    return marts.stage(raw(spark, sf_dir), marts.Variables(dedup=True)).select(
        "event_id", "user_id", "session_id", "event_type", "event_timestamp", "processed_at", "device_type"
    )


def filter_bots(spark, sf_dir):
    return quality.filter_bots(raw(spark, sf_dir)).select(
        "event_id", "event_type", "context.user_agent"
    )


def dq_checks(spark, sf_dir):
    return quality.dq_checks(raw(spark, sf_dir).select("*", "context.device_type"))


# -- sessions -------------------------------------------------------------


def device_from_user_agent(spark, sf_dir):
    agents = F.array(*[F.lit(a) for a in AGENTS])
    source = raw(spark, sf_dir).select(
        F.try_element_at(agents, (F.col("id") % 10 + 1).cast("int")).alias("user_agent")
    )
    return (
        source.select("user_agent", sessions.device_from_user_agent(F.col("user_agent")).alias("device_type"))
        .groupBy("user_agent", "device_type")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def sessionize(spark, sf_dir):
    return sessions.sessionize(stg(spark, sf_dir)).select(
        "event_id", "user_id", "event_timestamp", "session_seq", "session_start"
    )


def gap_sessions(spark, sf_dir):
    return sessions.gap_sessions(stg(spark, sf_dir), gap_seconds=6 * 3600)


def session_window_counts(spark, sf_dir):
    return sessions.session_window_counts(stg(spark, sf_dir))


def derive_step_timing(spark, sf_dir):
    clean = facts.stg_events(quality.dedup_events(raw(spark, sf_dir)))
    return sessions.derive_step_timing(clean).select(
        "event_id", "session_id", "event_type", "derived_time_on_step_ms", "derived_total_time_ms"
    )


def quality_sessions(spark, sf_dir):
    return sessions.quality_sessions(fact(spark, sf_dir), min_events=2, max_duration_hours=6)


# -- facts, users, retention ----------------------------------------------


def dim_users(spark, sf_dir):
    return dims(spark, sf_dir).drop("updated_at")


def session_engagement(spark, sf_dir):
    return engagement.session_engagement(fact(spark, sf_dir)).drop(
        "feature_interactions", "quizzes_started"
    )


def engagement_window(spark, sf_dir):
    recent = engagement.engagement_window(fact(spark, sf_dir), AS_OF, days=14)
    per_user = recent.groupBy("user_id", "event_date").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("active_days"), F.sum("n").alias("events")
    )


def activity_rollup(spark, sf_dir):
    return activity.activity_rollup(fact(spark, sf_dir)).select(
        *activity.ROLLUP_KEYS,
        "events",
        "interaction_events",
        "flow_events",
        "max_step",
        "total_time_ms_sum",
        "match_score_sum",
        F.bit_count("type_bits").alias("declared_types"),
    )


# -- streaming metrics in their batch form --------------------------------


def session_metrics(spark, sf_dir):
    df = aggregates.session_metrics(raw(spark, sf_dir))
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in df.columns if c != "window"],
    )


def device_distribution(spark, sf_dir):
    return serving.device_distribution(fact(spark, sf_dir))


# -- what is written, read back -------------------------------------------


def scratch(spark: SparkSession) -> str:
    """A new folder: in the cluster's shared one, or a temporary one where there is none."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="eventlift-checks-")
    return f"{shared.rstrip('/')}/checks-{uuid.uuid4().hex}"


def lake_roundtrip(spark, sf_dir):
    """Through the partitioned raw lake and its compaction."""
    out = scratch(spark)
    sinks.write_raw(raw(spark, sf_dir).drop("id"), f"{out}/raw")
    sinks.compact_raw(spark, f"{out}/raw", f"{out}/compact")
    return read_raw_lake(spark, f"{out}/compact").select(
        "event_id", "user_id", "event_type", "event_timestamp", "processed_at", "event_date", "event_hour",
        "event_properties.slider_value", "context.device_type",
    )


def ndjson_roundtrip(spark, sf_dir):
    """Through JSON lines, a folder a day."""
    out = scratch(spark)
    sinks.write_json_days(raw(spark, sf_dir).select(*schema.EVENT.names), out)
    return ingest.with_ingest_metadata(read_event_files(spark, out)).select(
        "event_id", "session_id", "event_timestamp", "event_date", "event_hour", "event_properties.question_id"
    )


def stream_roundtrip(spark, sf_dir):
    """Messages to files, the four-output job to its end; the hours of the funnel that the watermark has closed."""
    out = scratch(spark)
    sinks.write_event_messages(raw(spark, sf_dir), f"{out}/messages")
    events = ingest.parse_events(stream_messages(spark, "files", path=f"{out}/messages"))
    job.await_all(spark, job.start_all(events, out, f"{out}/checkpoints", trigger=None, realtime_trigger=None))
    taken_in = read_raw_lake(spark, f"{out}/raw").count()
    return spark.read.parquet(f"{out}/funnel_metrics").withColumn("raw_events", F.lit(taken_in).cast("long"))


def fanout_roundtrip(spark, sf_dir):
    """Messages through the one-read job; real-time metrics from its rollup."""
    out = scratch(spark)
    sinks.write_event_messages(raw(spark, sf_dir), f"{out}/messages")
    events = ingest.parse_events(stream_messages(spark, "files", path=f"{out}/messages"))
    job.await_all(spark, [fanout.start_fanout(events, out, f"{out}/checkpoint", trigger=None, uuid_ids=False)])
    return fanout.metrics_from_minutes(fanout.read_output(spark, out, "minutes"))


def marts_roundtrip(spark, sf_dir):
    """The mart job with its gate, published and read back: the KPI table."""
    gate = gates.Gate(allowed={"event_type:unknown": 0.5})
    built = marts.build_marts(spark, raw(spark, sf_dir), scratch(spark), as_of=AS_OF, gate=gate)
    return built["engagement_metrics"].drop("calculated_at")


_PLAIN: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_raw": scan_raw,
    "lake_roundtrip": lake_roundtrip,
    "ndjson_roundtrip": ndjson_roundtrip,
    "stream_roundtrip": stream_roundtrip,
    "fanout_roundtrip": fanout_roundtrip,
    "marts_roundtrip": marts_roundtrip,
    "envelope_encode": envelope_encode,
    "envelope_decode": envelope_decode,
    "parse_events": parse_events,
    "enrich_user_agent": enrich_user_agent,
    "apply_defaults": apply_defaults,
    "validate_events": validate_events,
    "batch_receipt": lambda s, d: ingest.batch_receipt(validated(s, d)),
    "request_receipts": lambda s, d: ingest.request_receipts(requests(s, d), uuid_ids=False),
    "ingest_reconcile": ingest_reconcile,
    "future_events": future_events,
    "rejected_events": rejected_events,
    "reject_reasons": lambda s, d: ingest.reject_reasons(validated(s, d)),
    "ingest_totals": lambda s, d: ingest.ingest_totals(validated(s, d)),
    "dedup_events": dedup_events,
    "stg_deduped": stg_deduped,
    "filter_bots": filter_bots,
    "dq_checks": dq_checks,
    "stg_events": stg,
    "device_from_user_agent": device_from_user_agent,
    "sessionize": sessionize,
    "gap_sessions": gap_sessions,
    "session_window_counts": session_window_counts,
    "derive_step_timing": derive_step_timing,
    "quality_sessions": quality_sessions,
    "fact_events": fact,
    "event_category_counts": lambda s, d: facts.event_category_counts(fact(s, d)),
    "slider_stats": lambda s, d: facts.slider_stats(fact(s, d)),
    "activity_rollup": activity_rollup,
    "dim_users": dim_users,
    "user_segments": lambda s, d: users.user_segments(dims(s, d)),
    "user_primary_device": lambda s, d: users.user_primary_device(fact(s, d)),
    "daily_active_users": lambda s, d: engagement.daily_active_users(fact(s, d)),
    "feature_adoption": lambda s, d: engagement.feature_adoption(fact(s, d)),
    "daily_funnel_users": lambda s, d: engagement.daily_funnel_users(fact(s, d)),
    "session_engagement": session_engagement,
    "session_summary": lambda s, d: engagement.session_summary(fact(s, d)),
    "engagement_metrics": kpis,
    "engagement_window": engagement_window,
    "retention_flags": lambda s, d: retention.retention_flags(dims(s, d)),
    "retention_comparison": lambda s, d: retention.retention_comparison(dims(s, d)),
    "retention_lift": lambda s, d: retention.retention_lift(dims(s, d)),
    "retention_7d": lambda s, d: retention.retention_within(fact(s, d), 7),
    "funnel_progress": lambda s, d: funnel.funnel_progress(fact(s, d)),
    "funnel_daily": lambda s, d: funnel.funnel_daily(fact(s, d)),
    "funnel_rates": lambda s, d: funnel.funnel_rates(fact(s, d)),
    "funnel_long": lambda s, d: funnel.funnel_long(fact(s, d)),
    "session_metrics": session_metrics,
    "realtime_metrics": lambda s, d: aggregates.realtime_metrics(raw(s, d)),
    "stream_funnel": lambda s, d: aggregates.stream_funnel(raw(s, d)),
    "active_users_5m": lambda s, d: aggregates.active_users(raw(s, d)),
    "events_per_minute": lambda s, d: aggregates.events_per_minute(raw(s, d)),
    "latest_metrics": lambda s, d: serving.latest_metrics(kpis(s, d), 10),
    "kpi_cards": lambda s, d: serving.kpi_cards(kpis(s, d)),
    "engagement_trends": lambda s, d: serving.engagement_trends(kpis(s, d)),
    "metrics_last_n_days": lambda s, d: serving.metrics_last_n_days(kpis(s, d), 7),
    "event_breakdown": lambda s, d: serving.event_breakdown(fact(s, d)),
    "device_distribution": device_distribution,
    "hourly_pattern": lambda s, d: serving.hourly_pattern(fact(s, d)),
    "events_this_hour": lambda s, d: serving.events_this_hour(fact(s, d), "2024-01-15 12:30:00"),
    "ingest_counts": lambda s, d: health.ingest_counts(raw(s, d)),
    "ingest_latency_p95": lambda s, d: health.ingest_latency(raw(s, d)),
    "active_sessions": lambda s, d: health.active_sessions(
        raw(s, d), "2024-01-15 12:00:00", minutes=360
    ),
    "events_over_time": lambda s, d: health.events_over_time(raw(s, d)),
    "session_answers": lambda s, d: scoring.session_answers(stg(s, d)),
    "recommendation_scores": lambda s, d: scoring.recommendation_scores(
        scoring.session_answers(stg(s, d))
    ),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def finished(build):
        return lambda spark, sf_dir: flat(build(spark, sf_dir))

    return {name: finished(build) for name, build in _PLAIN.items()}
