"""One parse, many outputs: a stream read once a micro-batch and written to every table of the lake.

The job of ``job.start_all`` is a query an output, each with a read and a parse of its own.  Here one query
validates a micro-batch, keeps it while its outputs are written, and writes them all:

* ``raw``       accepted events, by date and hour of the event;
* ``rejected``  events that break a rule, with the reasons;
* ``future``    accepted events whose clock is ahead of the broker's by more than the tolerance;
* ``minutes``   a rollup per minute, type, user and session, from which the windowed metrics are summed;
* ``receipts``  events taken in, accepted and rejected.

Every output writes batch ``n`` into its folder ``batch=n``, replacing what a failed attempt may have left
there, and after the last output the number is committed by a rename.  Readers see committed batches
only, so a job killed between two outputs shows none of that batch, and all of it once after the
restart.  The metrics hold late events as well, as no state is ever closed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventlift import schema
from eventlift.operators.ingest import accepted_events, ingest_totals, rejected_events, validate_events
from eventlift.operators.quality import FUTURE_TOLERANCE, future_events, present_events
from eventlift.plans.publish import read_json, swap_json
from eventlift.streaming.sinks import DEFAULT_TRIGGER, PARTITIONS, _trigger, spread_by_hour

COMMITTED = "_committed.json"


def minute_rollup(events: DataFrame) -> DataFrame:
    """Events per minute, feature, type, user and session, with the sums their metrics need."""
    on_step = F.col("event_properties.time_on_step_ms")
    return events.where(F.col("event_timestamp").isNotNull()).groupBy(
        F.date_trunc("minute", "event_timestamp").alias("minute"), "feature_name", "event_type", "user_id", "session_id"
    ).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(on_step.cast("long")).alias("time_on_step_sum"),
        F.count(on_step).alias("time_on_step_count"),
    )


def metrics_from_minutes(minutes: DataFrame, width: str = "1 minute") -> DataFrame:
    """Real-time metrics per window of whole minutes, feature and type; exact, late events included.

    Sums per user and session come first, so a busy window is spread over its users.
    """
    keys = ["window_start", "window_end", "feature_name", "event_type"]
    window = F.window("minute", width)
    rows = minutes.select("*", window.start.alias("window_start"), window.end.alias("window_end"))
    total = [F.sum(c).alias(c) for c in ("events", "time_on_step_sum", "time_on_step_count")]
    counts = rows.groupBy(*keys).agg(*total, F.count_distinct("user_id").alias("unique_users"), F.count_distinct("session_id").alias("unique_sessions"))
    mean = F.col("time_on_step_sum").cast("double") / F.nullif(F.col("time_on_step_count"), F.lit(0))
    return counts.select(*keys, F.col("events").alias("event_count"), "unique_users", "unique_sessions", mean.alias("avg_time_on_step_ms"))


def funnel_from_minutes(minutes: DataFrame, width: str = "1 hour") -> DataFrame:
    """Distinct users and sessions per funnel event type and window, with the step number."""
    steps = schema.STREAM_FUNNEL_STEPS
    counts = metrics_from_minutes(minutes.where(F.col("event_type").isin(list(steps))), width)
    number = F.create_map(*[F.lit(x) for pair in steps.items() for x in pair])
    return counts.select(
        "feature_name", "event_type", "unique_users", "unique_sessions",
        F.col("event_count").alias("total_events"), "window_start", number[F.col("event_type")].alias("funnel_step"),
    )


Output = tuple[Callable[[DataFrame], DataFrame], list[str]]


def outputs(files_per_hour: int = 8, tolerance: str = FUTURE_TOLERANCE) -> dict[str, Output]:
    """Output name -> (its rows from a validated micro-batch, partition columns)."""
    good = lambda judged: present_events(accepted_events(judged), tolerance)
    return {
        "raw": (lambda judged: spread_by_hour(good(judged), files_per_hour), PARTITIONS),
        "rejected": (lambda judged: rejected_events(judged), []),
        "future": (lambda judged: future_events(accepted_events(judged), tolerance), []),
        "minutes": (lambda judged: minute_rollup(good(judged)), []),
        "receipts": (lambda judged: ingest_totals(judged), []),
    }


def start_fanout(
    events: DataFrame,
    output: str,
    checkpoint: str,
    *,
    trigger: str | None = DEFAULT_TRIGGER,
    sinks: Mapping[str, Output] | None = None,
    uuid_ids: bool = True,
    name: str = "fanout",
) -> StreamingQuery:
    """Start the one query that writes all ``sinks`` (``outputs()`` unless given) of the parsed ``events``."""
    sinks = outputs() if sinks is None else sinks

    def write(batch: DataFrame, number: int) -> None:
        judged = validate_events(batch, uuid_ids=uuid_ids).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            schemas = {}
            for sink, (rows, partition_by) in sinks.items():
                frame = rows(judged)
                schemas[sink] = frame.schema.jsonValue()
                frame.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{output}/{sink}/batch={number}")
            swap_json(batch.sparkSession, f"{output}/{COMMITTED}", {"batch": number, "schemas": schemas})
        finally:
            judged.unpersist()

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(**_trigger(trigger))
        .start()
    )


def read_output(spark: SparkSession, output: str, sink: str) -> DataFrame:
    """The committed rows of an output; a batch filter prunes folders."""
    committed = read_json(spark, f"{output}/{COMMITTED}")
    if committed is None:
        raise FileNotFoundError(f"{output} holds no committed batch")
    fields = T.StructType.fromJson(committed["schemas"][sink])
    given = T.StructType([*fields.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(given).parquet(f"{output}/{sink}")
    return rows.where(F.col("batch") <= committed["batch"]).select(*fields.names)
