"""Parse, default, enrich and validate incoming events."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlift import schema
from eventlift.functions import count_if, iso_utc, sum_if
from eventlift.sources.messages import decode_envelope


def with_ingest_metadata(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Add event time and the partition keys.

    Text that is no timestamp gives a NULL event time instead of failing the job.
    """
    return events.select(
        "*",
        F.try_to_timestamp("timestamp").alias("event_timestamp"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
    ).select(
        "*",
        F.to_date("event_timestamp").alias("event_date"),
        F.hour("event_timestamp").alias("event_hour"),
    )


def parse_events(messages: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Envelopes to raw rows (``schema.RAW``), batch or streaming.

    Permissive: a body that is no JSON gives an all-NULL event, a field of the wrong
    type gives NULL in that field only.
    """
    parsed = decode_envelope(messages).select(
        F.from_json("json_value", schema.EVENT).alias("event"), "kafka_timestamp"
    )
    return with_ingest_metadata(parsed.select("event.*", "kafka_timestamp"), processed_at).select(
        *schema.RAW.names
    )


def apply_defaults(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Fill what a client may leave out: id, feature, device, properties, context, time.

    ``uuid()`` is seeded per plan and partition, so apply this directly on the source
    scan: a retried task then regenerates the same ids.
    """
    now = F.current_timestamp() if now is None else now
    no_properties = F.struct(
        *[
            (
                F.create_map().cast(f.dataType) if f.name == "extra" else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.PROPERTIES.fields
        ]
    )
    no_context = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.CONTEXT.fields])
    return (
        events.withColumns(
            {
                "event_id": F.coalesce("event_id", F.expr("uuid()")),
                "feature_name": F.coalesce("feature_name", F.lit(schema.DEFAULT_FEATURE)),
                "event_properties": F.coalesce("event_properties", no_properties),
                "context": F.coalesce("context", no_context),
                "timestamp": F.coalesce("timestamp", iso_utc(now)),
            }
        )
        .withColumn(
            "event_properties",
            F.col("event_properties").withField(
                "extra",
                F.coalesce("event_properties.extra", F.create_map().cast(schema.PROPERTIES["extra"].dataType)),
            ),
        )
        .withColumn(
            "context",
            F.col("context").withField(
                "device_type", F.coalesce("context.device_type", F.lit(schema.DEFAULT_DEVICE))
            ),
        )
    )


def enrich_user_agent(events: DataFrame, header: str = "header_user_agent") -> DataFrame:
    """Keep the event's own user agent; otherwise take the request header's."""
    return events.withColumn(
        "context",
        F.col("context").withField("user_agent", F.coalesce("context.user_agent", header)),
    )


def stamp_received(events: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Server receive time as ISO text, one value for all rows of the run."""
    now = F.current_timestamp() if received_at is None else received_at.cast("timestamp")
    return events.withColumn("received_at", iso_utc(now))


def stripped(text: Column | str) -> Column:
    """A text without white space of any kind, Unicode's included, at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _out_of_range(value: Column, low, high) -> Column:
    sides = [value < low] if low is not None else []
    if high is not None:
        sides.append(value > high)
    return reduce(or_, sides)


def validation_rules(
    *,
    uuid_ids: bool = True,
    ranges: Sequence[tuple] = schema.RANGE_RULES,
    require_time: bool = True,
    field: Callable[[str], Column] = F.col,
) -> list[tuple[str, Column]]:
    """The rules as (reason, condition that breaks it).

    ``field`` turns a name such as ``context.device_type`` into its column: columns of the row, or
    fields of an array's element.
    """
    rules = [
        ("user_id:missing", field("user_id").isNull()),
        ("user_id:blank", F.length(stripped(field("user_id"))) == 0),
        ("session_id:missing", field("session_id").isNull()),
        ("event_type:missing", field("event_type").isNull()),
        ("event_type:unknown", ~field("event_type").isin(schema.EVENT_TYPES)),
        ("device_type:unknown", ~field("context.device_type").isin(schema.DEVICE_TYPES)),
    ]
    if uuid_ids:
        rules += [
            (f"{name}:format", ~field(name).rlike(schema.UUID_PATTERN))
            for name in ("event_id", "session_id")
        ]
    if require_time:
        rules.append(("timestamp:invalid", F.try_to_timestamp(field("timestamp")).isNull()))
    rules += [(f"{name.split('.')[-1]}:range", _out_of_range(field(name), low, high)) for name, low, high in ranges]
    rules.append(("event_id:missing", field("event_id").isNull()))
    return rules


def validate_events(
    events: DataFrame,
    *,
    uuid_ids: bool = True,
    ranges: Sequence[tuple] = schema.RANGE_RULES,
    require_time: bool = True,
) -> DataFrame:
    """Trim user ids; add ``reject_code`` and ``reject_reasons``.  No row is dropped.

    The code has one bit per broken rule and is 0 for a good event, the reasons are the
    same as texts.  Filter on the code: it is plain arithmetic, while the texts are put
    together only for events that break a rule.  Apply ``apply_defaults`` first when
    clients may omit id or timestamp.

    Rows of ``explode_batches`` carry ``batch_refused``; all events of a refused request are
    rejected for that reason as well, and the row of a request without events for nothing else.
    """
    rules = validation_rules(uuid_ids=uuid_ids, ranges=ranges, require_time=require_time)
    if "batch_refused" in events.columns:
        empty = F.col("batch_refused").eqNullSafe(EMPTY_BATCH)
        rules = [(reason, failed & ~empty) for reason, failed in rules]
        rules += [(reason, F.col("batch_refused").eqNullSafe(reason)) for reason in (EMPTY_BATCH, LARGE_BATCH)]
    broken = reduce(
        add, [F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, failed) in enumerate(rules)]
    )
    texts = F.array_compact(
        F.array(
            *[
                F.when(F.col("reject_code").bitwiseAND(F.lit(1 << i)) != 0, F.lit(reason))
                for i, (reason, _) in enumerate(rules)
            ]
        )
    )
    none = F.array().cast("array<string>")
    return (
        # one projection over the scan's own columns, so that unused nested fields are not read
        events.withColumns({"user_id": stripped("user_id"), "reject_code": broken})
        .withMetadata("reject_code", {"reasons": [reason for reason, _ in rules]})
        .withColumn("reject_reasons", F.when(F.col("reject_code") == 0, none).otherwise(texts))
    )


def accepted_events(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reject_code") == 0).drop("reject_code", "reject_reasons")


def rejected_events(validated: DataFrame) -> DataFrame:
    """The dead-letter rows, reasons kept."""
    return validated.where(F.col("reject_code") != 0)


def reject_reasons(validated: DataFrame) -> DataFrame:
    """Rejected events per reason; an event counts once under each of its reasons.

    Events are counted per code, a fixed-width key, so nothing but the code is read of them and
    aggregated; the handful of codes is then unfolded by the names of its bits, which the column carries.
    """
    names = validated.schema["reject_code"].metadata["reasons"]
    held = [F.when(F.col("reject_code").bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, name in enumerate(names)]
    return (
        rejected_events(validated)
        .groupBy("reject_code")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode(F.array_compact(F.array(*held))).alias("reason"), "n")
        .groupBy("reason")
        .agg(F.sum("n").alias("rejected_events"))
    )


_SHARES = 16


def batch_receipt(
    validated: DataFrame,
    batch: str = "batch_id",
    max_events: int | None = schema.MAX_BATCH_EVENTS,
) -> DataFrame:
    """One receipt per request batch: counts, accepted ids, error texts.

    For events that are rows already; requests with their lists of events have ``request_receipts``, without
    a shuffle.  With ``max_events=None`` no batch is refused, and a list is as long as its batch.

    A batch above ``max_events`` is refused whole.  Sizes are therefore counted
    first, with map-side partial sums; ids and errors are gathered only for batches
    within the limit, so a list never holds more than ``max_events`` entries however
    large a rogue batch is.  The rows of a rogue batch are dropped in a join on batch and
    a share of the event id, which spreads them over ``_SHARES`` partitions; as the
    grouping after it shuffles anyway, adaptive execution may split those further.
    Rows without a batch id belong to no request and get no receipt.
    """
    validated = validated.where(F.col(batch).isNotNull())
    accepted = F.col("reject_code") == 0
    sizes = validated.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total_events"), count_if(accepted).alias("__good")
    )
    within = F.lit(True) if max_events is None else F.col("total_events") <= max_events
    every_share = F.explode(F.sequence(F.lit(0), F.lit(_SHARES - 1))).alias("__share")
    share = F.pmod(F.xxhash64("event_id"), F.lit(_SHARES)).cast("int")
    error = F.concat_ws(
        ": ", F.coalesce("event_id", F.lit("?")), F.array_join("reject_reasons", ", ")
    )
    small = (
        validated.select(
            batch,
            F.coalesce(share, F.lit(0)).alias("__share"),
            F.when(accepted, F.col("event_id")).alias("__id"),
            F.when(~accepted, error).alias("__error"),
        )
        .join(sizes.where(within).select("*", every_share), [batch, "__share"])
        .groupBy(batch, "total_events", "__good")
        .agg(
            F.array_sort(F.collect_list("__id")).alias("event_ids"),
            F.array_sort(F.collect_list("__error")).alias("errors"),
        )
    )
    large = sizes.where(~within).select(
        batch,
        "total_events",
        F.lit(0).cast("long").alias("__good"),
        F.array().cast("array<string>").alias("event_ids"),
        F.array(F.lit(f"batch: more than {max_events} events")).alias("errors"),
    )
    good = F.col("__good")
    return small.unionByName(large).select(
        batch,
        (good > 0).alias("success"),
        "total_events",
        good.alias("accepted_events"),
        (F.col("total_events") - good).alias("rejected_events"),
        "event_ids",
        "errors",
    )


#: Why a request is refused whole.
EMPTY_BATCH, LARGE_BATCH = "batch:empty", "batch:large"


def _refused(events: Column, max_events: int | None) -> Column:
    """The reason to refuse a request with this array of events, or NULL."""
    size = F.coalesce(F.size(events), F.lit(0))
    refused = F.when(size <= 0, F.lit(EMPTY_BATCH))
    return refused if max_events is None else refused.when(size > max_events, F.lit(LARGE_BATCH))


def request_receipts(
    requests: DataFrame,
    max_events: int | None = schema.MAX_BATCH_EVENTS,
    *,
    uuid_ids: bool = True,
    ranges: Sequence[tuple] = schema.RANGE_RULES,
    require_time: bool = True,
) -> DataFrame:
    """One receipt per request row ``(batch_id, header_user_agent, events)``, in the row itself.

    The nested events are judged by array functions: no explode, no shuffle, no grouping, and a request
    without events, or with a null list, has its receipt too.  Such a request is refused as ``batch:empty``, one above
    ``max_events`` as ``batch:large`` (``None`` sets no limit); a refused request accepts nothing and its
    error is the reason.  Ids and errors are sorted.  A null entry in the list counts as an event without fields.
    """

    def judged(event: Column) -> Column:
        field = lambda name: reduce(lambda column, part: column[part], name.split("."), event)
        rules = validation_rules(uuid_ids=uuid_ids, ranges=ranges, require_time=require_time, field=field)
        broken = F.array_compact(F.array(*[F.when(failed, F.lit(reason)) for reason, failed in rules]))
        return F.struct(event["event_id"].alias("id"), F.array_join(broken, ", ").alias("reasons"))

    none = F.array().cast("array<string>")
    refused = _refused(F.col("events"), max_events)
    verdicts = F.when(refused.isNull(), F.transform("events", judged))
    good = F.filter("verdicts", lambda v: v["reasons"] == "")
    bad = F.filter("verdicts", lambda v: v["reasons"] != "")
    error = lambda v: F.concat_ws(": ", F.coalesce(v["id"], F.lit("?")), v["reasons"])
    accepted = F.coalesce(F.size("ids"), F.lit(0)).cast("long")
    return (
        requests.select("batch_id", refused.alias("batch_refused"), F.greatest(F.coalesce(F.size("events"), F.lit(0)), F.lit(0)).cast("long").alias("total_events"), verdicts.alias("verdicts"))
        .select("batch_id", "batch_refused", "total_events", F.transform(good, lambda v: v["id"]).alias("ids"), F.transform(bad, error).alias("wrong"))
        .select(
            "batch_id",
            F.coalesce(F.size("ids") > 0, F.lit(False)).alias("success"),
            "batch_refused",
            "total_events",
            accepted.alias("accepted_events"),
            (F.col("total_events") - accepted).alias("rejected_events"),
            F.coalesce(F.array_sort("ids"), none).alias("event_ids"),
            F.coalesce(F.array_sort("wrong"), F.array("batch_refused")).alias("errors"),
        )
    )


def explode_batches(requests: DataFrame, max_events: int | None = schema.MAX_BATCH_EVENTS) -> DataFrame:
    """Request rows ``(batch_id, header_user_agent, events)`` to one row per event.

    ``batch_refused`` has the reason to refuse the request, by which ``validate_events`` rejects its events.  A
    request without events stays as one row without event fields, so that its refusal is not lost.
    """
    rows = requests.select("batch_id", "header_user_agent", _refused(F.col("events"), max_events).alias("batch_refused"), F.explode_outer("events").alias("e"))
    return rows.select("batch_id", "header_user_agent", "batch_refused", "e.*")


def ingest_totals(validated: DataFrame) -> DataFrame:
    """Total, accepted and rejected events of a run, as one row; requests without events add none."""
    if "batch_refused" in validated.columns:
        validated = validated.where(~F.col("batch_refused").eqNullSafe(EMPTY_BATCH))
    good = F.col("reject_code") == 0
    return validated.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(sum_if(good, F.lit(1)), F.lit(0)).alias("accepted_events"),
        F.coalesce(sum_if(~good, F.lit(1)), F.lit(0)).alias("rejected_events"),
    )
