"""De-duplication, bot filter and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlift import schema
from eventlift.functions import count_if


#: Words of the table of repeated ids: so many rows at most, whatever the input.
REPEAT_WORDS = 1 << 20


def repeated_keys(events: DataFrame, key: str, words: int = REPEAT_WORDS) -> DataFrame:
    """(word, bits): one bit for the hash of every key that occurs more than once.

    A single-hash Bloom filter as a table.  Only the key column is read, and counted by its 64-bit
    hash.  The table has ``words`` rows at most, so it may be broadcast.
    """
    hashes = events.where(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return (
        hashes.where("n > 1")
        .groupBy(F.pmod(F.shiftright("h", 6), F.lit(words)).alias("__word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(h & 63 AS INT)))").alias("__bits"))
    )


def dedup_events(
    events: DataFrame,
    key: str = "event_id",
    order: Sequence[str] = ("processed_at", "kafka_timestamp", "received_at"),
    words: int = REPEAT_WORDS,
) -> DataFrame:
    """Keep the earliest processed copy of every event id.

    Few ids repeat, so the repeated ones are searched first, on the key alone (``repeated_keys``); all rows whose
    key is not among them pass without a shuffle or sort.  The rest is ranked.  A key that only shares a bit with a
    repeated one is ranked as well and kept, so the filter decides how much is shuffled and never
    what is returned.  The ``row_number() = 1`` filter becomes a group limit before that shuffle, so a task
    forwards one row per id at most and an id with a huge number of copies never gathers in one
    place.  Rows without an id have no copies and pass through unchanged.  Apply row filters
    before; ``events`` is read three times, once for the key alone.
    """
    word = F.pmod(F.shiftright(F.xxhash64(key), 6), F.lit(words))
    filtered = F.broadcast(repeated_keys(events, key, words))
    marked = events.withColumn("__key_word", F.when(F.col(key).isNotNull(), word))
    marked = marked.join(filtered, F.col("__key_word") == F.col("__word"), "left")
    hit = F.expr(f"getbit(coalesce(__bits, 0L), CAST(xxhash64(`{key}`) & 63 AS INT)) = 1")
    rank = Window.partitionBy(key).orderBy(*[F.col(c) for c in order if c in events.columns])
    earliest = (
        marked.where(hit)
        .withColumn("__copy", F.row_number().over(rank))
        .where(F.col("__copy") == 1)
    )
    return earliest.select(*events.columns).unionByName(marked.where(~hit).select(*events.columns))


def dedup_stream(events: DataFrame, watermark: str = "1 hour", key: str = "event_id") -> DataFrame:
    """Streaming form: the first arriving copy wins, state lives for the watermark.

    As in the batch form, rows without an id have no copies: they go round the operator, so
    null is no key in its state.
    """
    marked = events.withWatermark("event_timestamp", watermark)
    once = marked.where(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return once.unionByName(marked.where(F.col(key).isNull()))


#: How far a client's clock may be ahead of the broker's.
FUTURE_TOLERANCE = "1 hour"


def _from_future(tolerance: str) -> Column:
    """An event time later than the broker's receive time and the tolerance; never for a missing time."""
    limit = F.col("kafka_timestamp") + F.expr(f"INTERVAL {tolerance}")
    return F.coalesce(F.col("event_timestamp") > limit, F.lit(False))


def present_events(events: DataFrame, tolerance: str = FUTURE_TOLERANCE) -> DataFrame:
    """Events whose clock is not ahead of the broker's by more than the tolerance.

    Apply it before a watermark: one event of a clock set to 2030 would move the watermark there, and every
    event after it would count as late.
    """
    return events.where(~_from_future(tolerance))


def future_events(events: DataFrame, tolerance: str = FUTURE_TOLERANCE) -> DataFrame:
    """The rest of ``present_events``."""
    return events.where(_from_future(tolerance))


def is_human(user_agent: Column) -> Column:
    """No agent, or one without ``bot`` in lower case (``BOT`` passes, ``Googlebot`` not)."""
    return user_agent.isNull() | ~user_agent.contains("bot")


def filter_bots(events: DataFrame, user_agent: str = "context.user_agent") -> DataFrame:
    return events.where(is_human(F.col(user_agent)))


def dq_checks(
    events: DataFrame,
    *,
    unique: Sequence[str] = ("event_id",),
    not_null: Sequence[str] = ("event_id", "user_id", "session_id", "event_type"),
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows failing each declared check, as ``(check, failing_rows)``.

    Null and accepted-value checks share one pass of conditional counts.  A unique
    check counts the rows of every value that occurs more than once; its counts are
    combined before the shuffle, so repeated values do not skew it.
    """
    if accepted is None:
        accepted = {"event_type": schema.EVENT_TYPES, "device_type": schema.DEVICE_TYPES}
    conditions = {f"not_null_{c}": F.col(c).isNull() for c in not_null}
    conditions |= {f"accepted_values_{c}": ~F.col(c).isin(list(v)) for c, v in accepted.items()}

    row = events.agg(*[F.coalesce(count_if(cond), F.lit(0)).alias(name) for name, cond in conditions.items()])
    result = row.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("check"), F.col(name).cast("long").alias("failing_rows"))
                    for name in conditions
                ]
            )
        ).alias("r")
    ).select("r.*")

    for name in unique:
        copies = (
            events.where(F.col(name).isNotNull())
            .groupBy(name)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failing_rows"))
        )
        result = result.unionByName(copies.select(F.lit(f"unique_{name}").alias("check"), "failing_rows"))
    return result
