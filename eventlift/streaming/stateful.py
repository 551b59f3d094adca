"""Gap sessions on a stream with the exact rule, kept in state of their own.

A user's open sessions are one state value: their starts, ends and counts.  An event joins every open session
that it is less than the gap away from, merging them.  A session is final once the watermark has reached its end
plus the gap, since an event in time can no longer join it; a timer at that moment emits it and drops it
from the state, and the state of a user without open sessions is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

_STATE = "starts array<long>, ends array<long>, counts array<long>"


def merged(sessions: list[list[int]], moments: list[tuple[int, int, int]], gap: int) -> list[list[int]]:
    """Sessions [start, end, count], in order and at least ``gap`` apart, after (first, last, count) runs are added."""
    out: list[list[int]] = []
    for start, end, count in sorted([*map(tuple, sessions), *moments]):
        if out and start - out[-1][1] < gap:
            out[-1][1] = max(out[-1][1], end)
            out[-1][2] += count
        else:
            out.append([start, end, count])
    return out


def _processor(gap: int) -> StatefulProcessor:
    merge = merged

    # a local class goes to the executors by value, so they need not have the package
    class OpenSessions(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("open", _STATE)

        def _open(self) -> list[list[int]]:
            if not self.state.exists():
                return []
            starts, ends, counts = self.state.get()
            return [list(s) for s in zip(starts, ends, counts)]

        def _keep(self, sessions: list[list[int]]) -> None:
            if sessions:
                self.state.update(tuple(list(c) for c in zip(*sessions)))
            else:
                self.state.clear()

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            sessions = merge(self._open(), [(r["first"], r["last"], r["n"]) for r in rows], gap)
            for _, end, _ in sessions:
                self.handle.registerTimer(-(-(end + gap) // 1000))
            self._keep(sessions)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            due = expiredTimerInfo.getExpiryTimeInMs() * 1000
            sessions = self._open()
            self._keep([s for s in sessions if s[1] + gap > due])
            for start, end, count in sessions:
                if end + gap <= due:
                    yield Row(user_id=key[0], start=start, end=end, event_count=count)

        def close(self) -> None:
            pass

    return OpenSessions()


def stream_gap_sessions(
    events: DataFrame,
    gap_seconds: float = 1800,
    user: str = "user_id",
    ts: str = "event_timestamp",
    watermark: str = "1 hour",
) -> DataFrame:
    """(user_id, session_start, session_end, event_count) of a stream, a row when a session is final.

    The rule is that of ``gap_sessions``: a new session from a gap of ``gap_seconds`` on.  Events may come in any
    order within the watermark; later ones are dropped.  Rows without user or time belong to no session.
    Needs the RocksDB state store, which the entry points set.  The result has its times as timestamps.
    """
    gap = int(gap_seconds * 1_000_000)
    micros = F.unix_micros(ts)
    runs = (
        events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
        .withWatermark(ts, watermark)
        .select(F.col(user).alias("user_id"), F.col(ts).alias("at"), micros.alias("first"), micros.alias("last"), F.lit(1).cast("long").alias("n"))
    )
    schema = T.StructType().add("user_id", "string").add("start", "long").add("end", "long").add("event_count", "long")
    found = runs.groupBy("user_id").transformWithState(_processor(gap), schema, "Append", "EventTime")
    return found.select(
        "user_id", F.timestamp_micros("start").alias("session_start"), F.timestamp_micros("end").alias("session_end"), "event_count"
    )
