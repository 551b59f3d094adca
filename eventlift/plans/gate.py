"""A quality gate that costs no scan: metrics observed while a table is written decide its publication."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventlift import schema

#: check -> condition of a fact row that fails it
CHECKS: Mapping[str, str] = {
    "event_id:missing": "event_id IS NULL",
    "user_id:missing": "user_id IS NULL",
    "session_id:missing": "session_id IS NULL",
    "event_date:missing": "event_date IS NULL",
    "event_type:unknown": "event_type IS NULL OR event_type NOT IN ({})".format(", ".join(f"'{t}'" for t in schema.EVENT_TYPES)),
    "time_on_step_ms:negative": "time_on_step_ms < 0",
    "total_time_ms:negative": "total_time_ms < 0",
    "match_score:range": "match_score < 0 OR match_score > 100",
}


class QualityError(RuntimeError):
    """Rules that the written rows break, as {check: (failing rows, rows)}."""

    def __init__(self, broken: dict[str, tuple[int, int]]):
        self.broken = broken
        super().__init__("; ".join(f"{c}: {n} of {rows} rows" for c, (n, rows) in broken.items()))


@dataclass(frozen=True)
class Gate:
    """Share of rows that may fail each check; checks without an entry may fail in no row.

    ``least_rows`` guards against an empty or truncated source.
    """

    allowed: Mapping[str, float] = field(default_factory=lambda: {"event_type:unknown": 0.25})
    checks: Mapping[str, str] = field(default_factory=lambda: dict(CHECKS))
    least_rows: int = 0

    def watch(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """The frame with its metrics attached; they are there once it has been written."""
        seen = Observation()
        failing = [F.count(F.when(F.expr(c), F.lit(1))).alias(f"check_{i}") for i, c in enumerate(self.checks.values())]
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *failing), seen

    def decide(self, seen: Observation) -> dict[str, int]:
        """Failing rows by check, with all rows under ``rows``; raises where more fail than allowed."""
        got = seen.get
        found = {name: got[f"check_{i}"] for i, name in enumerate(self.checks)}
        rows = got["rows"]
        broken = {c: (n, rows) for c, n in found.items() if n > self.allowed.get(c, 0.0) * rows}
        if rows < self.least_rows:
            broken["rows:few"] = (self.least_rows - rows, rows)
        if broken:
            raise QualityError(broken)
        return {"rows": rows, **found}
