"""Document fingerprints: threshold-scaled sketches.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range, so its size
grows with the text, sketches of parts merge by union, and containment between texts of very
unequal length can be estimated.  Short texts would keep too little; so the ``FLOOR`` smallest
hashes are kept in any case, which merges as well (union, then drop what neither rule keeps).

Written form: the covered range and the sorted hashes, 16 hex digits each.  Below the covered
range every shingle hash of the text is present.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlift.llm.shingles import shingle_sets
from eventlift.llm.tables import width

#: A sketch keeps one of so many hashes.
SCALE = 4
FLOOR = 8
_TOP = (1 << 64) - 1


class Sketch:
    """Kept hashes and the range in which none is missing."""

    def __init__(self, hashes: np.ndarray, covered: int):
        self.hashes, self.covered = hashes, covered

    @classmethod
    def of(cls, distinct: np.ndarray, scale: int = SCALE, floor: int = FLOOR) -> Sketch:
        """From all distinct shingle hashes of a text, sorted."""
        below = int(np.searchsorted(distinct, np.uint64(_TOP // scale), side="right"))
        if len(distinct) <= floor:
            return cls(distinct, _TOP)
        if below >= floor:
            return cls(distinct[:below], _TOP // scale)
        return cls(distinct[:floor], int(distinct[floor - 1]))

    @classmethod
    def parse(cls, text: str) -> Sketch:
        values = np.array([int(text[i : i + 16], 16) for i in range(0, len(text), 16)], np.uint64)
        return cls(values[1:], int(values[0]))

    def merged(self, other: Sketch) -> Sketch:
        """The sketch of two texts' shingles together, from their sketches alone."""
        covered = min(self.covered, other.covered)
        both = np.unique(np.concatenate([self.hashes, other.hashes]))
        return Sketch(both[both <= np.uint64(covered)], covered)

    def containment(self, other: Sketch) -> float | None:
        """Estimated share of the smaller text's shingles that the larger has, 0 to 1.

        None where one of the two has no hash in the range that both cover, which says nothing of the texts.
        Two texts without shingles count as equal, one of them against others as different.
        """
        covered = np.uint64(min(self.covered, other.covered))
        mine, theirs = self.hashes[self.hashes <= covered], other.hashes[other.hashes <= covered]
        if not len(self.hashes) or not len(other.hashes):
            return float(len(self.hashes) == len(other.hashes))
        if not len(mine) or not len(theirs):
            return None
        return len(np.intersect1d(mine, theirs, assume_unique=True)) / min(len(mine), len(theirs))

    def __bytes__(self) -> bytes:
        return np.append(np.uint64(self.covered), self.hashes).astype(">u8").tobytes()

    def __str__(self) -> str:
        return bytes(self).hex()


def likeness(a: Sketch, b: Sketch) -> float:
    """Containment as two fingerprints give it; 0 where one of them has no hash in the range that both cover."""
    return a.containment(b) or 0.0


def edited(text: str, after: str) -> str:
    """The text with its last third replaced by as many first code points of another."""
    n = len(text) // 3
    return text[: len(text) - n] + after[:n]


_FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]
#: Rows compared at a time.
_ROWS = 500


def _sketches(texts: list[str]) -> list[Sketch]:
    return [Sketch.of(s) for s in shingle_sets(pa.array(texts, pa.string()))]


def _compared(ids: list, texts: list[str]) -> pa.RecordBatch:
    """All rows but the last, each with its next one."""
    changed = [edited(t, after) for t, after in zip(texts, texts[1:])]
    own, new = _sketches(texts), _sketches(changed)
    columns = [
        ids[:-1],
        [len(t) for t in texts[:-1]],
        [hashlib.sha256(c.encode()).hexdigest() for c in changed],
        [bytes(s) for s in own[:-1]],
        [bytes(s) for s in new],
        [likeness(a, b) for a, b in zip(own, new)],
        [likeness(a, b) for a, b in zip(own, own[1:])],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order, each compared with the next; the last is the one that follows the range."""
    ids, texts = [], []
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            ids += batch.column(0).slice(at, _ROWS).to_pylist()
            texts += batch.column(1).slice(at, _ROWS).to_pylist()
            yield _compared(ids, texts)
            ids, texts = ids[-1:], texts[-1:]


def _place(bounds: list[int]) -> Column:
    """How many of the sorted bounds are below doc_id; 0 without one.  Searched in two levels."""
    side = max(1, math.isqrt(len(bounds)))
    parts = [bounds[i : i + side] for i in range(0, len(bounds), side)] or [[]]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < F.col("doc_id")))

    def longs(values: list[int]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<long>")

    whole = below(longs([p[-1] for p in parts if p]))
    inner = F.coalesce(F.get(F.array(*map(longs, parts)), whole), longs([]))
    found = F.least(whole * side + below(inner), F.lit(len(bounds)))
    return F.when(F.col("doc_id").isNull(), 0).otherwise(found).cast("int")


def _ranged(rows: DataFrame) -> DataFrame:
    """Rows in ranges of descending doc_id, and behind each range its successor, the first row of the next one.

    Ranges come from quantiles of the ids, at most ``spark.sql.shuffle.partitions``; bounds and first
    ids, a number a range each, are all that the driver sees.  Only the successors' texts are read
    a second time, so texts are shuffled once and nothing is written between.
    """
    parts = width(rows.sparkSession)
    shares = [i / parts for i in range(1, parts)]
    bounds = rows.select(F.percentile_approx("doc_id", shares).alias("b")).first()["b"] if shares else []
    bounds = sorted(set(bounds or []))
    rows = rows.withColumn("part", F.lit(len(bounds)) - _place(bounds))
    firsts = {r[0]: r[1] for r in rows.groupBy("part").agg(F.max("doc_id")).collect()}  # a row a range
    order = sorted(firsts)
    before = {p: order[i - 1] for i, p in enumerate(order)}  # the first range follows the last
    ids = [i for i in firsts.values() if i is not None]
    first = F.col("doc_id").isin(ids) if ids else F.lit(True)  # without any id all rows are one range
    heads = rows.where(first).groupBy("part").agg(F.min("text").alias("text"))
    to = F.array(*(F.lit(before.get(p, p)) for p in range(len(bounds) + 1)))
    heads = heads.select(F.lit(None).cast("long").alias("doc_id"), "text", F.get(to, F.col("part")).alias("part"), F.lit(1).alias("follows"))
    both = rows.withColumn("follows", F.lit(0)).unionByName(heads)
    return both.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("follows", F.desc("doc_id"), "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Sketches of every whole text and of its edited text, with their likeness as the sketches give it.

    The next document is the next in descending doc_id (rows of equal doc_id in order of their
    texts, without doc_id last); after the last comes the first, which may be the row itself.  A
    null text counts as empty.  Likeness is 0 where a sketch has no hash in the range that both
    cover: of a text of n shingles beside one much longer, a chance of (1 - 1/``SCALE``)^n.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found = _ranged(rows).select("doc_id", "text").mapInArrow(_neighbours, _FIELDS)
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
