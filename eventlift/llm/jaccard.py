"""N-gram Jaccard join by a size-aware heavy-light plan.

Each text is the set of its distinct word shingles.  Two sets link when their Jaccard
similarity reaches a threshold t.  Equal sets are one class from the start, named by a hash of
the set.  Shingles are ordered by hash, those found to be frequent last; any total order keeps
the prefix rule exact:

* *heavy* sets (above the boundary): two sets that link share a shingle among the first
  ``n - ceil(t n) + 1`` of each; these form inverted lists, which are scanned.
* *light* sets (up to the boundary): two sets that link share at least two shingles among the
  first ``n - ceil(t n) + 2`` of each; all subsets of two of them are enumerated and matched.
  Light sets that are large enough to link with a heavy one enter the inverted lists too.

The boundary is chosen by cost: subsets to enumerate for the sizes below it against list entries
and the pairs that lists hold for the sizes above it, both summed over all texts.

An entry carries how many shingles its set can share from that key on (``most``).  For two sets
the first key that they share bounds their intersection by the lesser ``most``, so two entries that
cannot reach the threshold are no candidate: near copies whose own, rare shingles come first
in the order are told apart without their texts.

Candidates are verified on the full sets.  Only components are reported, so lists are
compared in two steps: every member with three of its list, among them the one with the fewest
shingles before the key, which is the middle of a group of near copies; then, in
lists whose members are still in different components, all members of different components.
A pair inside one component cannot change the result, so a group of n near copies that the
first step joins costs 3 n pairs at most, not n squared.  Each step moves the texts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlift.llm.graph import components
from eventlift.llm.shingles import mix, shingle_sets, signed
from eventlift.llm.tables import batch_rows, removed, width, written
from eventlift.llm.worker import lean

#: Frequent shingles that are ordered last: at most so many, which bounds what tasks are sent.
FREQUENT = 1 << 16
#: A shingle counts as frequent from so many sets on.
FREQUENT_FROM = 16
#: Entries of an outgoing batch, and texts of one where each row brings two: what a task holds of them at once.
BATCH_ENTRIES, BATCH_TEXTS = 1 << 17, 500
#: Size classes for the boundary: eight a doubling.
CLASSES = 8
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LIGHT = np.uint64(0xA0761D6478BD642F)
_ENTRY = ["key", "name", "n", "most"]


def need(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any set it links with."""
    return -(-n * percent // 100)


def set_name(own: np.ndarray) -> int:
    """A hash of a set."""
    total = own[:1] * 0 + own.sum(dtype=np.uint64)
    return int(signed(mix(mix(total * _PAIR + np.bitwise_xor.reduce(own) + np.uint64(len(own)))))[0])


def size_class(n: int) -> int:
    return int(CLASSES * np.log2(n)) if n else 0


def class_top(c: int) -> int:
    """The largest set size of a class."""
    return int(np.ceil(2 ** ((c + 1) / CLASSES))) + 1


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _surveyor(size: int, percent: int):
    """First pass: the sets of all rows (kind 0) with the rows' hashes, repeated shingles (1), costs by size class (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, sets = [], [], {}
            for own in shingle_sets(_column(batch, "text"), size):
                name = set_name(own) if len(own) else None
                names.append(name)
                sizes.append(len(own))
                if name is not None:
                    sets.setdefault(name, own)
            ids, hashes = _column(batch, "id").to_pylist(), _column(batch, "hash").to_pylist()
            out = [[0] * len(ids), ids, names, sizes, hashes]
            if sets:
                values, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
                often = counts > 1
                values, counts = values[often], counts[often]
                out = [x + y for x, y in zip(out, ([1] * len(values), signed(values).tolist(), counts.tolist(), *2 * [[0] * len(values)]))]
                cost: dict[int, list[int]] = {}
                for own in sets.values():
                    n = len(own)
                    p = n - need(n, percent) + 1
                    at = np.searchsorted(values, own[:p])
                    at[at == len(values)] = 0
                    met = counts[at][values[at] == own[:p]] - 1 if len(values) else np.zeros(0, int)
                    c = cost.setdefault(size_class(n), [0, 0])
                    c[0] += min(p + 1, n) * (min(p + 1, n) - 1) // 2
                    c[1] += p + int(met.sum())
                out = [x + y for x, y in zip(out, ([2] * len(cost), list(cost), [v[0] for v in cost.values()], [v[1] for v in cost.values()], [0] * len(cost)))]
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int8()), *(pa.array(x, pa.int64()) for x in out[1:])], names=["kind", "x", "y", "z", "hash"])

    return run


def boundary(costs: list[tuple[int, int, int]]) -> int:
    """The largest light set size, from (class, subsets, list entries and pairs)."""
    best, chosen = sum(c[2] for c in costs), 0
    light, heavy = 0, best
    for c, subsets, lists in sorted(costs):
        light, heavy = light + subsets, heavy - lists
        if light + heavy <= best:
            best, chosen = light + heavy, class_top(c)
    return chosen


def _poster(size: int, percent: int, frequent: np.ndarray, limit: int):
    """Second pass: (key, name, n, most) of every list entry and subset."""

    def entries(own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n = len(own)
        p = n - need(n, percent) + 1
        head = own
        if len(frequent):
            at = np.searchsorted(frequent, own)
            at[at == len(frequent)] = 0
            last = frequent[at] == own
            head = np.concatenate([own[~last], own[last]]) if last.any() else own
        if n <= limit:
            few = head[: p + 1]  # in the common order, so a subset has one key in all sets
            i, j = np.triu_indices(len(few), 1)
            yield mix(few[i] * _PAIR + few[j] + _LIGHT), n + 1 - j
        if n > limit or 100 * n >= percent * (limit + 1):
            yield head[:p], n - np.arange(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [], [], [], []

        def batch_of() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=_ENTRY)
            for c in out:
                c.clear()
            return found

        for batch in batches:
            seen, held = set(), 0
            for own in shingle_sets(_column(batch, "text"), size):
                if not len(own) or (name := set_name(own)) in seen:
                    continue
                seen.add(name)
                for key, most in entries(own):
                    for c, x in zip(out, (signed(key), np.full(len(key), name, np.int64), np.full(len(key), len(own), np.int32), most.astype(np.int32))):
                        c.append(x)
                    held += len(key)
                if held > BATCH_ENTRIES:
                    yield batch_of()
                    held = 0
            if held:
                yield batch_of()

    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From entries in order of (key, name): those of lists with two different sets at least."""
    held = np.zeros((4, 0), np.int64)  # the last entry of the batch before
    open_list = False
    for batch in batches:
        entries = np.array([_column(batch, c).to_numpy() for c in _ENTRY], np.int64)
        if not entries.shape[1]:
            continue
        carried = held.shape[1]
        entries = np.concatenate([held, entries], axis=1)
        key, name = entries[:2]
        fresh = np.append(True, (key[1:] != key[:-1]) | (name[1:] != name[:-1]))
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        members = np.add.reduceat(fresh.astype(np.int64), starts)
        long_list = members > 1
        if carried and open_list:
            long_list[0] = True
        keep = fresh & np.repeat(long_list, np.diff(np.append(starts, len(key))))
        if carried and open_list:
            keep[0] = False  # written with its own batch
        # an entry carried over is written once its list has a second member
        held = entries[:, -1:]
        open_list = bool(long_list[-1])
        if not open_list:
            keep[-1] = False
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]).cast(t) for x, t in zip(entries, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=_ENTRY)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as they are shuffled and joined for verification only."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = (x.as_buffer() for x in _column(batch, "text").fill_null("").cast(pa.large_binary()))
        yield pa.RecordBatch.from_arrays([_column(batch, "hash"), pa.array([packer.compress(x) for x in texts], pa.binary())], names=["hash", "packed"])


def _unpacked(column: pa.Array) -> pa.Array:
    unpacker = zstandard.ZstdDecompressor()
    return pa.array([unpacker.decompress(x.as_buffer()).decode() for x in column], pa.string())


def _verifier(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            a, b = _column(batch, "a"), _column(batch, "b")
            for at in range(0, batch.num_rows, 500):
                pairs = list(zip(a.slice(at, 500).to_pylist(), b.slice(at, 500).to_pylist()))
                now = {n for p in pairs for n in p}
                held = {n: s for n, s in held.items() if n in now}
                for side, packed in ((0, _column(batch, "x")), (1, _column(batch, "y"))):
                    rows = {p[side]: at + i for i, p in enumerate(pairs) if p[side] not in held}
                    if rows:
                        held.update(zip(rows, shingle_sets(_unpacked(packed.take(pa.array(list(rows.values())))), size)))
                keep = []
                for m, n in pairs:
                    both = np.sort(np.concatenate([held[m], held[n]]))
                    shared = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * shared >= percent * (len(both) - shared))
                yield pa.RecordBatch.from_arrays([a.slice(at, 500), b.slice(at, 500)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text; others are ignored).

    ``component_id`` is the smallest doc_id reachable by links, a row's own included.  A null or
    empty text has no shingle and links with nothing; a text of fewer words than ``size`` is one
    shingle.  Repeated rows stay repeated.  A row without doc_id takes the smallest doc_id of its
    component, null if there is none.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    hashed = texts.select("id", F.xxhash64("id", "text").alias("hash"), "text")
    survey = written(hashed.mapInArrow(lean(_surveyor(size, percent)), "kind tinyint, x long, y long, z long, hash long"), "jaccard-survey")
    members = survey.where("kind = 0").select(F.col("x").alias("doc_id"), F.col("y").alias("name"), F.col("z").alias("n_shingles"))
    costs = [tuple(r) for r in survey.where("kind = 2").groupBy("x").agg(F.sum("y"), F.sum("z")).collect()]  # a row a size class
    often = survey.where("kind = 1").groupBy("x").agg(F.sum("y").alias("n")).where(F.col("n") >= FREQUENT_FROM)
    frequent = np.array([r[0] for r in often.orderBy(F.desc("n"), "x").limit(FREQUENT).collect()], np.int64)
    frequent = np.sort(frequent.view(np.uint64))
    limit = boundary(costs)

    entries = texts.select("text").mapInArrow(lean(_poster(size, percent, frequent, limit)), "key long, name long, n int, most int")
    entries = entries.repartition(width(spark), "key").sortWithinPartitions("key", "name")
    lists = written(entries.mapInArrow(lean(_lists), "key long, name long, n int, most int"), "jaccard-lists")

    # the text of a set is that of one of its rows, which is found by a hash of doc_id and text as doc_ids may repeat
    whose = survey.where("kind = 0 AND y IS NOT NULL").groupBy(F.col("y").alias("name")).agg(F.min("hash").alias("hash"))

    def verified(pairs: DataFrame) -> DataFrame:
        packed = hashed.select("hash", "text").mapInArrow(lean(_packed), "hash long, packed binary").dropDuplicates(["hash"])
        for name, at in (("a", "at_a"), ("b", "at_b")):
            pairs = pairs.join(whose.select(F.col("name").alias(name), F.col("hash").alias(at)), name)
        for at, text in (("at_a", "x"), ("at_b", "y")):
            pairs = pairs.join(packed.select(F.col("hash").alias(at), F.col("packed").alias(text)), at).drop(at)
        return pairs.select("a", "b", "x", "y").mapInArrow(lean(_verifier(size, percent)), "a long, b long")

    def alike(pairs: DataFrame) -> DataFrame:
        reach = f"{100 + percent} * least(ma, mb) >= {percent} * (na + nb)"
        return pairs.where(f"a <> b AND {reach}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def side(entries: DataFrame, x: str, *more: str) -> DataFrame:
        return entries.select("key", F.col("name").alias(x), F.col("n").alias(f"n{x}"), F.col("most").alias(f"m{x}"), *more)

    # every member with three of its list
    who = F.struct("name", "n", "most")
    pivots = F.array(F.min_by(who, F.struct(F.expr("n - most"), "name")), F.max(who), F.min_by(who, F.struct(F.xxhash64("name"), "name")))
    some = lists.groupBy("key").agg(pivots.alias("p")).select("key", F.explode(F.array_distinct("p")).alias("p")).select("key", "p.*")
    tried = written(alike(side(lists, "a").join(side(some, "b"), "key")), "jaccard-stars")
    with batch_rows(spark, BATCH_TEXTS):
        links = written(verified(tried), "jaccard-links")
    found = components(links)

    # what is still apart, each with each of another component
    placed = lists.join(found.withColumnRenamed("node", "name"), "name", "left").select(*_ENTRY, F.coalesce("root", "name").alias("root"))
    split = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    placed = written(placed.join(split, "key", "left_semi"), "jaccard-split")
    apart = side(placed, "a", F.col("root").alias("ra")).join(side(placed, "b", F.col("root").alias("rb")), "key")
    rest = written(alike(apart.where("a < b AND ra <> rb")).join(tried, ["a", "b"], "left_anti"), "jaccard-rest")
    removed(lists, placed, tried)
    with batch_rows(spark, BATCH_TEXTS):
        more = written(verified(rest), "jaccard-more")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    placed = members.join(found.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
