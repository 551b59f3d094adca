"""LM scoring by a probabilistic suffix tree.

The model runs over the bytes of the token sequence: lower-cased words with a space between, then one end
symbol, so that words never seen have a probability as well.  Its states are contexts of up to ``DEPTH``
bytes.  Training windows of ``DEPTH + 1`` bytes of every training text are counted in one aggregation; counts of shorter
ones are sums of these.  A context is retained if it is frequent enough and its next-byte distribution diverges
from that of the context one byte shorter by more than its own description costs (in nats: followers times
half the logarithm of its count); suffixes of retained contexts are retained as well.  The
distribution of a state is smoothed with that of its suffix, in proportion to its number of different followers,
down to a uniform one.  A byte is scored in the longest retained suffix of what precedes it.

Retained contexts are few against the text but have no fixed bound, so the model goes to the tasks in shards
of at most ``MODEL_ENTRIES`` counts, by the last two bytes of the context: all states of a position are in one
shard.  Usually there is one; otherwise documents pass through one written table a shard.

The base score needs the training count of each document's words.  Tasks send a row for each chunk of
documents and distinct word with the places of that word; it meets the word's total in a join on the word, and
comes back as sums by document.  A frequent word is one row a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlift.llm.shingles import buffers, pieces, signed, word_hashes
from eventlift.llm.tables import new_path, written

#: Bytes of the longest context.
DEPTH = 5
#: Occurrences below which a context is not retained.
LEAST = 4
MODEL_ENTRIES = 4_000_000
#: Bytes that a normalised text can hold, besides the start symbol.
SYMBOLS = 226
START, END, SPACE = 0x09, 0x0A, 0x20
#: A chunk of documents, and what is scored at once: at most so many bytes (or one document); rows of a chunk.
CHUNK_BYTES, PIECE_BYTES, CHUNK_ROWS = 16_000_000, 4_000_000, 1 << 16
#: Rows that a task sums before it passes them on.
FLUSH = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
_SOLID = np.ones(256, bool)
_SOLID[[0x20, *range(0x09, 0x0E)]] = False


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all token sequences, each after ``DEPTH`` start symbols, and the n + 1 offsets of the rows."""
    data, offsets = buffers(column)
    rows = len(offsets) - 1
    solid = _SOLID[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = solid[heads]
    starts = np.flatnonzero(first)
    at = np.searchsorted(starts, offsets)
    first[starts[at[:-1][at[:-1] < at[1:]]]] = False  # no space before the first word of a row
    letters = np.concatenate([[0], np.cumsum(solid)])[offsets]
    spaces = np.concatenate([[0], np.cumsum(first)])[offsets]
    size = np.diff(letters) + np.diff(spaces) + DEPTH + 1
    out_offsets = np.concatenate([[0], np.cumsum(size)])
    out = np.full(out_offsets[-1], SPACE, np.uint8)
    place = np.cumsum(solid.astype(np.int32) + first)[solid] - 1
    place += np.repeat(np.arange(rows, dtype=np.int64) * (DEPTH + 1) + DEPTH, np.diff(letters))
    out[place] = _LOWER[data[solid]]
    out[out_offsets[1:] - 1] = END
    for i in range(DEPTH):
        out[out_offsets[:-1] + i] = START
    return out, out_offsets


def windows(data: np.ndarray) -> np.ndarray:
    """The ``DEPTH + 1`` bytes up to each place that is no start symbol, as one number."""
    out = np.zeros(max(0, len(data) - DEPTH), np.int64)
    for i in range(DEPTH + 1):
        out <<= 8
        out |= data[i : len(data) - DEPTH + i]
    return out[data[DEPTH:] != START]


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each is there."""
    inside = np.sort(values)
    starts = np.flatnonzero(np.append(True, inside[1:] != inside[:-1])[: len(inside)])
    return inside[starts], np.diff(np.append(starts, len(inside)))


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of values that keeps that of equal ones, where each distinct value starts in it, and these values."""
    order = np.argsort(values, kind="stable")
    inside = values[order]
    starts = np.flatnonzero(np.append(True, inside[1:] != inside[:-1])[: len(inside)])
    return order, starts, inside[starts]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)


_GATHERED = "kind int, chunk long, row int, doc_id long, text_hash long, item long, n long, places binary"
_DOC, _WORD, _WINDOW = 0, 1, 2


def _rows(kind: int, size: int, **columns) -> pa.RecordBatch:
    names = [f.split() for f in _GATHERED.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns["kind"] = pa.array(np.full(size, kind, np.int32))
    arrays = [columns[n] if n in columns else pa.nulls(size, kinds[k]) for n, k in names]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in names])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, words by chunk and training windows of a partition's rows (doc_id, text_hash, train, text)."""
    chunk = TaskContext.get().partitionId() << 32
    keys, counts, waiting = [], [], 0
    for batch in batches:
        for start, stop in pieces(batch.column(3), CHUNK_BYTES):
            for first in range(start, stop, CHUNK_ROWS):
                part = batch.slice(first, min(CHUNK_ROWS, stop - first))
                rows, text = part.num_rows, part.column(3)
                train = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                parts = [word_hashes(*buffers(text.slice(i, j - i))) for i, j in pieces(text, PIECE_BYTES)]
                hashes, number = np.concatenate([h for h, _ in parts]), np.concatenate([np.diff(a) for _, a in parts])
                yield _rows(_DOC, rows, chunk=pa.array(np.full(rows, chunk)), row=pa.array(np.arange(rows, dtype=np.int32)), doc_id=part.column(0), text_hash=part.column(1), n=pa.array(number))
                if len(hashes):
                    row = np.repeat(np.arange(rows), number)
                    order, heads, words = grouped(hashes)
                    row = row[order]
                    places = row.astype("<u2").tobytes()
                    ends = (2 * np.append(heads, len(row))).astype(np.int32)
                    known = np.add.reduceat(train[row].astype(np.int64), heads)
                    binary = pa.BinaryArray.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(places)])
                    yield _rows(_WORD, len(words), chunk=pa.array(np.full(len(words), chunk)), item=pa.array(signed(words)), n=pa.array(known), places=binary)
                chunk += 1
                learned = text.filter(pa.array(train))
                for i, j in pieces(learned, PIECE_BYTES):
                    found, n = counted(windows(normalised(learned.slice(i, j - i))[0]))
                    keys.append(found)
                    counts.append(n)
                    waiting += len(found)
                    if waiting > 2 * FLUSH:
                        merged, n = _merged(keys, counts)
                        keys, counts, waiting = [merged], [n], len(merged)
                        if waiting > FLUSH:
                            yield _rows(_WINDOW, waiting, item=pa.array(merged), n=pa.array(n))
                            keys, counts, waiting = [], [], 0
    if keys:
        merged, n = _merged(keys, counts)
        yield _rows(_WINDOW, len(merged), item=pa.array(merged), n=pa.array(n))


def _low(column: str, size: int) -> Column:
    """The last ``size`` bytes of a gram."""
    return F.col(column).bitwiseAND(F.lit((1 << 8 * size) - 1))


def suffix_tree(longest: DataFrame, depth: int = DEPTH, least: int = LEAST) -> DataFrame:
    """(size, gram, n): the counts of all retained contexts with their next bytes, from windows (gram, n) of ``depth + 1`` bytes.

    ``size`` is the length of the gram, a context and its next byte; the empty context is always retained.
    """
    grams = {depth + 1: longest}
    for size in range(depth, 0, -1):
        grams[size] = written(grams[size + 1].groupBy(_low("gram", size).alias("gram")).agg(F.sum("n").alias("n")), f"grams-{size}")
    context = F.shiftright("gram", 8)
    total = {1: grams[1].groupBy(context.alias("context")).agg(F.sum("n").alias("c"))}
    passing = {}
    for size in range(2, depth + 2):
        shorter = grams[size - 1].select(F.col("gram").alias("low"), F.col("n").alias("low_n"))
        both = grams[size].withColumn("low", _low("gram", size - 1)).join(shorter, "low")
        own = both.groupBy(context.alias("context")).agg(F.sum("n").alias("c"), F.count("*").alias("d"), F.sum(F.col("n") * F.log(F.col("n") / F.col("low_n"))).alias("ratio"))
        up = total[size - 1].select(F.col("context").alias("up"), F.col("c").alias("up_c"))
        own = own.withColumn("up", _low("context", size - 2)).join(up, "up")
        gain = F.col("ratio") - F.col("c") * F.log(F.col("c") / F.col("up_c"))
        total[size] = written(own.select("context", "c", ((F.col("c") >= least) & (gain > F.col("d") * F.log("c") / 2)).alias("passes")), f"contexts-{size}")
        passing[size] = total[size].where("passes").select("context")
    out = grams[1].select(F.lit(1).alias("size"), "gram", "n")
    for size in range(depth + 1, 1, -1):
        kept = passing[size]
        if size <= depth:
            kept = kept.unionAll(above.select(_low("context", size - 1).alias("context"))).distinct()
        above = written(kept, f"kept-{size}")
        mine = grams[size].withColumn("context", context).join(above, "context", "left_semi")
        out = out.unionAll(mine.select(F.lit(size).alias("size"), "gram", "n"))
    return written(out, "suffix-tree")


class Model:
    """Counts of some states, and the probability of windows in their longest retained context."""

    def __init__(self, size: np.ndarray, gram: np.ndarray, n: np.ndarray, low: int = 0, high: int = 1 << 16):
        self.low, self.high = low, high
        self.orders = []
        for k in range(1, DEPTH + 2):
            own = size == k
            order = np.argsort(gram[own])
            grams, counts = gram[own][order], n[own][order]
            contexts, at = np.unique(grams >> 8, return_inverse=True)
            self.orders.append((grams, counts, contexts, np.bincount(at, counts, len(contexts)), np.bincount(at, minlength=len(contexts))))

    def log10(self, window: np.ndarray) -> np.ndarray:
        """For windows of this shard the logarithm of their last byte's probability, 0 for others."""
        out = np.zeros(len(window))
        bucket = (window >> 8) & 0xFFFF
        mine = np.flatnonzero((bucket >= self.low) & (bucket < self.high))
        window = window[mine]
        p = np.full(len(window), 1 / SYMBOLS)
        live = np.arange(len(window))
        for k, (grams, counts, contexts, total, followers) in enumerate(self.orders):
            gram = window[live] & ((1 << 8 * (k + 1)) - 1)
            at = np.searchsorted(contexts, gram >> 8)
            at[at == len(contexts)] = 0
            known = contexts[at] == gram >> 8 if len(contexts) else np.zeros(len(gram), bool)
            live, gram, at = live[known], gram[known], at[known]
            if not len(live):
                break  # the suffixes of a retained context are retained, so no longer one is either
            place = np.searchsorted(grams, gram)
            place[place == len(grams)] = 0
            seen = np.where(grams[place] == gram, counts[place], 0)
            p[live] = (seen + followers[at] * p[live]) / (total[at] + followers[at])
        out[mine] = np.log10(p)
        return out


def _scored(model: Model):
    """Adds to the score of rows (doc_id, text_hash, score, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = []
            for first, last in pieces(batch.column(3), PIECE_BYTES):
                data, offsets = normalised(batch.column(3).slice(first, last - first))
                found = pa.array(windows(data)).dictionary_encode()
                distinct = found.dictionary.to_numpy()
                order = np.argsort(distinct)  # neighbours are looked up near each other
                known = np.empty(len(distinct))
                known[order] = model.log10(distinct[order])
                each = known[found.indices.to_numpy()]
                starts = offsets[:-1] - np.arange(len(offsets) - 1) * DEPTH
                score.append(np.add.reduceat(each, starts))
            total = np.concatenate([*score, np.zeros(0)]) + batch.column(2).to_numpy()
            yield batch.set_column(2, "score", pa.array(total))

    return run


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by (chunk, row) of a batch of words (chunk, places, c)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        chunk, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
        places = batch.column(1).to_pylist()
        size = np.array([len(p) for p in places]) // 2
        rows = np.frombuffer(b"".join(places), "<u2").astype(np.int64)
        log = np.log10(batch.column(2).to_numpy() + 0.5)
        pair, inverse = np.unique(np.repeat(at, size) * CHUNK_ROWS + rows, return_inverse=True)
        columns = [chunk[pair // CHUNK_ROWS], (pair % CHUNK_ROWS).astype(np.int32), np.bincount(inverse), np.bincount(inverse, np.repeat(log, size))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "row", "known", "logs"])


def held_out(modulus: int = 5, remainder: int = 1) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def _shards(tree: DataFrame, entries: int) -> list[tuple[int, int]]:
    """Ranges of the last two context bytes with at most ``entries`` counts each, or one value."""
    bucket = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    sizes = tree.where("size > 2").groupBy(bucket.alias("bucket")).count().orderBy("bucket").collect()  # 65,536 rows at most
    cuts, now = [0], 0
    for r in sizes:
        if now and now + r["count"] > entries:
            cuts.append(r["bucket"])
            now = 0
        now += r["count"]
    return list(zip(cuts, [*cuts[1:], 1 << 16]))


def _model(tree: DataFrame, low: int, high: int) -> Model:
    bucket = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    rows = tree.where((F.col("size") <= 2) | ((bucket >= low) & (bucket < high))).toArrow()
    return Model(*(rows[c].to_numpy() for c in ("size", "gram", "n")), low, high)


def scores(docs: DataFrame, entries: int = MODEL_ENTRIES) -> DataFrame:
    """Log10 probabilities of every whole text of ``docs`` (doc_id, text), learned from those not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.  A null text counts as empty
    and has only its end token; a null doc_id has the crc32 of the empty text, which is not held out.  Every row is a
    document, repeated rows too, and has a row in the result.  Without training rows no token is known,
    base_score is 0 and score that of a uniform distribution over bytes.  Other columns are not used; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), (~held_out()).alias("train"), "text")

    path = new_path(spark, "gathered")
    rows.mapInArrow(_gathered, _GATHERED).write.partitionBy("kind").parquet(path)
    gathered = spark.read.schema(_GATHERED).parquet(path)

    words = gathered.where(F.col("kind") == _WORD)
    totals = written(words.groupBy("item").agg(F.sum("n").alias("c")).where("c > 0"), "word-counts")
    seen = totals.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = rows.where("train").count()
    train_tokens, distinct = seen["n"] + ends, seen["v"] + (ends > 0)

    found = words.select("item", "chunk", "places").join(totals, "item").select("chunk", "places", "c")
    sums = found.mapInArrow(_by_document, "chunk long, row int, known long, logs double").groupBy("chunk", "row").agg(F.sum("known").alias("known"), F.sum("logs").alias("logs"))
    listed = gathered.where(F.col("kind") == _DOC).select("chunk", "row", "doc_id", "text_hash", (F.col("n") + 1).alias("n_tokens")).join(sums, ["chunk", "row"], "left")
    # rows of equal doc_id and text have equal sums, so one of them stands for all
    base = listed.groupBy(F.col("doc_id").alias("base_id"), F.col("text_hash").alias("base_hash")).agg(F.max("n_tokens").alias("n_tokens"), F.max("known").alias("known"), F.max("logs").alias("logs"))

    longest = written(gathered.where(F.col("kind") == _WINDOW).groupBy(F.col("item").alias("gram")).agg(F.sum("n").alias("n")), "windows")
    tree = suffix_tree(longest)
    shards = _shards(tree, entries)
    scored = rows.select("doc_id", "text_hash", F.lit(0.0).alias("score"), "text")
    for i, shard in enumerate(shards):
        scored = scored.mapInArrow(_scored(_model(tree, *shard)), scored.schema)
        if i + 1 < len(shards):
            scored = written(scored, "scored")
    out = scored.select("doc_id", "text_hash", "score")
    out = out.join(base, out["doc_id"].eqNullSafe(base["base_id"]) & (out["text_hash"] == base["base_hash"]))
    known = F.coalesce("known", F.lit(0)).cast("long")
    all_known = known + (1 if ends else 0)
    unit = float(np.log10(train_tokens + 0.5 * (distinct + 1)))
    logs = F.coalesce("logs", F.lit(0.0)) + F.lit(float(np.log10(ends + 0.5))) + (F.col("n_tokens") - 1 - known) * F.lit(float(np.log10(0.5)))
    return out.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        all_known.alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        "score",
    )
