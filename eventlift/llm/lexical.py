"""Ranked lexical search: accumulator-limited term-at-a-time evaluation over segments of documents.

Items are taken in blocks of bounded size.  For a block, one job counts the collection (documents,
terms, documents per query term) and a second one ranks.  A task of the second job inverts its documents
segment by segment: postings of the block's terms, sorted by term.  An item's terms are evaluated rarest
first into one accumulator a document.  Once the largest scores of the terms still to come add up to
less than the item's kth partial score, no further accumulator is created; those that exist are updated
to their exact scores.  The kth score of earlier segments of the task serves from the next one on.

Terms are compared by 64-bit hashes of their bytes.  Scores are 64-bit integers, so results do not
depend on the order of addition or on how documents are dealt to tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlift.llm.shingles import buffers, pieces, word_hashes
from eventlift.llm.tables import written

TOP = 50
#: Items are held by a task, so they come in blocks of at most so many rows and characters (or one item).
BLOCK_ITEMS, BLOCK_CHARS = 4096, 4_000_000
#: A segment is closed when it has so many postings.
SEGMENT_POSTINGS = 1_000_000
#: Groups of tasks whose results are merged before all are.
MERGES = 64

_NO_TERM = np.array([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TERMS = np.arange(256, dtype=np.uint8)
_TERMS[_NO_TERM] = 0x20
_LAST = np.int64(2**63 - 1)


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts in order, and the n + 1 offsets of the rows in them."""
    data, offsets = buffers(column)
    return word_hashes(_TERMS[data], offsets)


class Block:
    """Items and their distinct terms; a term's number is its place among the block's sorted hashes."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        hashes, at = term_hashes(pa.array([r[1] for r in rows], pa.string()))
        self.terms = np.unique(hashes)
        self.items = [np.unique(np.searchsorted(self.terms, hashes[a:b])) for a, b in zip(at[:-1], at[1:])]
        # most words of a text are no query terms: a bit table rules them out before the search
        self.shift = np.uint64(64 - max(16, min(26, 8 + int(len(self.terms)).bit_length())))
        self.maybe = np.zeros(1 << (64 - int(self.shift)), bool)
        self.maybe[self.terms >> self.shift] = True

    def postings(self, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term number, occurrences) of the block's terms in texts given by term_hashes."""
        place = np.flatnonzero(self.maybe[hashes >> self.shift])
        term = np.searchsorted(self.terms, hashes[place])
        term[term == len(self.terms)] = 0
        same = self.terms[term] == hashes[place] if len(self.terms) else np.zeros(0, bool)
        row = np.searchsorted(at, place[same], side="right") - 1
        pairs, tf = np.unique(row * np.int64(max(1, len(self.terms))) + term[same], return_counts=True)
        return (*np.divmod(pairs, max(1, len(self.terms))), tf)


def _counted(block: Block):
    """Rows (key, n): documents with a term under -1, terms under -2, documents of a query term under its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        having, total, df = 0, 0, np.zeros(len(block.terms), np.int64)
        for batch in batches:
            for first, last in pieces(batch.column(0)):
                hashes, at = term_hashes(batch.column(0).slice(first, last - first))
                having += int((np.diff(at) > 0).sum())
                total += len(hashes)
                df += np.bincount(block.postings(hashes, at)[1], minlength=len(df))
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append([-1, -2], found)), pa.array(np.append([having, total], df[found]))], names=["key", "n"])

    return run


class _Best:
    """The best documents of an item among those a task has seen, by descending score and ascending doc_id."""

    def __init__(self):
        self.score, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self, top: int) -> int:
        return int(self.score[-1]) if len(self.score) >= top else 0

    def add(self, score: np.ndarray, doc: np.ndarray, top: int) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[:top]
        self.score, self.doc = score[order], doc[order]


def evaluate(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, top: int, least: int = 0) -> tuple[np.ndarray, int]:
    """Scores of a segment's documents from (documents, scores) per term, rarest term first.

    Scores of documents that can be among the best ``top`` are exact; ``least`` is a score that a document
    must reach in any case.  Returns the scores and how many postings were passed over.
    """
    left = np.cumsum([int(s.max()) if len(s) else 0 for _, s in lists][::-1])[::-1]
    found, passed, creating = np.zeros(n_docs, np.int64), 0, True
    for (doc, score), most in zip(lists, left):
        if creating:
            now = found[found > 0]
            kth = max(least, int(np.partition(now, len(now) - top)[len(now) - top])) if len(now) >= top else least
            creating = most >= kth
        if not creating:
            known = found[doc] > 0
            passed += len(doc) - int(known.sum())
            doc, score = doc[known], score[known]
        found[doc] += score
    return found, passed


def _ranked(block: Block, having: int, total: int, df: np.ndarray, top: int):
    """Rows (item number, doc_id, score): the best documents of each item among those of a task."""
    weight = np.array([math.floor(1000 * math.log((2 * having + 2) / (2 * int(n) + 1))) if n else 0 for n in df], np.int64)
    rarest = [t[np.lexsort((t, df[t]))] for t in block.items]

    def segment(parts: list, best: list[_Best]) -> None:
        sizes = np.cumsum([0, *(len(p[0]) for p in parts)])
        ids, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        row = np.concatenate([p[2] + s for p, s in zip(parts, sizes)])
        term, tf = (np.concatenate([p[i] for p in parts]) for i in (3, 4))
        order = np.argsort(term, kind="stable")
        row, term, tf = row[order], term[order], tf[order].astype(np.int64)
        m = 100 - 50 + (50 * n * np.int64(having)) // max(1, total)
        score = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
        start = np.searchsorted(term, np.arange(len(df) + 1))
        for terms, own in zip(rarest, best):
            least = own.least(top)
            found, _ = evaluate([(row[a:b], score[a:b]) for a, b in zip(start[terms], start[terms + 1])], len(ids), top, least)
            hit = np.flatnonzero(found >= max(1, least))
            if len(hit) > top:
                kth = np.partition(found[hit], len(hit) - top)[len(hit) - top]
                hit = hit[found[hit] >= kth]
            if len(hit):
                own.add(found[hit], ids[hit], top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, parts, waiting = [_Best() for _ in block.items], [], 0
        for batch in batches:
            for first, last in pieces(batch.column(1)):
                hashes, at = term_hashes(batch.column(1).slice(first, last - first))
                ids = batch.column(0).slice(first, last - first).fill_null(int(_LAST)).to_numpy()
                parts.append((ids, np.diff(at), *block.postings(hashes, at)))
                waiting += len(parts[-1][2])
                if waiting >= SEGMENT_POSTINGS:
                    segment(parts, best)
                    parts, waiting = [], 0
        if parts:
            segment(parts, best)
        item = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        doc = np.concatenate([*(b.doc for b in best), np.zeros(0, np.int64)])
        score = np.concatenate([*(b.score for b in best), np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int64)), pa.array(doc, mask=doc == _LAST), pa.array(score)], names=["item", "doc_id", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[Block]:
    rows, chars = [], 0
    for row in items.toLocalIterator():
        if rows and (len(rows) >= BLOCK_ITEMS or chars + len(row[1] or "") > BLOCK_CHARS):
            yield Block(rows)
            rows, chars = [], 0
        rows.append(tuple(row))
        chars += len(row[1] or "")
    if rows:
        yield Block(rows)


def _best_rows(found: DataFrame, by: list[str], top: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= top)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0, over all of ``docs``.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not used.  A null text has no
    term: such an item gives no row, such a document is not counted.  Every row is a document of its own, and
    every row of ``items`` an item of its own, also with a repeated or null id.  Equal scores go by
    ascending doc_id, null last.  Items without any matching document, and empty tables, give no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    done = None
    for block in _blocks(items.select("item_id", F.col("text").cast("string").alias("text"))):
        counted = texts.select("text").mapInArrow(_counted(block), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        n = {r["key"]: r["n"] for r in counted.collect()}  # a row a term of the block
        df = np.array([n.get(i, 0) for i in range(len(block.terms))], np.int64)
        rows = texts.mapInArrow(_ranked(block, n.get(-1, 0), n.get(-2, 0), df, top), "item long, doc_id long, score long")
        some = _best_rows(rows.withColumn("part", F.spark_partition_id() % MERGES), ["item", "part"], top, "i").drop("i", "part")
        best = _best_rows(some, ["item"], top, "rank")
        numbers = spark.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {dict(items.dtypes)['item_id']}")
        found = written(best.join(numbers, "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        done = found if done is None else done.unionByName(found)
    if done is None:
        return spark.createDataFrame([], f"item_id {dict(items.dtypes)['item_id']}, rank int, doc_id long, score long")
    return done


#: The same ranking by plain joins, for DuckDB.
RANKED_SQL = r"""
WITH words AS (
    SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), counts AS (
    SELECT count(DISTINCT r) AS docs, count(*) AS terms FROM words
), lengths AS (
    SELECT r, count(*) AS n FROM words GROUP BY r
), tfs AS (
    SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY r, doc_id, term
), dfs AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, counts GROUP BY term
), asked AS (
    SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)
), scored AS (
    SELECT item, item_id, doc_id, r,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
    FROM asked JOIN tfs USING (term) JOIN dfs USING (term) JOIN lengths USING (r), counts
    GROUP BY item, item_id, doc_id, r
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 50
"""
