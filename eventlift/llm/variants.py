"""Spelling variants: words one edit apart, by dense prefix-suffix tiling.

Two words differ by a single inserted, deleted or replaced code point exactly if the lengths of their
common prefix and common suffix together reach the longer length less one.  Which words are compared is
decided by windows: a pair of lengths (l, l) or (l, l + 1) whose edit lies in a window of places has
everything outside that window in common.  A word therefore gets a key for every window of its
length as the shorter and as the longer word, at most ``2 * WINDOWS + 2``, and all pairs one edit apart share a
key.  The words of a key form blocks of about ``TILE`` words; each pair of blocks is one tile, and
tiles are spread over tasks, so a key with many words is no single task.  In a tile, code points stand in padded
matrices, from the left and from the right, and rows are compared densely.  A pair is taken only
in the window of its first differing place, so it comes once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlift.llm.tables import width, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One in so many (document, run) pairs loses a code point.
EDITED = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A window has three places, or more where a word would otherwise have more than ``WINDOWS`` windows.
PLACES, WINDOWS = 3, 8
TILE = 256
#: Distinct words that a task counts before it passes them on, and bytes of a slice of compared rows.
FLUSH, SLICE_BYTES = 500_000, 8_000_000


def changed(prefix: int, run: bytes) -> bytes:
    """The lower-cased run (Latin-1 bytes) of a document whose ``<doc_id>:`` has the crc32 ``prefix``, with its edit."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % EDITED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def out() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            runs: Counter = Counter()
            for run, n in Counter(RUN.findall(text.as_py() or "")).items():
                runs[run.encode("latin-1").lower()] += n
            for run, n in runs.items():
                word = changed(prefix, run)
                if len(word) >= LEAST_LENGTH:
                    total[word] += n
            if len(total) >= FLUSH:
                yield out()
                total.clear()
    yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least five code points with three or more occurrences, after the edits."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.where("text IS NOT NULL").mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def places(length):
    """Places of a window for a shorter length; the same rule for columns and numbers."""
    if isinstance(length, Column):
        return F.greatest(F.lit(PLACES), F.ceil((length + 1) / WINDOWS).cast("int"))
    return np.maximum(PLACES, -(-(length + 1) // WINDOWS))


def keyed(words: DataFrame) -> DataFrame:
    """A row for each word and window: key, number of the window, whether the word is the longer one."""

    def windows(longer: int) -> Column:
        short = F.length("word") - longer
        return F.transform(
            F.sequence(F.lit(0), F.floor(short / places(short)).cast("int")),
            lambda s: F.struct(s.alias("window"), F.lit(longer).alias("longer"), short.alias("short")),
        )

    rows = words.select("word", "n", F.explode(F.concat(windows(0), windows(1))).alias("w")).select("word", "n", "w.*")
    start = F.col("window") * places(F.col("short"))
    before = F.substring("word", F.lit(1), start)
    after = F.expr("right(word, short - start - places)")
    rows = rows.withColumns({"start": start, "places": places(F.col("short"))})
    return rows.select(F.xxhash64("short", "window", before, after).alias("key"), "window", "longer", "word", "n")


def _matrices(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and code points padded with zeros on the right and on the left."""
    lengths = np.array([len(w) for w in words], np.int64)
    place = np.arange(lengths.max(initial=0))
    points = np.frombuffer(b"".join(words), np.uint8)
    left, right = np.zeros((2, len(words), len(place)), np.uint8)
    left[place < lengths[:, None]] = points
    right[place >= len(place) - lengths[:, None]] = points
    return lengths, left, right


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each two rows."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def single_edits(words: list[bytes], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows: whether one edit apart, and the first differing place."""
    lengths, left, right = _matrices(words)
    near, place = np.zeros(len(i), bool), np.zeros(len(i), np.int64)
    step = max(1, SLICE_BYTES // max(1, left.shape[1]))
    for at in range(0, len(i), step):
        a, b = i[at : at + step], j[at : at + step]
        short, long = np.minimum(lengths[a], lengths[b]), np.maximum(lengths[a], lengths[b])
        prefix = np.minimum(_common(left[a], left[b]), short)
        suffix = np.minimum(_common(right[a, ::-1], right[b, ::-1]), short)
        near[at : at + step] = (long - short <= 1) & (prefix < long) & (prefix + suffix >= long - 1)
        place[at : at + step] = prefix
    return near, place


def _compared(columns: dict) -> Iterator[pa.RecordBatch]:
    """Near pairs of whole tiles, in both directions."""
    words = [w.encode("latin-1") for w in columns["word"].to_pylist()]
    n, window, longer, own = (columns[c].to_numpy() for c in ("n", "window", "longer", "own"))
    tile = [columns[c].to_numpy() for c in ("key", "low", "high")]
    new = np.append(True, np.logical_or.reduce([t[1:] != t[:-1] for t in tile]))
    group = np.cumsum(new)
    across = tile[1] != tile[2]
    length = np.array([len(w) for w in words], np.int64)
    size = np.bincount(group).max(initial=0)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    i, j, waiting = [], [], 0

    def compare() -> None:
        a, b = np.concatenate(i), np.concatenate(j)
        near, place = single_edits(words, a, b)
        near &= place // places(np.minimum(length[a], length[b])) == window[a]
        found.append((a[near], b[near]))

    for d in range(1, size):
        a = np.flatnonzero(group[d:] == group[:-d])
        b = a + d
        # two longer words of a key meet again where both are the shorter; rows of one block meet in their own tile
        fit = (longer[a] + longer[b] < 2) & (window[a] == window[b]) & (~across[a] | (own[a] != own[b]))
        i, j, waiting = [*i, a[fit]], [*j, b[fit]], waiting + int(fit.sum())
        if waiting >= 1_000_000:
            compare()
            i, j, waiting = [], [], 0
    if waiting:
        compare()
    for a, b in found:
        for x, y in ((a, b), (b, a)):
            take = columns["word"].take
            yield pa.RecordBatch.from_arrays([take(pa.array(x)), take(pa.array(y)), pa.array(n[y])], names=["word", "other", "other_n"])


_COLUMNS = ["key", "low", "high", "own", "window", "longer", "word", "n"]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in tile order; the last tile of a batch waits for the next batch."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        rest.append(batch)
        table = pa.Table.from_batches(rest).combine_chunks()
        same = np.ones(len(table), bool)
        for c in ("key", "low", "high"):
            column = table[c].to_numpy()
            same &= column == column[-1] if len(column) else same
        whole = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if whole:
            yield from _compared({c: table[c].slice(0, whole).combine_chunks() for c in _COLUMNS})
            rest = table.slice(whole).to_batches()
    if rest and sum(len(b) for b in rest):
        table = pa.Table.from_batches(rest).combine_chunks()
        yield from _compared({c: table[c].combine_chunks() for c in _COLUMNS})


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, other, other_n) for every two words one edit apart, in both directions.  ``words`` has distinct words and n."""
    rows = written(keyed(words), "variant-keys")
    blocks = F.ceil(F.col("count") / tile).cast("int")
    sizes = rows.groupBy("key").count().where("count > 1").select("key", blocks.alias("blocks"))
    dealt = rows.join(sizes, "key").withColumn("own", F.pmod(F.hash("word"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).select(*_COLUMNS)
    order = ["key", "low", "high"]
    dealt = dealt.repartition(width(words.sparkSession), *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(_tiles, "word string, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each chain, by pointer jumping.

    A form has at least twice the occurrences of its word, so chains have no cycles and are at most as long
    as the logarithm of the largest count; each round halves them.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(now.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        now = step.drop("moved")
        if step.where("moved").limit(1).count() == 0:
            return now


def spelling_groups(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary of ``docs`` (doc_id, text).

    ``form`` is the near word of largest n (ties: smallest in code-point order) where that n is at least twice the
    word's, else null; ``root`` the end of the chain of forms.  Null and empty texts have no words; a null
    doc_id counts as empty text in the edit rule; repeated rows count as often as they stand; other columns
    are not used.  An empty table gives no rows.  A word's keys are bounded whatever its length.
    """
    words = written(vocabulary(docs), "vocabulary")
    near = near_words(words)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    grouped = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(grouped, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n"))
    fits = F.col("form_n") >= 2 * F.col("n")
    known = written(known.withColumns({"form": F.when(fits, F.col("form")), "form_n": F.when(fits, F.col("form_n"))}), "variants")
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same groups from deletion neighbourhoods, for DuckDB; crc32 is computed byte by byte from its table.
GROUPS_SQL = r"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
), bytes AS (
    SELECT run, doc_id, k, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b
    FROM runs
), hashed AS (
    SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) AS h
    FROM bytes, crc
), words AS (
    SELECT word, sum(k)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, k FROM hashed
    ) WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), cuts AS (
    SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
    UNION
    SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word
), best AS (
    SELECT word, other, other_n, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS i,
        count(*) OVER (PARTITION BY word) AS n_near FROM near
), known AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
        CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word AND i = 1
), chain AS (
    SELECT word, word AS root, form FROM known
    UNION ALL
    SELECT c.word, k.word, k.form FROM chain c JOIN known k ON c.form = k.word
)
SELECT k.word, k.form, c.root, k.n, k.n_near::BIGINT AS n_near, k.form_n
FROM known k JOIN chain c ON k.word = c.word AND c.form IS NULL
"""
