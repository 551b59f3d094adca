"""Token-id files: texts as token ids in Simple-8b blocks, in ascending document order.

A file is a table whose rows are documents: ``part`` (the file's number in the order),
``doc_id``, ``start`` (ids of the file before it), ``n_tokens``, ``words`` (little-endian
64-bit words) and ``blocks`` (little-endian 32-bit: the word at which each block of ``BLOCK`` ids
starts), so a reader decodes any block alone and all blocks of a batch at once.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlift.llm import simple8b
from eventlift.llm.shingles import pieces
from eventlift.llm.tables import batch_rows, new_path, width
from eventlift.llm.worker import lean

#: Ends a document.
END = 0
#: Distinct text pieces, and matches in them, whose ids a worker remembers.
PIECES, MATCHES = 100_000, 300_000
#: Bytes of text that are encoded at once, or one document.
PIECE_BYTES = 4_000_000
#: Rows of an incoming batch, as a task holds the texts of one twice.
BATCH_ROWS = 1000
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]
_CUT = regex.compile(r"(?<=\S) (?=\S)")

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """A worker's own encoder, which keeps what it remembers from task to task.

    A task's function is copied with the globals it names, so it must not name ``_encoders`` itself.
    """
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _cut(text: str) -> list[str]:
    """The text cut at each space between two characters that are not white space."""
    plain = text.split(" ")
    if "" in plain or any(w in text and (w + " " in text or " " + w in text) for w in _WHITE):
        return _CUT.split(text)
    return plain


def _spelt(text: str) -> str:
    """For Arrow's regular expressions, every character by its number."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


class Known(dict):
    """Ids by text, worked out where a text is new."""

    def __init__(self, work):
        self.work = work

    def __missing__(self, text: str) -> bytes:
        found = self[text] = self.work(text)
        return found


class Encoder:
    """Ids of whole texts by a byte-level tokenizer.

    Its split pattern takes no match over a space between two characters that are not white
    space, and each match is encoded on its own.  So texts are cut at such spaces; pieces and
    matches met before take their ids from memory, and new matches go through the library's
    model in its own byte alphabet.  Texts with an added token, and all texts of tokenizers of other
    kinds, are given to the library whole.
    """

    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        splitter, self.model = self.library.pre_tokenizer, self.library.model
        self.other_kind = not isinstance(splitter, ByteLevel) or splitter.add_prefix_space or not splitter.use_regex or self.library.normalizer is not None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        letters = sorted(ByteLevel.alphabet())
        own = {ord(c) for c in letters if ord(c) < 256}
        others = iter(sorted(ord(c) for c in letters if ord(c) >= 256))
        self.alphabet = {b: b if b in own else next(others) for b in range(256)}
        self.space = chr(self.alphabet[0x20])
        white = f"[{_spelt(''.join(_WHITE))}]"
        self.odd = "|".join([f"{white} ", f" {white}", "^ ", " $", *map(_spelt, self.added)])
        self.of_match = Known(self._match)
        self.of_piece = Known(lambda text: self._piece(" ", text) if text else b"")
        self.of_head = Known(lambda text: self._piece("", text))

    def _match(self, text: str) -> bytes:
        if text.isascii() and text.isprintable():
            spelt = text.replace(" ", self.space)
        else:
            spelt = text.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _piece(self, lead: str, text: str) -> bytes:
        word = text.rstrip(_MARKS)
        if word.isalpha():  # letters, then marks only: two matches
            ids = self.of_match[lead + word]
            return ids + self.of_match[text[len(word) :]] if len(word) < len(text) else ids
        return b"".join([self.of_match[m] for m in self.pattern.findall(lead + text)])

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _forget(self) -> None:
        for known, most in ((self.of_piece, PIECES), (self.of_head, PIECES), (self.of_match, MATCHES)):
            if len(known) > most:
                known.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        self._forget()
        return [self.whole(t) if self.other_kind or any(a in t for a in self.added) else self._joined(_cut(t)) for t in texts]

    def _joined(self, cut: list[str]) -> bytes:
        head, cut[0] = cut[0], ""
        return self.of_head[head] + b"".join(map(self.of_piece.__getitem__, cut))

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column without nulls, one after the other, and the number of each text's.

        Texts in which every space is between two other characters are cut by Arrow, and each distinct piece of them is
        looked up once.  The others go one by one.
        """
        odd = np.ones(len(texts), bool) if self.other_kind else pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._plain(texts)
        ids, lengths = self._plain(texts.filter(pa.array(~odd)))
        parts = iter(np.split(ids, np.cumsum(lengths)[:-1]))
        others = iter(self.encode(texts.filter(pa.array(odd)).to_pylist()))
        each = [np.frombuffer(next(others), "<u4") if x else next(parts) for x in odd]
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._forget()
        lists = pc.split_pattern(texts, " ")
        words, first = lists.flatten(), lists.offsets.to_numpy()[:-1]
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy()
        found, two = self._pieces(coded.dictionary)
        # a text's first piece has no space before it
        heads = len(found) + np.arange(len(first))
        found += map(self.of_head.__getitem__, words.take(pa.array(first)).to_numpy(zero_copy_only=False).tolist())
        parts = two[code]
        parts[first] = np.stack([heads, np.zeros(len(first), np.int64)], axis=1)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start = np.cumsum(size) - size
        number = size[parts].ravel()
        place = np.arange(int(number.sum())) + np.repeat(start[parts].ravel() - (np.cumsum(number) - number), number)
        return np.frombuffer(b"".join(found), "<u4")[place], np.add.reduceat(number, 2 * first)

    def _pieces(self, distinct: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of matches and pieces, none at first, and the two of them that make each of the distinct pieces after a space.

        A piece of letters, then marks only, is two matches, which many pieces share.
        """
        words = pc.utf8_rtrim(distinct, characters=_MARKS)
        plain = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        rows, chosen = np.flatnonzero(plain), pa.array(plain)
        two = np.zeros((len(distinct), 2), np.int64)
        found = [b""]
        words, whole = words.filter(chosen), distinct.filter(chosen)
        own = words.dictionary_encode()
        two[rows, 0] = 1 + own.indices.to_numpy()
        found += [self.of_match[" " + w] for w in own.dictionary.to_numpy(zero_copy_only=False).tolist()]
        marked = pc.not_equal(words, whole)
        both = (x.filter(marked).to_numpy(zero_copy_only=False).tolist() for x in (whole, words))
        ends = [t[len(w) :] for t, w in zip(*both)]
        kinds = {m: len(found) + i for i, m in enumerate(dict.fromkeys(ends))}
        found += map(self.of_match.__getitem__, kinds)
        two[rows[marked.to_numpy(zero_copy_only=False)], 1] = [kinds[m] for m in ends]
        rest = distinct.filter(pc.invert(chosen)).to_numpy(zero_copy_only=False).tolist()
        two[~plain, 0] = len(found) + np.arange(len(rest))
        found += map(self.of_piece.__getitem__, rest)
        return found, two


def _writer(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            text = batch.column(1).fill_null("")
            for first, last in pieces(text, PIECE_BYTES):
                ids, lengths = known.column(text.slice(first, last - first))
                ids, lengths = np.insert(ids, np.cumsum(lengths), END), lengths + 1
                starts, sizes = simple8b.block_starts(lengths)
                words, offsets = simple8b.encode(ids, starts, sizes)
                number = -(-lengths // simple8b.BLOCK)
                rows = np.concatenate([[0], np.cumsum(number)])
                stored = words.astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(last - first, part, np.int32)),
                        batch.column(0).slice(first, last - first),
                        pa.array(start + np.cumsum(lengths) - lengths),
                        pa.array(lengths),
                        pa.array([stored[8 * offsets[a] : 8 * offsets[b]] for a, b in zip(rows, rows[1:])], pa.binary()),
                        pa.array([(offsets[a:b] - offsets[a]).astype("<u4").tobytes() for a, b in zip(rows, rows[1:])], pa.binary()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "words", "blocks"],
                )
                start += int(lengths.sum())

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the ids of every whole text of ``docs`` (doc_id, text; others are ignored).

    A null text counts as empty; every document ends with id 0.  Rows without doc_id come
    first; equal doc_ids stay together in order of their texts.  An empty table gives an empty
    file set.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange(width(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    with batch_rows(spark, BATCH_ROWS):
        rows.mapInArrow(lean(_writer(tokenizer)), "part int, doc_id long, start long, n_tokens long, words binary, blocks binary").write.parquet(path)


def decode_rows(words: pa.Array, blocks: pa.Array, lengths: np.ndarray) -> list[np.ndarray]:
    """Ids of each document of a batch of file rows."""
    data = [w.as_buffer() for w in words]
    offsets = [np.frombuffer(b.as_buffer(), "<u4").astype(np.int64) for b in blocks]
    base = np.concatenate([[0], np.cumsum([len(d) // 8 for d in data])])
    _, sizes = simple8b.block_starts(lengths)
    at = np.concatenate([*(o + b for o, b in zip(offsets, base)), base[-1:]])
    values = simple8b.decode(np.frombuffer(b"".join(data), "<u8").astype(np.uint64), at, sizes)
    return np.split(values, np.cumsum(lengths)[:-1])


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch.column(3).to_numpy()
        crc = []
        total = np.cumsum(lengths)
        first = 0
        while first < len(lengths):
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + 2_000_000, side="right")))
            ids = decode_rows(batch.column(4).slice(first, last - first), batch.column(5).slice(first, last - first), lengths[first:last])
            crc += [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
            first = last
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())], names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded ids of the files."""
    files = spark.read.schema("part int, doc_id long, start long, n_tokens long, words binary, blocks binary").parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))  # a row a file
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead"))
    rows = files.mapInArrow(_reader, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return rows.join(offsets, "part").select("doc_id", (F.col("start") + F.col("ahead")).alias("start"), "n_tokens", "ids_crc32")


def token_index(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    path = new_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer)
    return read_token_index(docs.sparkSession, path)
