"""Language by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is parsed greedily: a
phrase is the longest match that the automaton can follow, and the next phrase starts where it
fails.  A language whose text resembles this one needs few, long phrases; with ``c`` phrases over
``n`` symbols and ``m`` symbols of labelled text, ``c log2(m) / n`` estimates the cross entropy,
and the language with the lowest wins.

Texts are lower-cased; a run of anything but letters is one separator.  They are parsed in blocks
of ``BLOCK`` symbols, all blocks of a batch in step, on automata laid out as tables; a phrase
ends at the end of its block.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlift.llm.shingles import pieces
from eventlift.llm.worker import lean

#: The labelled sample a language is learned from: so many rows, so many symbols of each.
SAMPLE_ROWS, SAMPLE_SYMBOLS = 128, 256
BLOCK = 512
#: Symbols of a table row: separator, end of a sample row, unknown letter, and the commonest letters.
SYMBOLS = 64
SEPARATOR, STOP, UNKNOWN = 0, 1, 2
UNDETERMINED = "und"

_letters: list[np.ndarray] = []
_models: dict[str, Model] = {}


def _lower_letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    if not _letters:
        out = np.zeros(0x110000, np.int32)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()
                out[c] = ord(low) if len(low) == 1 else c
        _letters.append(out)
    return _letters[0]


def letters_of(text: str) -> np.ndarray:
    """Lower-case letters of a text, with a 0 for every run of other characters."""
    found = _lower_letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    if not len(found):
        return found
    return found[np.append(True, (found[1:] != 0) | (found[:-1] != 0))]


def suffix_automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the root, and every substring can be followed from it."""
    to: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols.tolist():
        new = len(to)
        to.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = new
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(to)
                to.append(dict(to[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return to


class Model:
    """Automata of all languages and the letters they know."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        rows = {k: [letters_of(t) for t in v] for k, v in samples.items()}
        counts: Counter = Counter()
        for own in rows.values():
            for r in own:
                counts.update(r[r != 0].tolist())
        known = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: SYMBOLS - 3]]
        self.symbol = np.full(0x110000, UNKNOWN, np.uint8)
        self.symbol[0] = SEPARATOR
        self.symbol[known] = np.arange(3, 3 + len(known))
        self.tables, self.weight = [], []
        for language in self.languages:
            stop = np.array([STOP], np.uint8)
            sample = np.concatenate([stop, *(x for r in rows[language] for x in (self.symbol[r[:SAMPLE_SYMBOLS]], stop))])
            self.tables.append(self._laid_out(suffix_automaton(sample)))
            self.weight.append(np.log2(max(2, len(sample))))

    @staticmethod
    def _laid_out(to: list[dict[int, int]]) -> np.ndarray:
        """Next place for each state and symbol; places are multiples of SYMBOLS, odd where a phrase ends."""
        out = np.zeros((len(to), SYMBOLS), np.int32)
        for state, row in enumerate(to):
            for c, target in row.items():
                out[state, c] = target * SYMBOLS
        out[:, [STOP, UNKNOWN]] = 0
        out[0][out[0] == 0] = 1
        root = out[0] | 1
        missing = out == 0
        missing[0] = False
        out[missing] = np.broadcast_to(root, out.shape)[missing]
        return out.ravel()

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        found = [letters_of(t) for t in texts]
        sizes = np.array([len(f) for f in found], np.int64)
        every = self.symbol[np.concatenate([*found, np.zeros(0, np.int32)])]
        number = -(-sizes // BLOCK)
        row = np.repeat(np.arange(len(texts)), number)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
        start = np.repeat(np.cumsum(sizes) - sizes, number) + inner * BLOCK
        length = np.minimum(np.repeat(sizes, number) - inner * BLOCK, BLOCK)
        order = np.argsort(-length, kind="stable")
        start, length, row = start[order], length[order], row[order]
        going = np.searchsorted(-length, -np.arange(1, BLOCK + 1), side="right")
        state = [np.zeros(len(start), np.int32) for _ in self.languages]
        phrases = [np.zeros(len(start), np.int32) for _ in self.languages]
        for step, k in enumerate(going):
            if not k:
                break
            symbols = every[start[:k] + step]
            for table, at, ended in zip(self.tables, state, phrases):
                place = at[:k] + symbols
                place = table[place]
                odd = place & 1
                ended[:k] += odd
                np.subtract(place, odd, out=at[:k])
        rates = np.array([np.bincount(row, weights=p + 1, minlength=len(texts)) * w for p, w in zip(phrases, self.weight)]) / np.maximum(sizes, 1)
        best = rates.argmin(axis=0)
        order = np.sort(rates, axis=0)
        score = 1 - order[0] / np.maximum(order[min(1, len(rates) - 1)], 1e-9) if len(rates) > 1 else np.ones(len(texts))
        blank = [not (f != 0).any() for f in found]
        return (
            [UNDETERMINED if b else self.languages[i] for i, b in zip(best, blank)],
            [0.0 if b else float(min(1.0, max(0.0, s))) for s, b in zip(score, blank)],
        )


def sample_rows(labelled: DataFrame) -> DataFrame:
    """(lang, text): ``SAMPLE_ROWS`` rows of each language of (key, lang, text), chosen by a hash of the key."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key", "text")
    rows = labelled.where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    return rows.withColumn("i", F.row_number().over(order)).where(F.col("i") <= SAMPLE_ROWS).select("lang", F.substring("text", 1, 8 * SAMPLE_SYMBOLS).alias("text"))


def _predictor(samples: dict[str, list[str]]):
    name = hashlib.sha1(repr(sorted(samples.items())).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _models:
            _models.clear()
            _models[name] = Model(samples)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            langs, scores = [], []
            for first, last in pieces(text, 8_000_000):
                part = _models[name].predict(text.slice(first, last - first).fill_null("").to_pylist())
                langs, scores = langs + part[0], scores + part[1]
            yield batch.append_column("lang_pred", pa.array(langs, pa.string())).append_column("score", pa.array(scores, pa.float64()))

    return run


def predict_language(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, learned from a bounded sample of ``labelled`` (key, lang, text).

    Only the text of a row is used for it.  ``lang_pred`` is a learned language, or ``und`` with score
    0 where the text is null or has no letter, or nothing could be learned; score is one less the
    ratio of the lowest to the second lowest entropy (1 with a single language).  Ties go to
    the language first in order.  ``docs`` must not have columns of those names.
    """
    samples: dict[str, list[str]] = {}
    for lang, text in sorted(sample_rows(labelled).collect()):  # bounded: SAMPLE_ROWS a language
        samples.setdefault(lang, []).append(text)
    if not samples:
        return docs.withColumn("lang_pred", F.lit(UNDETERMINED)).withColumn("score", F.lit(0.0))
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(lean(_predictor(samples)), schema)
