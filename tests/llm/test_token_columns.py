"""Token ids of whole columns against the library, and what a worker keeps from task to task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from eventlift.llm import token_files
from eventlift.llm.queries import byte_bpe

TEXTS = ["", " ", "  a", "a  b", "a b ", "a\n b", "a \n", "x y", "été là, ça.", "a\tb c", "don't we'll x", "日本 語!!", "<|endoftext|> a", "a\x1c b", "a\x85 b", "a\xa0 b", "the 42nd A.B ,x", "the the, the.", "the"]


def test_columns_have_the_ids_of_the_library():
    encoder = token_files.Encoder(byte_bpe())
    for texts in (TEXTS, TEXTS[7:8], TEXTS[:1], [], TEXTS[::-1]):
        ids, lengths = encoder.column(pa.array(texts, pa.string()))
        wanted = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
        assert lengths.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]
    # a slice of a longer column
    ids, lengths = encoder.column(pa.array(TEXTS, pa.string()).slice(7, 4))
    assert np.split(ids, np.cumsum(lengths)[:-1])[1].tolist() == encoder.library.encode(TEXTS[8], add_special_tokens=False).ids


def test_tasks_of_a_worker_share_an_encoder():
    path = byte_bpe()
    for _ in range(2):  # each task has a copy of its function
        copied = cloudpickle.loads(cloudpickle.dumps(token_files._writer(path)))
        assert copied.__globals__["encoder"] is token_files.encoder and "_encoders" not in copied.__globals__
    assert token_files.encoder(path) is token_files.encoder(path)
