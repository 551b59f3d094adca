"""The join moves texts twice whatever it finds, deletes its tables, and keeps apart texts of one doc_id."""

from __future__ import annotations

import os

import pytest

from eventlift.llm import jaccard
from eventlift.llm.jaccard import jaccard_components
from eventlift.llm.ship import ship
from eventlift.llm.tables import shared_folder


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


def chain(words: list[str], n: int) -> list[str]:
    """Texts of which each has one more word exchanged than the one before."""
    return [" ".join([*(f"{w}x" for w in words[:i]), *words[i:]]) for i in range(n)]


def test_texts_are_moved_twice_and_lists_deleted(session, monkeypatch):
    asked = []
    verifier = jaccard._verifier
    monkeypatch.setattr(jaccard, "_verifier", lambda *a: asked.append(a) or verifier(*a))
    before = set(os.listdir(shared_folder(session).removeprefix("file://")))
    words = [f"w{i}" for i in range(120)]
    rows = list(enumerate([*chain(words, 30), " ".join(words[60:] + [f"z{i}" for i in range(90)])]))
    got = {r.doc_id: r.component_id for r in jaccard_components(session.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict.fromkeys(range(30), 0), 30: 30}
    assert len(asked) == 2
    left = set(os.listdir(shared_folder(session).removeprefix("file://"))) - before
    assert not [x for x in left if x.startswith(("jaccard-lists", "jaccard-split", "jaccard-stars"))]
    assert session.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_two_texts_of_one_doc_id(session):
    one, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    near = [t.rsplit(" ", 1)[0] for t in (one, other)]
    # 5 has both texts, each near to another document's; nothing links those two but the doc_id
    rows = [(5, one), (5, other), (5, other), (6, near[0]), (7, near[1]), (None, one), (None, one)]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_components(session.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("5", 36, 5), ("5", 36, 5), ("5", 36, 5), ("6", 35, 5), ("7", 35, 5), ("None", 36, 5), ("None", 36, 5)]
