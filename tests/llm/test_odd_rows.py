"""Rows that earlier versions got wrong: gaps in turns, repeated ids, clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventlift.llm import quotes
from eventlift.llm.passages import repeated_passages
from eventlift.llm.ship import ship


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


def test_turns_with_gaps_follow_each_other(session):
    rows = [(1, t, "user", f"message {t}", 0) for t in (0, 2, 4, 5000, 5001, 90_000)] + [(2, 7, "user", "alone", 0), (2, 7, "user", "again", 0), (None, 1, "user", "x", 0), (3, None, "user", "y", 0)]
    frame = session.createDataFrame(rows, "conv_id long, turn long, role string, text string, turn_before int")
    got = {(r.conv_id, r.turn): r for r in quotes.reply_ordered(frame).collect()}
    assert [got[1, t].reply_turn for t in (0, 2, 4, 5000, 5001, 90_000)] == [None, 0, 2, 4, 5000, 5001]
    assert [got[1, t].depth for t in (0, 2, 4, 5000, 5001, 90_000)] == list(range(6))
    assert {got[1, t].thread_turn for t in (0, 2, 4, 5000, 5001, 90_000)} == {0}
    assert got[2, 7].reply_turn is None and got[3, None].depth == 0
    assert quotes.reply_ordered(frame.limit(0)).count() == 0


def test_turn_before_against_sorting(session):
    import random

    rng = random.Random(1)
    keys = sorted({(rng.randrange(4), rng.randrange(-3000, 6000)) for _ in range(600)})
    want = {k: (keys[i - 1][1] if i and keys[i - 1][0] == k[0] else None) for i, k in enumerate(keys)}
    got = quotes.turn_before(session.createDataFrame(keys, "conv_id long, turn long")).collect()
    assert {(r.conv_id, r.turn): r.turn_before for r in got} == want


def test_repeated_ids_give_no_false_passage(session):
    words = [f"w{i}" for i in range(90)]
    short, long, copy = " ".join(["a"] + words[60:80]), " ".join(["b", *words[:80]]), " ".join(words[:80])
    frame = session.createDataFrame([(1, short), (1, long), (2, copy)], "doc_id long, text string")
    assert repeated_passages(frame).collect() == []  # of document 1 the smaller text stands, 21 words
    found = repeated_passages(frame.where(F.col("text") != short)).collect()
    assert [(r.doc_id, r.of_doc_id, r.n_words, r.similarity) for r in found] == [(2, 1, 80, 1.0)]
    assert repeated_passages(frame.limit(0)).count() == 0


def test_language_stage_with_columns_of_its_own_names(session):
    docs = session.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = docs.select("*", F.lit("x").alias("lang_pred"), F.lit(0.5).alias("score"), F.lit(1).alias("others"), F.lit(2).alias("key"))
    odd = odd.unionByName(odd.limit(1).withColumn("text", F.lit(None).cast("string"))).unionByName(odd.limit(1).withColumn("text", F.lit("")))
    plain = corpus_pipeline.language_id(session, docs, "/root/testdata/sf0.001")
    got = corpus_pipeline.language_id(session, odd, "/root/testdata/sf0.001")
    assert got.columns == odd.columns and got.where("lang_pred = 'x' AND score = 0.5 AND others = 1 AND key = 2").count() == got.count()
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in plain.collect())
