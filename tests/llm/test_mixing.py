"""Mixing: the classifier on labels it has not seen, the solver against a dense solution, attained targets, odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventlift.llm import mixing, queries
from eventlift.llm.ship import ship

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def session(spark):
    ship(spark)
    return spark


def test_targets_are_attained_on_the_labelled_table(session):
    got = queries.op10_mixing(session, SF).cache()
    first = got.first()
    assert got.count() == session.read.parquet(f"{SF}/documents.parquet").count()
    assert first.targets == pytest.approx([0.9, 0.1, 0.0])
    assert max(abs(a - t) for a, t in zip(first.attained, first.targets)) < 0.02 + 0.001
    labels = mixing.domains(session.read.parquet(f"{SF}/labels.parquet"))
    low = {r.domain: r.low for r in got.join(labels, "doc_id").groupBy("domain").agg(F.avg((F.col("rate") < 0.5).cast("int")).alias("low")).collect()}
    assert low["clean"] < 0.02 and low["toxic"] > 0.5


def test_posteriors_of_unseen_labels_beat_the_prior(session):
    docs = session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = mixing.domains(session.read.parquet(f"{SF}/labels.parquet"))
    unseen = F.pmod(F.xxhash64("doc_id", F.lit("unseen")), F.lit(4)) == 0
    model = mixing.learn(docs, labels.where(~unseen))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("mix_hash"), mixing.tokens(F.col("text")).alias("mix_tokens"), "text")
    rows = mixing.posteriors(keyed, model).join(labels.where(unseen), "doc_id").collect()
    at = [model.names.index(r.domain) for r in rows]
    loss = -sum(math.log(r.mix_posteriors[i]) for r, i in zip(rows, at)) / len(rows)
    prior = -sum(math.log(model.prior[i]) for i in at) / len(rows)
    assert len(rows) > 50 and loss < 0.7 * prior
    assert all(abs(sum(r.mix_posteriors) - 1) < 1e-5 for r in rows)


@pytest.mark.parametrize("most", [None, 1.0])
def test_solver_against_a_dense_solution(session, most):
    rng = np.random.default_rng(4)
    p, n = rng.dirichlet([0.3, 0.3, 0.3], 80), rng.integers(1, 500, 80)
    weights = np.array([0.7, 0.2, 0.1])
    cells = session.createDataFrame([(x.tolist(), int(y)) for x, y in zip(p, n)], "p array<double>, n long")
    pushes, step = mixing.fit(cells, weights.tolist(), steps=150, most=most)
    got = np.array([r.x for r in cells.select(mixing.rate(F.col("p"), pushes, step, mixing.PULL, most).alias("x")).collect()])
    w = n / n.sum()
    target = weights * (w @ p)[0] / weights[0]
    scale = 1 / (w @ (p * p))
    cut = np.inf if most is None else most

    def loss(x):
        return 0.5 * (scale * (w * x @ p - target) ** 2).sum() + 0.5 * mixing.PULL * (w * (x - 1) ** 2).sum()

    x = np.ones(len(n))
    for _ in range(50_000):
        x = np.clip(x - (p @ (scale * (w * x @ p - target)) + mixing.PULL * (x - 1)) / (3 + mixing.PULL), 0, cut)
    assert got.min() >= 0 and got.max() <= cut
    assert loss(x) <= loss(got) + 1e-9 and loss(got) - loss(x) < 2e-4


def test_odd_rows_keep_their_rate(session):
    texts = [(i, f"good fine day n{i}") for i in range(60)] + [(100 + i, f"bad *** awful n{i}") for i in range(60)]
    odd = [(900, None), (901, ""), (901, ""), (902, " \n"), (None, "good fine"), (903, "good " * 100_000)]
    frame = session.createDataFrame([(i, t, 1, "x", 0.5) for i, t in texts + odd], "doc_id long, text string, feature int, domain string, mix_rate double")
    labels = session.createDataFrame([(i, "g") for i in range(60)] + [(100 + i, "b") for i in range(60)] + [(None, "g"), (5, None), (7, "g")], "doc_id long, domain string")
    got = mixing.mixed(frame, labels, {"g": 0.5, "b": 0.5}, most=1.0).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(texts) + 5 and by_id[901].rows == 2 and by_id[903].mix_tokens == 100_000
    assert by_id[900].mix_tokens == by_id[902].mix_tokens == 0 and all(0 <= r.mix_rate <= 1 for r in got)
    assert mixing.mixed(frame.limit(0), labels, {"g": 1.0}).collect() == []
    assert {r.mix_attained for r in mixing.mixed(frame, labels.limit(0), {}).collect()} == {None}
    one = mixing.mixed(frame, labels.where("domain = 'g'"), {"g": 1.0}).collect()
    assert {r.mix_posteriors[0] for r in one} == {1.0} and {round(r.mix_rate, 6) for r in one} == {1.0}


def test_mixing_stage_keeps_clean_documents(session):
    docs = session.read.parquet(f"{SF}/documents.parquet").withColumn("mix_rate", F.lit("x"))
    kept = corpus_pipeline.mix(session, docs, SF).cache()
    labels = mixing.domains(session.read.parquet(f"{SF}/labels.parquet"))
    share = {d: kept.join(labels.where(F.col("domain") == d), "doc_id").count() / labels.where(F.col("domain") == d).count() for d in ("clean", "toxic")}
    assert kept.columns == docs.columns and share["clean"] > 0.97 and share["toxic"] < 0.6
