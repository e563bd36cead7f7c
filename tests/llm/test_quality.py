"""The classifier on its held-out fold."""

from __future__ import annotations

import zlib

import numpy as np

from strata.llm import quality, queries
from tests.llm.helpers import ODD_TEXTS, documents

SMALL = "/root/testdata/sf0.01"


def area(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return float(np.mean((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :])))


def test_held_out_accuracy_and_fold(spark):
    got = queries.op10_quality(spark, SMALL).collect()
    assert len(got) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    held = [r for r in got if r.held_out and labels.get(r.doc_id) in (0, 1)]
    assert area(np.array([r.score for r in held]), np.array([labels[r.doc_id] for r in held])) > 0.97


def test_training_ignores_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2 then 1 - quality else quality end as quality")
    a, b = quality.train(docs, labels, 100), quality.train(docs, flipped, 100)
    assert a.bias == b.bias and (a.weights == b.weights).all() and (a.factors == b.factors).all()


def test_sum_of_squares_is_the_pairwise_sum():
    rng = np.random.default_rng(0)
    model = quality.Model(0.3, rng.normal(size=20), rng.normal(size=(20, 3)))
    ids, x = np.arange(0, 20, 2), rng.normal(size=10)
    want = 0.3 + (model.weights[ids] * x).sum()
    for i in range(10):
        for j in range(i + 1, 10):
            want += model.factors[ids[i]] @ model.factors[ids[j]] * x[i] * x[j]
    assert abs(model.raw(np.zeros(10, int), ids, x, 1)[0] - want) < 1e-9


def test_odd_rows(spark):
    docs = documents(spark, [*ODD_TEXTS, "a", "a"], [*range(len(ODD_TEXTS)), 4, None])
    labels = spark.createDataFrame([(4, 1, None), (5, 0, 1), (4, 1, 0), (None, 1, 1), (6, None, 0), (7, 3, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    got = {(r.doc_id, r.score) for r in quality.scored(docs, model).collect()}
    assert len(got) == len(ODD_TEXTS) + 1 and all(0 < s < 1 for _, s in got)
    by_id = dict(got)
    assert by_id[0] == by_id[1] and by_id[4] == by_id[None]
    assert quality.kept(docs, model, 0.0).collect() == docs.collect()
    assert quality.kept(docs, model, 1.0).columns == docs.columns
    none = quality.train(docs.where("false"), labels.where("false"))
    assert quality.scored(docs.where("false"), none).collect() == []
    assert {r.score for r in quality.scored(docs.limit(3), none).collect()} != set()
