"""Held-out accuracy, calibration by hand, and rows of every kind."""

from __future__ import annotations

import random
import zlib

import numpy as np
from poseval.llm import quality as Q


def test_pooled():
    got = Q.pooled(np.array([1.0, 1, 2, 1]), np.array([0.0, 1, 0.5, 1]))
    assert np.allclose(got, [0, 0.5, 0.5, 1])
    assert (np.diff(Q.pooled(np.ones(50), np.random.default_rng(1).random(50))) >= -1e-12).all()


def made(n: int):
    rnd = random.Random(n)
    words = ["the", "of", "river", "stone", "And", "light,", "bird."]
    docs, labels = [], []
    for k in range(n):
        good = rnd.random() < 0.7
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 200)))
        docs.append((k, text if good else text.upper().replace(" ", "!! ")))
        if k % 2 == 0:
            labels.append((k, int(good), 0))
    return docs, labels


def test_scores(spark, docs_of):
    docs, labels = made(600)
    rows = docs + [(7, docs[7][1]), (None, "no id"), (1000, None), (1001, "w" * 200_000)]
    table = docs_of(rows).selectExpr("*", "1 AS score", "2 AS crc", "3 AS x")
    known = spark.createDataFrame([*labels, (2, None, 0), (None, 1, 0), labels[0]], "doc_id long, quality int, toxic int")
    got = Q.quality_scores(table, known).collect()
    assert len(got) == len(rows)
    good = {k: not t.isupper() for k, t in docs}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    unseen = [r for r in got if r.held_out and r.doc_id in good]
    assert np.mean([r.predicted == good[r.doc_id] for r in unseen]) > 0.95
    kept = Q.drop_low_quality(table, known)
    assert kept.columns == table.columns
    want = sorted((r.doc_id if r.doc_id is not None else -1) for r in got if r.predicted)
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == want


def test_normal_equations_match_numpy(spark, docs_of):
    docs, labels = made(200)
    stats = Q.document_statistics(docs_of(docs))
    rows = {r.doc_id: np.array(r.x) for r in stats.collect()}
    y = {i: q for i, q, _ in labels}
    fourier = Q.Fourier.make(np.mean(list(rows.values()), 0), np.std(list(rows.values()), 0) + 1e-6, 16)
    learn = stats.join(spark.createDataFrame([(i, float(q)) for i, q in y.items()], "doc_id long, y double"), "doc_id")
    sums = Q._equations(learn.selectExpr("int(doc_id % 3) AS fold", "x", "y").repartition(5), fourier)
    z = fourier.map(np.array([rows[i] for i in y]))
    assert np.allclose(sum(sums.values())[:, :-1], z.T @ z)
    assert np.allclose(sum(sums.values())[:, -1], z.T @ np.array(list(y.values())))


def test_no_labels_and_no_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.quality_scores(docs_of(["a", "b"]), none).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.5, 1)] * 2
    assert Q.quality_scores(docs_of(["a"]).where("false"), none).collect() == []
