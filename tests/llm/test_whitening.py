"""Whitening against numpy's eigenvectors."""

from __future__ import annotations

import numpy as np
import pytest

from poseval.llm.queries import op11_whitening
from poseval.llm.whitening import OFFSET, SCALE, fit_whitening, whiten

KIND = "vec_id long, embedding array<float>, label int, v string, key string"


def table(spark, vectors, partitions=4):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 0, "x", "y") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, KIND).repartition(partitions)


def plain(vectors):
    """Sums, covariance and its eigenvectors, by falling value."""
    x = np.floor(SCALE * np.array(vectors, np.float32).astype(float)).astype(np.int64) + OFFSET
    n, sums = len(x), x.sum(axis=0)
    c = (n * x - sums) / n
    values, columns = np.linalg.eigh(c.T @ c / n)
    return n * x - sums, c, values[::-1], columns[:, ::-1]


def test_components_and_rows(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 12)) @ rng.normal(size=(12, 12)) * np.geomspace(1, 40, 12) + 3
    off, c, values, columns = plain(vectors)
    df = table(spark, vectors)
    fit = fit_whitening(df, components=8)
    assert fit.n == 3000 and fit.vectors.shape == (12, 8) and fit.identity_error < 1e-9
    np.testing.assert_allclose(fit.values, values[:8], rtol=1e-11)
    np.testing.assert_allclose(fit.explained, values[:8] / values.sum(), rtol=1e-11)
    signs = np.sign((fit.vectors * columns[:, :8]).sum(axis=0))
    np.testing.assert_allclose(fit.vectors, columns[:, :8] * signs, atol=1e-9)
    rows = {r.vec_id: r for r in whiten(df, fit, deviations=True).collect()}
    assert len(rows) == 3000
    for i in range(0, 3000, 97):
        assert rows[i].deviation == int((off[i] ** 2).sum())
        np.testing.assert_allclose(rows[i].whitened, c[i] @ columns[:, :8] * signs / np.sqrt(values[:8]), atol=1e-9)


def test_ill_conditioned(spark):
    """Scales from 1 to 10^6, whose Gram matrix has a condition number of 10^12."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(2000, 7)) * np.geomspace(1, 1e6, 7)
    _, _, values, _ = plain(vectors)
    fit = fit_whitening(table(spark, vectors))
    np.testing.assert_allclose(fit.values, values, rtol=1e-4)
    assert len(fit.values) == 7 and fit.identity_error < 1e-6


def test_rank(spark):
    """A constant entry, a repeated entry and one vector in most rows."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 4)).astype(np.float32)
    vectors = np.hstack([base, base[:, :1], np.ones((300, 1))])
    vectors = np.vstack([vectors, np.repeat(vectors[:1], 900, axis=0)])
    _, _, values, _ = plain(vectors)
    fit = fit_whitening(table(spark, vectors))
    assert len(fit.values) == 4 and fit.identity_error < 1e-9
    np.testing.assert_allclose(fit.values, values[:4], rtol=1e-9)


def test_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1, 2], [3, 5], [4, -1], [3, 5]]
    bad = [None, [], [None, 1], [nan, 1], [inf, 0], [0, -inf], [1, 2, 3]]
    df = table(spark, good + bad)
    fit = fit_whitening(df)
    assert fit.n == 4 and len(fit.values) == 2
    assert sorted(r.vec_id for r in whiten(df, fit).collect()) == [0, 1, 2, 3]
    assert fit_whitening(df.where("false")) is None
    assert fit_whitening(table(spark, bad[:4])) is None
    assert len(fit_whitening(table(spark, [[1, 2]] * 5)).values) == 0


def test_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        fit_whitening(table(spark, [[1e30, 1], [2, 3]]))


def test_query_without_rows(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = op11_whitening(spark, str(tmp_path))
    assert out.count() == 0 and out.columns[:3] == ["vec_id", "component", "n"]
    table(spark, [None, [1, 2]]).write.parquet(f"{tmp_path}/one/embeddings.parquet")
    assert op11_whitening(spark, f"{tmp_path}/one").count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = op11_whitening(spark, folder).toPandas()
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    off, c, values, columns = plain(np.stack(vectors.embedding))
    assert len(rows) == 32 * len(vectors) and rows.n.eq(len(vectors)).all() and rows.identity_error.max() < 1e-9
    wide = rows.pivot(index="vec_id", columns="component", values="whitened").loc[vectors.vec_id].to_numpy()
    expected = c @ columns[:, :32] / np.sqrt(values[:32])
    np.testing.assert_allclose(wide, expected * np.sign((wide * expected).sum(axis=0)), atol=1e-8)
    one = rows[rows.component == 1].set_index("vec_id").loc[vectors.vec_id]
    assert (one.deviation.to_numpy() == (off**2).sum(axis=1)).all()
    np.testing.assert_allclose(one.explained, values[0] / values.sum(), rtol=1e-9)
