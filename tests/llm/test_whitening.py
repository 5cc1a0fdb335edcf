"""Whitening against a dense eigendecomposition, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import whitening
from gaugeline.llm.queries import op12_whitening


def dense(x):
    """n, sums, eigenvalues and eigenvectors of the covariance of integer rows."""
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, values[::-1], vectors[:, ::-1], centred


def test_query_against_dense(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    fine = {
        r.vec_id: np.floor(64 * np.array(r.embedding, np.float64)).astype(np.int64) + 1_000_000
        for r in rows
        if r.embedding is not None
    }
    fit = np.unique(np.array(list(fine.values())), axis=0)
    n, sums, values, vectors, _ = dense(fit)
    got = op12_whitening(spark, sf_dir).collect()
    assert len(got) == 16 * len(fine)
    by_component = {}
    for row in got:
        x = fine[row.vec_id]
        j = row.component - 1
        assert row.n == n and row.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        assert row.explained == pytest.approx(values[j] / values.sum(), rel=1e-9)
        assert 0 <= row.identity_error < 1e-9
        want = (x - sums / n) @ vectors[:, j] / np.sqrt(values[j])
        by_component.setdefault(j, []).append((row.whitened, want))
    for pairs in by_component.values():
        found, want = np.array(pairs).T
        sign = np.sign(found @ want)
        assert np.allclose(found, sign * want, atol=1e-7)


@pytest.mark.parametrize("kind", ["long", "double"])
def test_spectra(spark, kind):
    """A spectrum that falls by five decades, and one that is nearly flat."""
    rng = np.random.default_rng(4)
    for scales in (np.geomspace(3000, 10, 40), np.linspace(60, 50, 40)):
        turn, _ = np.linalg.qr(rng.normal(size=(40, 40)))
        x = np.round((rng.normal(size=(600, 40)) * scales) @ turn).astype(np.int64)
        rows = [([int(v) if kind == "long" else float(v) for v in row],) for row in x]
        frame = spark.createDataFrame(rows, f"embedding array<{kind}>").repartition(3)
        model = whitening.fit(frame, components=6)
        n, sums, values, vectors, _ = dense(x)
        assert model.n == n and np.allclose([float(s) for s in model.sums], sums)
        assert np.allclose(model.values, values[:6], rtol=1e-9)
        assert model.trace == pytest.approx(values.sum())
        assert model.residuals[-1] <= whitening.CERTIFIED and model.identity_error < 1e-9
        assert (np.abs((model.vectors * vectors[:, :6]).sum(axis=0)) > 1 - 1e-8).all()
        whitened = np.array([r.whitened for r in whitening.whiten(frame, model).collect()])
        assert np.allclose(np.cov(whitened.T, bias=True), np.eye(6), atol=1e-8)


def test_rank_and_empty(spark):
    kind = "embedding array<long>"
    flat = spark.createDataFrame([([i, 2 * i, 7],) for i in range(9)], kind)
    model = whitening.fit(flat)
    assert len(model.values) == 1 and model.identity_error < 1e-9
    assert len(whitening.whiten(flat, model).first().whitened) == 1
    equal = spark.createDataFrame([([5, 5],)] * 4, kind)
    assert len(whitening.fit(equal).values) == 0
    assert whitening.whiten(equal, whitening.fit(equal)).filter("whitened is null").count() == 4
    none = spark.createDataFrame([], kind)
    assert len(whitening.fit(whitening.usable(none)).values) == 0


def test_usable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0, None]), (5, [nan, 1.0]),
        (6, [1.0, -inf]), (7, [1.0, 2.0, 3.0]), (None, [3.0, 4.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kept = whitening.usable(frame.withColumn("whitened", F.lit("own")))
    assert sorted(kept.toPandas().vec_id.fillna(0)) == [0, 1, 1]
    model = whitening.fit(kept)
    found = whitening.whiten(frame.withColumn("whitened", F.lit("own")), model)
    assert found.columns[-2:] == ["whitened", "whitened_"]
    assert found.filter("whitened_ is null").count() == 6  # all that are not usable


def test_odd_rows_of_the_query(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=8)], 0) for i in range(30)]
    rows += [(40, rows[0][1], 1), (41, None, 0), (42, [float("nan")] * 8, 0), (0, rows[0][1], 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame.withColumn("component", F.lit("own")).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op12_whitening(spark, str(tmp_path))
    assert got.count() == 8 * 32 and {r.n for r in got.collect()} == {30}
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    frame.limit(0).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert op12_whitening(spark, f"{tmp_path}/none").count() == 0
