"""Whitening against dense linear algebra."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import whitening
from gristmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def dense(vectors):
    """Distinct x, eigenvalues by falling size with their vectors, and the trace, from the covariance as a whole."""
    x = np.unique((np.floor(64 * np.asarray(vectors, float)) + 1_000_000).astype(np.int64), axis=0)
    centred = x - x.mean(0)
    e, q = np.linalg.eigh(centred.T @ centred / len(x))
    return x, e[::-1], q[:, ::-1], np.trace(centred.T @ centred / len(x))


def compare(rows, vectors_by_id, components=16):
    x, e, q, trace = dense([v for v in vectors_by_id.values()])
    n, sums, k = len(x), x.sum(0), min(components, len(e))
    whitened = np.full((len(vectors_by_id), k), np.nan)
    at = {v: i for i, v in enumerate(vectors_by_id)}
    own = {v: (np.floor(64 * np.asarray(c, float)) + 1_000_000).astype(np.int64) for v, c in vectors_by_id.items()}
    for r in rows:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(own[r["vec_id"]], sums, strict=True))
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / trace, rel=1e-9)
        whitened[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    expected = (np.array(list(own.values())) - sums / n) @ q[:, :k] / np.sqrt(e[:k])
    for c in range(k):
        sign = np.sign(whitened[:, c] @ expected[:, c])
        assert np.abs(sign * whitened[:, c] - expected[:, c]).max() < 1e-6
    assert len(rows) == len(vectors_by_id) * k


def test_whitening_of_the_table(spark):
    vectors = dict(spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect())
    compare(QUERIES["op12_whitening"](spark, SF).collect(), vectors)


def test_whitening_edges(spark):
    rng = np.random.default_rng(3)
    good = {d: [*map(float, rng.normal(size=5) * [9, 4, 2, 1, 1])] for d in range(40)}
    good |= {100: good[3], 101: good[3]}
    bad = {200: None, 201: [1.0, None, 2.0, 3.0, 4.0], 202: [float("nan")] * 5, 203: [float("inf")] * 5, 204: [1e30] * 5, 205: [], 206: [1.0, 2.0]}
    schema = "vec_id long, embedding array<double>"
    table = spark.createDataFrame([*(good | bad).items()], schema).withColumns({"x": F.lit("taken"), "N": F.lit(1), "component": F.lit(2), "_embedding": F.lit(0)}).drop("_embedding")
    compare(whitening.whiten(table).collect(), good)
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id in (3, 100, 101)")).count() == 0
    plane = spark.createDataFrame([(None, [1.0 * a, 2.0 * a, 0.0]) for a in range(9)], schema)
    rows = whitening.whiten(plane).collect()  # one direction alone has variance
    assert len(rows) == 9 and {(r["vec_id"], r["component"]) for r in rows} == {(None, 1)} and rows[0]["explained"] == pytest.approx(1)


@pytest.mark.parametrize(("dimensions", "count"), [(1, 1), (3, 16), (20, 16), (200, 16)])
def test_solver_on_spectra_with_ties(dimensions, count):
    rng = np.random.default_rng(dimensions)
    q = np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0]
    values = np.sort(np.concatenate([np.ones(dimensions // 2), rng.exponential(size=dimensions - dimensions // 2) * 100]))[::-1]
    if dimensions > 4:
        values[1] = values[2]
    a = (q * values) @ q.T
    e, v = whitening.jacobi_davidson(lambda w: a @ w, dimensions, count)
    assert np.allclose(e, values[: len(e)], rtol=1e-12) and len(e) == min(count, dimensions)
    assert np.abs(a @ v - v * e).max() < 1e-11 * values[0] and np.abs(v.T @ v - np.eye(len(e))).max() < 1e-12


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(30, 30))
    a, b = a + a.T, rng.normal(size=(30, 4))
    t = whitening.minres(lambda w: a @ w, b, 60, 1e-12)
    assert np.abs(a @ t - b).max() < 1e-8
