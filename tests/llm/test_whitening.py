"""Whitening against numpy's eigenvectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from layerloom.llm import whitening

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=32):
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    size = max(len(v) for _, v in good)
    f = np.array([[*np.floor(64 * np.array(v, np.float32).astype(float)), *[0.0] * (size - len(v))] for _, v in good])
    n = len(f)
    y = f - f.sum(axis=0) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    whole = (n * f.astype(np.int64) - f.sum(axis=0).astype(np.int64)).astype(object)
    return [i for i, _ in good], e, (y @ v[:, :k]) / np.sqrt(np.maximum(e[:k], 1e-300)), (whole * whole).sum(axis=1)


def check(found, rows, k=32):
    ids, e, white, deviation = plain(rows, k)
    table = {(r.vec_id, r.component): r for r in found}
    k = min(k, white.shape[1])
    assert len(found) == len(ids) * k
    got = np.array([[table[i, c + 1].whitened for c in range(k)] for i in ids])
    sign = np.sign((got * white[:, :k]).sum(axis=0))
    assert np.abs(got * sign - white[:, :k]).max() < 1e-8
    assert np.abs(got.T @ got / len(ids) - np.eye(k)).max() <= 1e-10
    assert [table[i, 1].deviation for i in ids] == [int(d) for d in deviation]
    assert np.allclose([table[ids[0], c + 1].explained for c in range(k)], e[:k] / e.sum(), rtol=1e-10)
    assert {r.n for r in found} == {len(ids)} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error <= 1e-10


def test_op12_equals_numpy(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(contract.queries()["op12_whitening"](spark, SF_DIR).collect(), rows)


def test_dirty_vectors_and_clashing_columns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 3, 12) * np.linspace(3, 0.5, 12)]) for i in range(400)]
    rows += [(500, None), (501, [float("nan")] * 12), (502, [1.0, None] + [0.0] * 10), (503, [float("inf")] + [0.0] * 11), (504, [])]
    rows += [(505, [1.0, 2.0]), (506, rows[0][1])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumns({c: F.lit("x") for c in ("n", "v", "component", "part", "sums")})
    check(whitening.whiten(df, 5).collect(), rows, 5)
    check(whitening.whiten(df).collect(), rows, 12)


def test_defined_results(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).count() == 0
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (1, [2.0, 2.0]), (None, [3.0, 2.0])], SCHEMA)
    found = whitening.whiten(flat).collect()  # one direction only
    assert sorted((str(r.vec_id), r.component) for r in found) == [("1", 1), ("1", 1), ("None", 1)]
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [1.0])], SCHEMA))


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**i), 1.0]) for i in range(40)]
    found = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() if r.component == 1}
    values, n = [int(64 * 2**i) for i in range(40)], 40
    deviation = [(n * x - sum(values)) ** 2 for x in values]
    assert [found[i].deviation for i in range(40)] == [d if d < 2**63 else None for d in deviation]


@pytest.mark.parametrize("kind", ["falling", "clustered", "nearly flat"])
def test_solver_needs_products_only(kind):
    rng, size = np.random.default_rng(4), 250
    e = {"falling": 0.9 ** np.arange(size), "clustered": np.r_[np.ones(10), np.full(60, 0.5), 0.1 * rng.random(size - 70)], "nearly flat": 1 + rng.random(size)}[kind]
    turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
    a = (turn * e) @ turn.T
    values, vectors, residuals = whitening.jacobi_davidson(lambda b: a @ b, size, 32)
    assert np.allclose(values, np.sort(e)[::-1][:32], rtol=0, atol=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(32)).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 2e-13 * values[0] and residuals.max() <= whitening.TOLERANCE * values[0]


def test_partial_sums_meet_in_a_tree(spark, monkeypatch):
    rows = [(i, [float(i % 7), float(i % 5), float(i % 3)]) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(40)
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    stored = whitening.CentredRows(df.selectExpr("vec_id", "cast(embedding as array<double>) as v"), 3)
    stored.parts = max(stored.parts, 100)
    y = np.array([v for _, v in rows]) * 64
    y -= y.mean(axis=0)
    assert np.allclose(stored.covariance_times(np.eye(3)), y.T @ y / 300)
