import math
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from sheetloom.llm import whitening
from sheetloom.llm.whitening import Centre, leading_eigenpairs, minres, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def integers(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def plain(vectors, k=32):
    """Exact deviations, eigenvalues and eigenvectors of the whole covariance."""
    x = integers(vectors)
    n, d = len(x), len(x[0])
    s = [sum(col) for col in zip(*x)]
    y = [[n * v - t for v, t in zip(row, s)] for row in x]
    c = np.array(y, dtype=object).astype(float) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    return [sum(v * v for v in row) for row in y], c, values[::-1][:k], axes[:, ::-1][:, :k], np.trace(c.T @ c) / n


def check(rows, ids, vectors, k=32):
    deviations, c, values, axes, trace = plain(vectors, k)
    by_id = defaultdict(dict)
    for r in rows:
        by_id[r.vec_id][r.component] = r
    k = len(values)
    assert {len(v) for v in by_id.values()} == {k} and set(by_id) == set(ids)
    expected = c @ axes / np.sqrt(values)
    ours = np.array([[by_id[i][j].whitened for j in range(1, k + 1)] for i in ids])
    sign = np.sign((ours * expected).sum(axis=0))
    assert np.abs(ours * sign - expected).max() < 1e-6
    for i, dev in zip(ids, deviations):
        assert {int(r.deviation) for r in by_id[i].values()} == {dev}
        assert {r.n for r in by_id[i].values()} == {len(ids)}
    explained = [by_id[ids[0]][j].explained for j in range(1, k + 1)]
    assert np.allclose(explained, values / trace, rtol=1e-9)
    spread = ours - ours.mean(axis=0)
    error = np.abs(spread.T @ spread / len(ids) - np.eye(k)).max()
    assert error < 1e-4 and {r.identity_error for r in rows} == {rows[0].identity_error}
    assert abs(rows[0].identity_error - error) < 1e-9


def made(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) @ np.diag(np.linspace(0.2, 2, d))).tolist()


@pytest.mark.parametrize("n,d", [(300, 40), (200, 5), (150, 1)])
def test_equals_the_whole_covariance(spark, n, d, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 4096)
    vectors = made(n, d)
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA).repartition(5)
    check(whiten(df).collect(), list(range(n)), vectors)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    rows = entry.queries()["op13_embedding_whitening"](spark, sf).collect()
    check(rows, [r.vec_id for r in table], [r.embedding for r in table])
    assert rows[0].identity_error <= 1e-4


@pytest.mark.parametrize("dim,spectrum", [
    (64, lambda d: np.linspace(1, 2, d)), (200, lambda d: 1.0 / np.arange(1, d + 1)),
    (200, lambda d: np.r_[np.arange(1.0, 11), np.zeros(d - 10)]),
    (90, lambda d: np.r_[np.full(40, 5.0), np.ones(d - 40)]), (3, lambda d: np.ones(d))])
def test_eigenpairs(dim, spectrum):
    rng = np.random.default_rng(dim)
    q = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    matrix = (q * spectrum(dim)) @ q.T
    products = []
    values, axes = leading_eigenpairs(lambda b: products.append(b.shape[1]) or matrix @ b, dim, 32)
    assert np.allclose(values, np.sort(spectrum(dim))[::-1][:32], atol=1e-12)
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13
    assert np.sqrt(((matrix @ axes - axes * values) ** 2).sum(axis=0)).max() < 1e-12 * values[0]
    assert max(products) <= 40 and len(products) < 80       # thin blocks, never the matrix


def test_minres_solves_several_systems_in_step():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    shifts, rhs = np.array([0.3, -1.0, 5.0]), rng.standard_normal((30, 3))
    rhs[:, 1] = 0
    x = minres(lambda b: a @ b - b * shifts, rhs, 200)
    assert np.abs(a @ x - x * shifts - rhs).max() < 0.05 * np.abs(rhs).max()
    assert not x[:, 1].any()


def test_deviation_beyond_64_bits():
    rows = [[10 ** 12, 0], [-(10 ** 12), 5], [3, 3]]
    n, sums = 3, [sum(c) for c in zip(*rows)]
    found = Centre(n, sums).deviation(np.array(rows, dtype=np.int64))
    assert found == [sum((n * v - s) ** 2 for v, s in zip(r, sums)) for r in rows]


def test_odd_rows(spark):
    good = made(60, 4, seed=3)
    bad = [None, [], [1.0, None, 1.0, 1.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0]]
    ids = list(range(60)) + list(range(100, 106))
    df = spark.createDataFrame([(i, v, 0) for i, v in zip(ids, good + bad)], SCHEMA)
    check(whiten(df).collect(), list(range(60)), good)
    # repeated rows and null ids count; a column named like a result is not read
    twice = spark.createDataFrame([(7, v, 0, 1.0) for v in good for _ in (0, 1)] + [(None, good[0], 0, 1.0)],
                                  SCHEMA + ", whitened double")
    rows = whiten(twice).collect()
    assert len(rows) == 121 * 4 and sum(r.vec_id is None for r in rows) == 4


def test_no_rows(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(4)], SCHEMA)).count() == 0
    huge = spark.createDataFrame([(i, [3e38 * (-1) ** i, float(i)], 0) for i in range(4)], SCHEMA)
    assert whiten(huge).count() > 0


def test_fewer_components_than_dimensions(spark):
    flat = [[float(i), 2.0 * i, 1.0] for i in range(30)]
    rows = whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(flat)], SCHEMA)).collect()
    assert {r.component for r in rows} == {1} and rows[0].identity_error < 1e-9
