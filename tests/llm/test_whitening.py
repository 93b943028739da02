import numpy as np
import pytest

from boxframe.llm.whitening import _deviations, jacobi_davidson, minres, whiten

SHAPE = "vec_id long, embedding array<double>"


def rows_of(spark, vectors, **options):
    data = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in enumerate(vectors)]
    return whiten(spark.createDataFrame(data, SHAPE), **options).toPandas()


def brute(vectors):
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = (x * n - s) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    return ((x * n - s) ** 2).sum(1), values[::-1], c @ axes[:, ::-1]


def test_minres_solves():
    a = np.random.default_rng(3).standard_normal((30, 30))
    a, b = a + a.T, np.random.default_rng(4).standard_normal((30, 4))
    assert np.abs(a @ minres(lambda v: a @ v, b, 60) - b).max() < 1e-9


@pytest.mark.parametrize(("size", "wanted", "block"), [(64, 32, 32), (200, 10, 4), (3, 32, 32), (1, 1, 1)])
def test_eigenpairs(size, wanted, block):
    x = np.random.default_rng(size).standard_normal((500, size)) * np.linspace(1, 5, size)
    v = x.T @ x / 500
    values, vectors = jacobi_davidson(lambda q: v @ q, size, wanted, block)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:wanted], rtol=1e-12)
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 1e-12 * values[0]


def test_repeated_eigenvalues():
    q, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((80, 80)))
    v = q @ np.diag([5.0] * 40 + [1.0] * 40) @ q.T
    values, vectors = jacobi_davidson(lambda x: v @ x, 80, 32)
    assert np.allclose(values, 5) and np.abs(vectors.T @ vectors - np.eye(32)).max() < 1e-12


def test_against_brute_force(spark):
    vectors = np.random.default_rng(7).standard_normal((400, 12)) * np.linspace(3, 0.5, 12)
    vectors[200:] = vectors[0]
    found = rows_of(spark, vectors, components=8)
    deviation, values, projected = brute(vectors)
    assert len(found) == 400 * 8 and set(found.n) == {400}
    for j in range(8):
        part = found[found.component == j + 1].sort_values("vec_id")
        assert part.deviation.astype(int).tolist() == deviation.tolist()
        mine, other = part.whitened.to_numpy(), projected[:, j] / np.sqrt(values[j])
        assert min(np.abs(mine - other).max(), np.abs(mine + other).max()) < 1e-8
        assert np.allclose(part.explained, values[j] / values.sum(), rtol=1e-10)
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9


def test_rows_that_take_no_part_and_lengths(spark):
    rng = np.random.default_rng(1)
    odd = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1e300, 1.0]]
    found = rows_of(spark, [*odd, *rng.standard_normal((20, 2)), *rng.standard_normal((9, 3)), [0.0, 0.0]])
    assert set(found.vec_id) == set(range(6, 36))
    assert set(found[found.vec_id < 26].n) == {21} and set(found[(found.vec_id >= 26) & (found.vec_id < 35)].n) == {9}


def test_fewer_components_than_dimensions(spark):
    assert rows_of(spark, [[1.0, 2.0]] * 5).empty
    assert rows_of(spark, []).empty
    line = rows_of(spark, [[float(i), 2.0 * i, 0.0] for i in range(10)])
    assert set(line.component) == {1} and line.identity_error.max() < 1e-9


def test_null_ids_and_clashing_columns(spark):
    rows = [(None, [1.0, 0.0], "a"), (None, [0.0, 1.0], "b"), (3, [1.0, 1.0], "c")]
    found = whiten(spark.createDataFrame(rows, f"{SHAPE}, x string").withColumnRenamed("x", "component"))
    assert found.count() == 6 and found.filter("vec_id is null").count() == 4


def test_deviations_of_every_width():
    rng = np.random.default_rng(2)
    for largest, n in ((50, 1000), (1 << 19, 1 << 38), (1 << 45, 10**6)):
        k, rest = rng.integers(-largest, largest, (5, 7)), rng.integers(0, n, 7)
        exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, rest)) for row in k]
        assert _deviations(k, rest, n) == exact
