import numpy as np
import pytest

from boxframe.llm.neardup import Forest, integer_product, links, near_groups, quantised, units

SHAPE = "vec_id long, embedding array<double>"


def brute(rows, threshold=0.9):
    ids = [r[0] for r in rows]
    good = [v is not None and len(v) > 0 and all(e is not None and np.isfinite(e) for e in v) and any(v) for _, v in rows]
    linked = [[] for _ in rows]
    for i, (_, v) in enumerate(rows):
        for j, (_, w) in enumerate(rows):
            if i != j and good[i] and good[j] and len(v) == len(w):
                a, b = (np.array(z, float) / np.abs(z).max() for z in (v, w))
                if (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum()) >= threshold:
                    linked[i].append(j)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((ids[j] for j in seen if ids[j] is not None), default=None)
        out.append((ids[i], len(linked[i]), least, ids[i] == least))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    result = near_groups(spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v]) for i, v in rows], SHAPE), **options)
    return sorted((tuple(r) for r in result.collect()), key=repr)


def clustered(seed, n, size, noise):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(1, n // 12), size))
    x = centres[rng.integers(0, len(centres), n)] + rng.standard_normal((n, size)) * noise * rng.random((n, 1))
    return x * np.exp(rng.standard_normal((n, 1)))


@pytest.mark.parametrize(("noise", "tile", "cells"), [(0.9, 8192, 256), (0.9, 20, 256), (0.3, 16, 5), (0.5, 9, 1)])
def test_against_all_pairs(spark, noise, tile, cells):
    rows = list(enumerate(clustered(tile, 220, 16, noise).tolist()))
    assert found(spark, rows, tile=tile, cells=cells) == brute(rows)


def test_one_tight_group_with_a_third_of_all_rows(spark):
    x = np.random.default_rng(0).standard_normal((240, 24))
    x[80:160] = x[0] + 0.05 * x[80:160]
    x[160:200] = x[1]
    rows = list(enumerate(x.tolist()))
    assert found(spark, rows, tile=25) == brute(rows)


def test_odd_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0])]
    rows += [(9, same), (8, same), (8, same), (None, same), (None, [-5.0, 1.0, 0.0]), (12, [1.0, 2.0]), (13, [2e300, 4e300]), (14, [1e-300, 2e-300]), (15, [-0.0, 1.0]), (16, [0.0, 2.0])]
    got = found(spark, rows)
    assert got == sorted(((i, n, c, k if c is not None else True) for i, n, c, k in brute(rows)), key=repr)
    assert found(spark, []) == [] and len(found(spark, rows[:6])) == 6


def test_pairs_at_the_threshold(spark):
    """Cosines just at, above and below the threshold, far within the rounding of 8 bits."""
    angle = np.arccos(0.9)
    turns = [0, angle * (1 - 1e-9), -angle * (1 + 1e-9), np.pi, np.pi + angle * (1 - 1e-12)]
    rows = [(i, [np.cos(t), np.sin(t)]) for i, t in enumerate(turns)]
    assert found(spark, rows, tile=2) == brute(rows)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    for size in (1, 3, 64, 1500):
        u = units(rng.standard_normal((60, size)) * np.exp(3 * rng.standard_normal((60, size))))
        q, scale, lost = quantised(u)
        guess = integer_product(q, q) * scale[:, None] * scale
        assert (np.abs(guess - u @ u.T) <= lost[:, None] + lost + lost[:, None] * lost).all()
        assert (integer_product(q, q) == q.astype(int) @ q.astype(int).T).all()


def test_links_of_a_tile():
    x = clustered(1, 300, 8, 0.6)
    u = units(x)
    pairs = {(int(a), int(b)) for i, j in links(x, x, 0.9, True) for a, b in zip(i, j, strict=True)}
    assert pairs == {(a, b) for a in range(300) for b in range(a + 1, 300) if u[a] @ u[b] >= 0.9}


def test_forest():
    forest = Forest(8)
    forest.join(np.array([7, 5, 3, 6]), np.array([5, 3, 1, 4]))
    assert forest.roots().tolist() == [0, 1, 2, 1, 4, 1, 4, 1]


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    odd = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1])], SHAPE).withColumns({"v": F.lit(1), "entry": F.lit(2), "weight": F.lit(3), "of": F.lit(4)})
    assert sorted(tuple(r) for r in near_groups(odd).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]
