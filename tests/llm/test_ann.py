import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from boxframe.llm import ann


def brute(rows, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for place, q in enumerate(ids):
        if q % 20 == 0:
            scores = x @ x[place]
            order = [j for j in np.lexsort((ids, -scores)) if j != place][:k]
            out[int(q)] = ids[order].tolist()
    return out


def recall(got, wanted):
    return np.mean([len(set(got[q]) & set(w)) / len(w) for q, w in wanted.items()])


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def test_recall_on_unit_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = found(ann.nearest(table, F.col("vec_id") % 20 == 0))
    wanted = brute([(r.vec_id, r.embedding) for r in table.collect()], 20)
    assert set(got) == set(wanted) and recall(got, wanted) >= 0.9


def test_recall_where_every_vector_is_hashed(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(5000, 32))
    rows = [(i, (v / np.sqrt(v @ v)).tolist()) for i, v in enumerate(x)]
    got = found(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, small=0))
    assert all(len(v) == 20 for v in got.values()) and recall(got, brute(rows, 20)) >= 0.9


def test_recall_with_other_norms(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=12) * rng.uniform(0.2, 3)).tolist()) for i in range(600)]
    got = found(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=10))
    assert recall(got, brute(rows, 10)) >= 0.9


def test_recall_with_some_long_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 64))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    x[7:12] *= [[10], [20], [100], [300], [1000]]
    # A fifth three times as long: a range that is hashed, like that of the others.
    x[1000:1600] *= 3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for small in (None, 100):
        got = found(ann.nearest(table, F.col("vec_id") % 20 == 0, small=small))
        assert recall(got, brute(rows, 20)) >= 0.9


def test_copies_and_ties(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(100)] + [(200, [0.0, 1.0, 0.0]), (201, [2.0, 0.0, 0.0])]
    got = found(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=20))
    assert got[40] == [201, *range(19)] and got[0] == [201, *range(1, 20)]


def test_every_query_gets_k_rows(spark):
    rng = np.random.default_rng(4)
    # A cluster that fills few buckets, queries away from it.
    x = rng.normal(size=64) + 0.01 * rng.normal(size=(400, 64))
    x[::20] = rng.normal(size=(20, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    shape = "vec_id long, embedding array<double>"
    wanted = brute(rows, 20)
    got = found(ann.nearest(spark.createDataFrame(rows, shape), F.col("vec_id") % 20 == 0, tables=2, probes=4, small=0))
    assert set(got) == set(wanted) and all(len(v) == 20 for v in got.values())
    # A table of no more than k candidates.
    few = rows[:20]
    got = found(ann.nearest(spark.createDataFrame(few, shape), F.col("vec_id") % 20 == 0, small=0))
    assert got == brute(few, 20) and len(got[0]) == 19


def test_ties_at_the_last_place_go_to_the_smaller_id():
    rng = np.random.default_rng(5)
    x = np.unique(rng.integers(0, 2, (3000, 16)), axis=0).astype(float)
    ids = rng.permutation(len(x))
    q = np.ones((2, 16))
    block = [pa.table({"entry": pa.array(i), "vector": pa.array(v.tolist(), pa.list_(pa.float64()))}) for i, v in ((ids, x), (np.array([-1, -2]), q))]
    best = ann._best(*block, 300).to_pandas()
    wanted = ids[np.lexsort((ids, -x.sum(1)))][:300].tolist()
    assert best[best["query"] == -1].entry.tolist() == wanted and best[best["query"] == -2].entry.tolist() == wanted


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, None, 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (6, [], 1), (7, [0.5, 0.5], 1), (7, [0.5, 0.5], 1), (None, [1.0, 1.0], 1), (8, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    assert found(ann.nearest(df, F.col("vec_id") % 20 == 0)) == {0: [7]}
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_each_length_is_searched(spark):
    rng = np.random.default_rng(6)
    regular = [(i, rng.normal(size=64).tolist()) for i in range(200)]
    stray = [(1000, rng.normal(size=65).tolist())]
    short = [(2000 + i, rng.normal(size=3).tolist()) for i in range(30)]
    table = spark.createDataFrame(regular + stray + short, "vec_id long, embedding array<double>")
    for small in (0, ann.SMALL):
        got = found(ann.nearest(table, F.col("vec_id") % 20 == 0, small=small))
        wanted = brute(regular, 20) | brute(short, 20)
        assert set(got) == set(wanted) and recall(got, wanted) >= 0.9


def test_rotation_keeps_lengths():
    x = np.random.default_rng(2).normal(size=(5, 64))
    assert np.allclose((ann.rotated(x, 1, 0) ** 2).sum(1), (x * x).sum(1))
