import random

import numpy as np

from boxframe.llm import ngram_join, shingles
from boxframe.llm.common import components


def brute_sets(text, size=5):
    words = (text or "").encode().translate(shingles._LOWER).split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_links(rows):
    sets = [(i, brute_sets(t)) for i, t in rows]
    return {
        (min(a, b), max(a, b))
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if x and y and 100 * len(x & y) >= 80 * len(x | y)
    }


def brute_components(ids, links):
    of = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(of[a], of[b])
            changed |= of[a] != low or of[b] != low
            of[a] = of[b] = low
    return of


def near_copies(seed, families, size, edits):
    rng, rows = random.Random(seed), []
    for _ in range(families):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(8, 90))]
        for _ in range(rng.randint(1, size)):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 2)] = [f"e{rng.randint(0, 9)}"] * rng.randint(0, 2)
                words = words or ["x"]
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_keys_meet_for_all_similar_sets():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        n = int(rng.integers(2, 200))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        keep = x[rng.random(len(x)) > rng.random() * 0.25]
        y = np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if len(x) < 2 or len(y) < 2 or 100 * both < 80 * (len(x) + len(y) - both):
            continue
        limit = np.uint64(int(rng.random() * (1 << 63)))
        # Frequency is a property of the token, here of its mixed bits.
        flag = lambda s: (s * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1) < limit
        with np.errstate(over="ignore"):
            a, b = shingles.set_keys(x, flag(x), 80), shingles.set_keys(y, flag(y), 80)
        assert len(np.intersect1d(a, b)), (len(x), len(y), both)


def test_profile_bounds_the_overlap():
    rng = np.random.default_rng(4)
    for _ in range(300):
        x = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 300))).astype(np.uint64))
        y = np.unique(np.concatenate([rng.choice(x, int(rng.integers(0, len(x) + 1)), False), rng.integers(0, 1 << 63, int(rng.integers(1, 300))).astype(np.uint64)]))
        assert ngram_join.overlap_bound(ngram_join.profile(x), ngram_join.profile(y)) >= len(np.intersect1d(x, y))


def test_components_equal_brute_force(spark):
    # Low limits make most tokens frequent, so that combinations and both residual searches have work.
    for seed, frequent in ((1, 2), (2, 64)):
        rows = near_copies(seed, 12, 14, 7)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in ngram_join.similar_groups(docs, cells=1 << 12, frequent=frequent).collect()}
        assert got == brute_components([i for i, _ in rows], brute_links(rows))


def test_pairs_equal_brute_force(spark):
    rows = near_copies(5, 8, 6, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = brute_links(rows)
    groups = {r.doc_id: r.class_id for r in ngram_join.similar_groups(docs, cells=1 << 12, frequent=3).collect()}
    got = {(r.a, r.b) for r in ngram_join.similar_pairs(docs, cells=1 << 12, frequent=3).collect()}
    between = {tuple(sorted((groups[a], groups[b]))) for a, b in links if groups[a] != groups[b]}
    assert got == between


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(20_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", None), (4, "One two", "x"), (9, "one  TWO", "x"), (5, "one", "x"), (7, text, "x"), (6, text + " y", "x"), (None, "one two", "x"), (8, None, None), (8, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_groups(docs).collect()), key=str)
    assert got == sorted(
        [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (9, 1, 4), (5, 1, 5), (7, 19_996, 6), (6, 19_997, 6), (None, 1, 4), (8, 0, 8), (8, 0, 8)], key=str
    )
    assert ngram_join.similar_groups(docs.limit(0)).count() == 0


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 101)], "a long, b long")
    got = {r.node: r.component for r in components(spark, links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
