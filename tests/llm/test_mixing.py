import math
from collections import Counter, defaultdict

import pytest

from boxframe.llm import mixing


def tables(spark):
    sizes = {"big": 600, "mid": 120, "small": 40, None: 10}
    rows = [(i, " ".join(["w"] * (3 + i % 11)), s, "x") for s, n in sizes.items() for i in range(n)]
    rows = [(k, t, s, x) for k, (_, t, s, x) in enumerate(rows)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, epoch string")


def totals(rows):
    out = Counter()
    for _, text, source, _ in rows:
        out[source] += max(1, len((text or "").split()))
    return out


def weights(tokens, x):
    total = sum(tokens.values())
    raised = {s: (n / total) ** x for s, n in tokens.items()}
    return {s: v / sum(raised.values()) for s, v in raised.items()}


def entropy(w):
    return -sum(v * math.log(v) for v in w.values())


def test_exponent_meets_entropy(spark):
    rows, docs = tables(spark)
    tokens = totals(rows)
    sources = spark.createDataFrame(list(tokens.items()), "source string, tokens long")
    low, high = entropy(weights(tokens, 1)), math.log(4)
    target = (low + high) / 2
    found = mixing.find_mixture(sources, target_entropy=target)
    assert found.entropy == pytest.approx(target, abs=1e-6)
    assert entropy(weights(tokens, found.exponent)) == pytest.approx(target, abs=1e-6)
    assert mixing.find_mixture(sources, target_entropy=high + 1).exponent == 0
    with pytest.raises(ValueError):
        mixing.find_mixture(sources, target_entropy=low / 2)
    with pytest.raises(ValueError):
        mixing.find_mixture(sources)


def test_quotas_and_permutations(spark):
    rows, docs = tables(spark)
    tokens = totals(rows)
    got = mixing.mix(docs, repetition_limit=2.5, block_tokens=50).collect()
    x = got[0].exponent
    w = weights(tokens, x)
    budget = max(tokens[s] / w[s] for s in tokens)
    assert max(w[s] * budget / tokens[s] for s in tokens) == pytest.approx(2.5, abs=1e-4)
    spent, times = Counter(), defaultdict(Counter)
    for r in got:
        spent[r.row.source] += r.tokens
        times[r.row.source][r.row.doc_id] += 1
        assert r.weight == pytest.approx(w[r.row.source]) and r.row.epoch == "x"
    for s in tokens:
        quota = w[s] * budget
        assert -1e-3 <= spent[s] - quota < 13, s
        # Whole epochs hold every document, the last one a part.
        assert set(times[s].values()) <= {math.floor(quota / tokens[s] + 1e-6), math.floor(quota / tokens[s] + 1e-6) + 1}
    assert {r.row.doc_id for r in got} == {r[0] for r in rows}


def test_small_budget_takes_a_part(spark):
    rows, docs = tables(spark)
    got = mixing.mix(docs, repetition_limit=1.0, budget=500.0, block_tokens=50).collect()
    assert 500 - 1e-6 <= sum(r.tokens for r in got) < 500 + 4 * 13 and all(r.epoch == 0 for r in got)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "", None), (3, "w " * 100_000, "b")], "doc_id long, text string, source string")
    got = mixing.mix(docs, repetition_limit=1e9).collect()
    assert {r.row.doc_id for r in got} == {1, None, 3}
    assert mixing.mix(docs.limit(0), repetition_limit=2.0).count() == 0
