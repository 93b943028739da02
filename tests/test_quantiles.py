"""Exact quantiles of large groups: heavy tails, values close together, copies, brackets that miss."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxframe.operators import quantiles

CASES = {
    "heavy": np.random.default_rng(0).pareto(0.2, 5000),
    "narrow": 1e9 + np.random.default_rng(1).random(5000) * 1e-3,
    "copies": np.repeat([3.0, 1.0, 2.0], [4000, 900, 100]),
    "signed": np.random.default_rng(2).standard_normal(5001) * 1e-300,
}
WANTED = {"low": 0.0, "half": 0.5, "p95": 0.95, "top": 1.0}


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("hot_rows", [7, 10**6])
def test_large_groups(spark, by, hot_rows, monkeypatch):
    monkeypatch.setattr(quantiles, "PIECES", 8)
    for name, values in CASES.items():
        df = spark.createDataFrame([(name, float(v)) for v in values] + [(name, None)], "g string, v double")
        row = quantiles.exact_quantiles(df, F.col("v"), WANTED, by, hot_rows).first()
        assert [row[c] for c in WANTED] == pytest.approx(np.quantile(values, list(WANTED.values())), rel=1e-12)


def test_a_bracket_that_misses_is_replaced(spark, monkeypatch):
    def wrong(stats, keys, wanted):
        return brackets(stats, keys, wanted).withColumns({"lo": F.lit(5.0), "hi": F.lit(6.0)})

    brackets = quantiles._brackets
    monkeypatch.setattr(quantiles, "_brackets", wrong)
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    row = quantiles.exact_quantiles(df, F.col("v"), WANTED, (), 10).first()
    assert [row[c] for c in WANTED] == pytest.approx([0, 499.5, 949.05, 999])


def test_two_scans(spark, tmp_path, monkeypatch):
    spark.range(5000).select(F.rand(1).alias("v")).write.parquet(f"{tmp_path}/v")
    reads = []
    written = quantiles.cut_lineage

    def counted(df):
        """Counts the tables that are written from the value column, which is the first one written."""
        reads.append(any(first[0] in f for f in df.inputFiles()) if first else False)
        out = written(df)
        first.append(out.inputFiles()[0].rsplit("/", 2)[1])
        return out

    first: list[str] = []
    monkeypatch.setattr(quantiles, "cut_lineage", counted)
    df = spark.read.parquet(f"{tmp_path}/v")
    row = quantiles.distribution(df, ["v"], hot_rows=50).first()
    values = np.array([r.v for r in df.collect()])
    assert (row.n, row.median) == (5000, pytest.approx(np.median(values)))
    assert sum(reads) == 2


def test_groups_without_values(spark):
    rows = spark.createDataFrame([("a", None, 1.0), ("b", 2.0, None)], "g string, x double, y double")
    found = {(r.g, r.measure): (r.n, r.median) for r in quantiles.distribution(rows, ["x", "y"], ["g"]).collect()}
    assert found == {("a", "x"): (0, None), ("a", "y"): (1, 1.0), ("b", "x"): (1, 2.0), ("b", "y"): (0, None)}
