"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxframe.operators.checkpoints import checkpoint_folder

#: Numbers in a row whose running total one task takes.
RUN = 4096


def prefix_sums(counted: DataFrame, place: str, amount: str, by: Sequence[str] = (), name: str = "base") -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows of the same ``by`` with a smaller ``place``.

    ``place`` is a non-negative integer, once per ``by``. Rows are totalled in runs of :data:`RUN` places,
    so that no task sees more than one run and the table of runs is that much smaller.
    """
    runs = counted.withColumn("__run", F.floor(F.col(place) / RUN).cast("long"))
    totals = runs.groupBy(*by, "__run").agg(F.sum(amount).alias("__sum"))
    before = Window.partitionBy(*by).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    above = totals.select(
        *[F.col(c).alias(f"__{c}") for c in by],
        F.col("__run").alias("__run_of"),
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).cast("long").alias("__above"),
    )
    same: Column = F.col("__run") == F.col("__run_of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    inside = Window.partitionBy(*by, "__run").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return (
        runs.join(above, same)
        .withColumn(name, (F.col("__above") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).cast("long"))
        .drop("__run", "__run_of", "__above", *[f"__{c}" for c in by])
    )


def total(df: DataFrame, *amounts: Column) -> list[int]:
    """Sums over all rows, 0 for an empty table."""
    row = df.agg(*[F.sum(a).alias(f"a{i}") for i, a in enumerate(amounts)]).first()
    return [int(x or 0) for x in row]


class Scratch:
    """Tables in the shared folder that an operator needs for a while and then drops."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{checkpoint_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def table(self, df: DataFrame, name: str = "table") -> DataFrame:
        """``df`` as a table. Unlike a cached frame it survives lost executors and has a known size."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def done(self, *tables: DataFrame) -> None:
        """Drop tables of this scratch whose last reader has been written."""
        for table in tables:
            self._delete(self.paths.pop(id(table))[1])

    def drop(self) -> None:
        self.paths.clear()
        self._delete(self.folder)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (``a``, ``b``): ``node``, ``component`` (its smallest node).

    Alternating stars: every larger neighbour of a node is linked to the node's least neighbour, then every
    smaller one. Minima come from partial aggregates, so a node with very many links is no burden. The
    number of rounds grows with the logarithm of the number of nodes. Nodes without a link don't come out.
    """
    scratch = Scratch(spark)
    edges = scratch.table(
        links.filter("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()
    )
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        seen = mark
        both = edges.union(edges.select("high", "low"))
        least = both.groupBy(F.col("low").alias("u")).agg(F.min("high").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: neighbours above u go to u's least neighbour.
        large = edges.join(least, F.col("low") == F.col("u")).select(F.col("m").alias("low"), "high").filter("low < high").distinct()
        # Small star: u and its smaller neighbours go to the least of them.
        under = large.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
        small = large.join(under, F.col("high") == F.col("u"))
        edges = scratch.table(
            small.select(F.col("m").alias("low"), F.col("low").alias("high"))
            .union(under.select("m", "u").toDF("low", "high"))
            .filter("low < high")
            .distinct()
        )
    found = edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(edges.select("low", "low").distinct())
    found = Scratch(spark).table(found, "components")
    scratch.drop()
    return found
