"""Exact quantiles and distributions with linear interpolation at ``(n - 1) * q``.

The values are written once. The built-in ``percentile`` keeps every distinct value of a group in one task, which is
right for ordinary groups. For groups above ``hot_rows``, mergeable rank sketches bracket each wanted rank; one more
scan counts what lies below the bracket and keeps the distinct values inside. A bracket that still holds too many
is cut at evenly spaced ranks of its own distinct values, whatever their sizes, until it is small. Sketches only
choose brackets: counts are exact, and a bracket that missed its rank is replaced by the whole range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.operators.checkpoints import cut_lineage
from boxframe.operators.ranking import HOT_ROWS

#: Size of a sketch, and how far from a wanted rank (as a share) the bracket's ends are. A sketch of this size is off
#: by less than half of that nearly always.
SKETCH, MARGIN = 2048, 0.006
#: Pieces that a large bracket is cut into.
PIECES = 256


def _sketch() -> Column:
    return F.kll_sketch_agg_double("value", F.lit(SKETCH))


def _summaries(rows: DataFrame, keys: Sequence[str], few_groups: bool) -> DataFrame:
    """Count, extremes, mean and, for few groups, a rank sketch of each group, in one scan."""
    measures = [F.count("*").alias("n"), F.min("value").alias("minimum"), F.max("value").alias("maximum"), F.avg("value").alias("mean")]
    if few_groups:
        measures.append(_sketch().alias("sketch"))
    return cut_lineage(rows.groupBy(*keys).agg(*measures))


def _brackets(stats: DataFrame, keys: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """Wanted ranks of each group with values that very probably enclose them. A row for each group and quantile."""
    wanted = []
    for name, q in quantiles.items():
        position = (F.col("n") - 1) * F.lit(float(q))
        low, high = (F.kll_sketch_get_quantile_double("sketch", F.lit(min(max(q + d, 0.0), 1.0))) for d in (-MARGIN, MARGIN))
        wanted.append(
            F.struct(
                F.lit(name).alias("name"),
                F.floor(position).alias("lower"),
                F.ceil(position).alias("upper"),
                (position - F.floor(position)).alias("weight"),
                F.when(F.lit(q <= MARGIN), F.col("minimum")).otherwise(low).alias("lo"),
                F.when(F.lit(q >= 1 - MARGIN), F.col("maximum")).otherwise(high).alias("hi"),
            )
        )
    return stats.select(*keys, "minimum", "maximum", F.inline(F.array(*wanted)))


def _scan(rows: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct values inside each bracket with their counts, and a row of the null value for all below."""
    met = rows.join(brackets.select(*keys, "name", "lo", "hi"), list(keys)).filter(F.col("value") <= F.col("hi"))
    cell = F.when(F.col("value") >= F.col("lo"), F.col("value"))
    return cut_lineage(met.groupBy(*keys, "name", cell.alias("value")).agg(F.count("*").alias("n")))


def _placed(cells: DataFrame, brackets: DataFrame, ids: list[str]) -> DataFrame:
    """Brackets with the counts below and inside."""
    counts = cells.groupBy(*ids).agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("below"), F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("inside"))
    held = brackets.join(counts, ids, "left")
    return held.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("below", "inside")})


def _narrowed(cells: DataFrame, wanted: DataFrame, ids: list[str], hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Cut brackets of more than ``hot_rows`` distinct values down to the pieces that hold their ranks."""
    at = [F.lit(i / PIECES) for i in range(1, PIECES)]
    while True:
        large = cut_lineage(cells.groupBy(*ids).agg(F.count("*").alias("m")).filter(F.col("m") > hot_rows).drop("m"))
        if large.isEmpty():
            return cells, wanted
        hot = cells.join(large, ids)
        cuts = cut_lineage(hot.groupBy(*ids).agg(_sketch().alias("sketch")).select(*ids, F.kll_sketch_get_quantile_double("sketch", F.array(*at)).alias("cuts")))
        # The number of cuts that a value has reached.
        piece = F.size(F.filter("cuts", lambda c: c <= F.col("value")))
        cut = hot.join(cuts, ids).withColumn("piece", piece).drop("cuts")
        sizes = cut.groupBy(*ids, "piece").agg(F.sum("n").alias("size"))
        before = Window.partitionBy(*ids).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        placed = sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0))).join(wanted, ids)
        start = F.col("below") + F.col("start")
        holds = (start <= F.col("upper")) & (F.col("lower") < start + F.col("size"))
        found = cut_lineage(placed.filter(holds).groupBy(*ids).agg(F.min("piece").alias("first"), F.max("piece").alias("last"), F.min(start).alias("now_below")))
        inside = cut.join(found, ids).filter(F.col("piece").between(F.col("first"), F.col("last")))
        cells = cut_lineage(cells.join(large, ids, "left_anti").unionByName(inside.select(*cells.columns)))
        below = F.coalesce("now_below", "below")
        wanted = cut_lineage(wanted.join(found, ids, "left").withColumn("below", below).select(*wanted.columns))


def _hot_quantiles(rows: DataFrame, stats: DataFrame, keys: list[str], quantiles: dict[str, float], hot_rows: int) -> DataFrame:
    ids = [*keys, "name"]
    brackets = cut_lineage(_brackets(stats, keys, quantiles))
    cells = _scan(rows, brackets, keys)
    wanted = cut_lineage(_placed(cells, brackets, ids))
    hit = (F.col("below") <= F.col("lower")) & (F.col("upper") < F.col("below") + F.col("inside"))
    missed = cut_lineage(wanted.filter(~hit).select(*[c for c in brackets.columns if c not in ("lo", "hi")], F.col("minimum").alias("lo"), F.col("maximum").alias("hi")))
    if not missed.isEmpty():
        again = _scan(rows, missed, keys)
        cells = cells.join(missed.select(*ids), ids, "left_anti").unionByName(again)
        wanted = cut_lineage(wanted.filter(hit).unionByName(_placed(again, missed, ids)))
    inside, wanted = _narrowed(cells.filter("value is not null"), wanted, ids, hot_rows)
    upto = Window.partitionBy(*ids).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = inside.withColumn("end", F.sum("n").over(upto)).join(wanted, ids).withColumn("end", F.col("end") + F.col("below"))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col(rank) < F.col("end")) & (F.col(rank) >= F.col("end") - F.col("n")), F.col("value")))

    solved = ended.groupBy(*ids).agg(at("lower").alias("v0"), at("upper").alias("v1"), F.first("weight").alias("weight"))
    mixed = F.col("v0") * (1 - F.col("weight")) + F.col("v1") * F.col("weight")
    return solved.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == name, mixed)).alias(name) for name in quantiles])


def _quantiles(rows: DataFrame, stats: DataFrame, keys: list[str], quantiles: dict[str, float], hot_rows: int) -> DataFrame:
    """One row per group. ``rows`` (``keys``, ``value``) and ``stats`` are written tables."""

    def plain(part: DataFrame) -> DataFrame:
        return part.groupBy(*keys).agg(*[F.percentile("value", F.lit(float(q))).alias(name) for name, q in quantiles.items()])

    hot = stats.filter(F.col("n") > hot_rows)
    groups, hot_groups = stats.agg(F.count("*"), F.count_if(F.col("n") > hot_rows)).first()
    if not hot_groups:
        return plain(rows)
    names = hot.select(*keys)
    whole = hot_groups == groups
    large = rows if whole else rows.join(names, keys, "left_semi")
    if "sketch" not in stats.columns:
        hot = cut_lineage(hot.join(large.groupBy(*keys).agg(_sketch().alias("sketch")), keys))
    solved = _hot_quantiles(large, hot, keys, quantiles, hot_rows)
    return solved if whole else plain(rows.join(names, keys, "left_anti")).unionByName(solved)


def exact_quantiles(
    df: DataFrame,
    value: Column,
    quantiles: dict[str, float],
    by: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    written: bool = False,
) -> DataFrame:
    """One row per group with a column per named quantile; nulls are ignored.

    ``written``: ``df`` is a table that is cheap to read again; else the value column is written first.
    """
    keys = list(by) or ["_all"]
    rows = df.select(*(by or [F.lit(0).alias("_all")]), value.cast("double").alias("value")).filter("value is not null")
    rows = rows if written else cut_lineage(rows)
    result = _quantiles(rows, _summaries(rows, keys, not by), keys, quantiles, hot_rows)
    return result if by else result.drop("_all")


def distribution(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Count, minimum, maximum, mean, median and 95th percentile of each column.

    One row per group and column name (``measure``); with no values the count is 0 and the rest
    null. Columns are unpivoted first, so the input is read once whatever their number.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    long = df.select(*by, F.inline(pairs))
    keys = [*by, "measure"]
    rows = cut_lineage(long.filter("value is not null"))
    stats = _summaries(rows, keys, not by)
    spread = _quantiles(rows, stats, keys, {"median": 0.5, "p95": 0.95}, hot_rows)
    stats = stats.drop("sketch")
    if by:
        # A group without any value of a measure has a row too.
        stats = df.select(*by).distinct().select(*by, F.explode(F.array(*[F.lit(c) for c in columns])).alias("measure")).join(stats, keys, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    result = stats.join(spread, keys, "left")
    if by:
        return result
    rows = ", ".join(f"('{c}')" for c in columns)
    names = df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS names(measure)")
    return names.join(result, "measure", "left").withColumn("n", F.coalesce("n", F.lit(0)))
