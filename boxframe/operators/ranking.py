"""Ranks, running totals and exact cuts that never put one large group into one task.

A plain window sorts a whole group in a single task. The operators here first count the groups (one
aggregate over the key columns). With no group above ``hot_rows`` they are the plain window. A larger
group is cut into buckets that follow its order, each bucket is ranked on its own, and the bucket
sizes (a small aggregate) give the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.operators.checkpoints import cut_lineage

HOT_ROWS = 1_000_000


#: Groups are first counted by this many hash values of their keys.
_HASHES = 1 << 16


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, rows: Column | None = None) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None; never more than ``rows / hot_rows`` of them.

    Rows are counted by a hash of the keys first, which sends at most 65,536 counts a task. Only rows whose hash has
    that many are counted by the keys themselves. ``rows`` is what a row of ``df`` counts for, if not one.
    """
    count = F.sum(F.lit(1) if rows is None else rows)
    hashed = F.pmod(F.xxhash64(*keys), F.lit(_HASHES)).alias("_hash")
    counted = df.select("*", hashed)
    full = cut_lineage(counted.groupBy("_hash").agg(count.alias("_n")).filter(F.col("_n") > hot_rows).select("_hash"))
    if full.isEmpty():
        return None
    within = counted.join(full, "_hash", "left_semi")
    hot = cut_lineage(within.groupBy(*keys).agg(count.alias("_n")).filter(F.col("_n") > hot_rows).drop("_n"))
    return None if hot.isEmpty() else hot


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, sized: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of large groups or None when there is no large group.

    ``sized`` has the keys and in ``_rows`` numbers that add up to at least the rows of each group; without it the
    rows are counted.
    """
    hot = hot_keys(df, keys, hot_rows) if sized is None else hot_keys(sized, keys, hot_rows, F.col("_rows"))
    if hot is None:
        return df, None
    return df.join(hot, list(keys), "left_anti"), df.join(hot, list(keys), "left_semi")


def _bucket_offsets(
    df: DataFrame, keys: Sequence[str], levels: Sequence[str], amounts: dict[str, Column]
) -> DataFrame:
    """Per bucket, the totals of the amounts in the earlier buckets of the same group."""
    sizes = df.groupBy(*keys, *levels).agg(*[F.sum(a).alias(n) for n, a in amounts.items()])
    result = None
    for depth in range(len(levels)):
        scope = [*keys, *levels[:depth]]
        by = [*scope, levels[depth]]
        level_sizes = sizes.groupBy(*by).agg(*[F.sum(n).alias(n) for n in amounts])
        before = (
            Window.partitionBy(*scope)
            .orderBy(levels[depth])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        offsets = level_sizes.select(
            *by,
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}{depth}") for n in amounts],
        )
        result = offsets if result is None else offsets.join(result, scope)

    def total(name: str) -> Column:
        parts = [F.col(f"{name}{d}") for d in range(len(levels))]
        return sum(parts[1:], parts[0]).alias(name)

    return result.select(*keys, *levels, *[total(n) for n in amounts])


def grouped_row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    levels: Sequence[Column],
    out: str = "row_number",
    hot_rows: int = HOT_ROWS,
    sized: DataFrame | None = None,
) -> DataFrame:
    """``row_number`` within ``keys``; ``sized`` as for :func:`split_hot`.

    ``levels`` are expressions that never decrease along ``order``: the first over the whole group,
    each further one among rows that agree on those before it. They cut large groups into buckets.
    """
    normal, hot = split_hot(df, keys, hot_rows, sized)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = normal.withColumn(out, place.cast("bigint"))
    if hot is None:
        return ranked
    names = [f"_level{i}" for i in range(len(levels))]
    cut = hot.withColumns(dict(zip(names, levels)))
    offsets = _bucket_offsets(cut, keys, names, {"_offset": F.lit(1)})
    local = F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*order))
    ranked_hot = (
        cut.withColumn("_local", local)
        .join(offsets, [*keys, *names])
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .select(*ranked.columns)
    )
    return ranked.unionByName(ranked_hot)


def grouped_running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    levels: Sequence[Column],
    amounts: dict[str, str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Running totals within ``keys``, the current row included.

    ``amounts`` maps the name of each total to the column it adds up.
    """
    normal, hot = split_hot(df, keys, hot_rows)

    def running(amount: str, *by: str) -> Column:
        window = Window.partitionBy(*by).orderBy(*order)
        return F.sum(amount).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    summed = normal.withColumns({n: running(a, *keys) for n, a in amounts.items()})
    if hot is None:
        return summed
    names = [f"_level{i}" for i in range(len(levels))]
    cut = hot.withColumns(dict(zip(names, levels)))
    offsets = _bucket_offsets(
        cut, keys, names, {f"_before_{n}": F.col(a) for n, a in amounts.items()}
    )
    summed_hot = (
        cut.withColumns({f"_local_{n}": running(a, *keys, *names) for n, a in amounts.items()})
        .join(offsets, [*keys, *names])
        .withColumns({n: F.col(f"_local_{n}") + F.col(f"_before_{n}") for n in amounts})
        .select(*summed.columns)
    )
    return summed.unionByName(summed_hot)


def label_by_hash_rank(
    ids: DataFrame,
    id_col: str,
    seed: int,
    sizes: Sequence[tuple[str, Column]],
    rest: str,
    out: str,
    minimum: int = 1,
) -> DataFrame:
    """Give the first ``n1`` IDs in seeded hash order one label, the next ``n2`` another, and so on.

    The counts are exact and the result does not depend on the input order. ``sizes`` are
    expressions over ``total``, the number of IDs. Rows are counted per hash prefix (at most 65,536
    of them); only the prefixes that a cut falls into are ranked, so no task sees the whole set.
    """
    hashed = ids.select(
        *ids.columns,
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256).alias("_hash"),
    ).withColumn("_bucket", F.conv(F.substring("_hash", 1, 4), 16, 10).cast("int"))
    # Counted, labelled and ranked below: worked out once.
    hashed = cut_lineage(hashed)
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_count"))
    # At most 65,536 rows by construction, so one partition is enough here.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    table = counts.select(
        "_bucket",
        "_count",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"),
        F.sum("_count").over(everything).alias("total"),
    )
    table = table.withColumn(
        "total",
        F.when(
            F.col("total") < minimum,
            F.raise_error(F.lit(f"at least {minimum} IDs are needed")).cast("bigint"),
        ).otherwise(F.col("total")),
    )
    ends, previous = [], F.lit(0).cast("bigint")
    for i, (_, size) in enumerate(sizes):
        table = table.withColumn(f"_end{i}", previous + size)
        previous = F.col(f"_end{i}")
        ends.append(previous)
    inside = F.lit(False)
    for end in ends:
        inside = inside | ((F.col("_before") < end) & (end < F.col("_before") + F.col("_count")))
    table = table.withColumn("_cut", inside)

    def label(position: Column) -> Column:
        result = F.when(position <= ends[0], sizes[0][0])
        for (name, _), end in zip(sizes[1:], ends[1:]):
            result = result.when(position <= end, name)
        return result.otherwise(rest)

    table = cut_lineage(table)
    # Broadcast: one row per hash prefix, at most 65,536.
    placed = hashed.join(F.broadcast(table), "_bucket")
    whole = placed.filter(~F.col("_cut")).withColumn(out, label(F.col("_before") + 1))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", id_col))
    split = (
        placed.filter("_cut")
        .withColumn("_rank", within)
        .withColumn(out, label(F.col("_before") + F.col("_rank")))
    )
    columns = [*ids.columns, out]
    return whole.select(*columns).unionByName(split.select(*columns))
