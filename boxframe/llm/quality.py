"""Quality rules whose cutoffs come from quantile sketches of each language and source.

Native throughout: column functions, aggregates, windows over sketch buckets, joins.

A sketch is a table of (group, measure, bucket, count). Buckets are exact below 128 and have a relative
width of 1/64 above, so a measure has a bounded number of them, and sketches merge by adding counts.
A group's cutoff is a fence: a quartile, moved outwards by ``REACH`` interquartile ranges. A language and
source with fewer than ``min_rows`` documents uses the merged sketch of its language, and a language with
fewer uses that of the whole corpus.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.operators.checkpoints import cut_lineage

WORD_GAP = r"[\x20\x09-\x0D]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REACH = 3
MIN_ROWS = 100

#: Integer measures, with the least spread that a fence assumes (a group may hold one value only).
SPREADS = {"length_x100": 50, "symbols_per_100": 2, "dup_line_percent": 15, "repeat_percent": 7}
#: Both tails of the word length are suspicious; of the others only the upper one.
LOWER = ("length_x100",)


def measure(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Columns ``row`` (a struct of ``carry``, all columns by default) and ``base`` (a struct of counts).

    Words are maximal runs of anything but space and U+0009 to U+000D. A null text counts as empty: all
    counts are 0. ``n_repeat_words`` counts words in 8-word windows that the text holds twice or more, the
    first ones included; ``n_dup_lines`` counts lines with a word that equal an earlier line.
    """
    kept = docs.columns if carry is None else list(carry)
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    cut = docs.select(row, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).select(
        "row",
        "text",
        F.array_remove(F.split("text", WORD_GAP), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashed = cut.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.expr(f"transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW})))"),
        ).alias("windows"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # Sorting is only needed where some window occurs twice.
    ordered = hashed.select(
        "row",
        *counts,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.expr("array_sort(transform(windows, (h, i) -> struct(h, i)))"),
        ).alias("ordered"),
    )
    starts = ordered.select(
        "row",
        *counts,
        F.expr(
            "array_sort(transform(filter(ordered, (x, k) -> (k > 0 and ordered[k - 1].h = x.h) or "
            "(k + 1 < size(ordered) and ordered[k + 1].h = x.h)), x -> x.i))"
        ).alias("starts"),
    )
    covered = F.expr(
        f"coalesce(aggregate(transform(starts, (p, k) -> if(k + 1 < size(starts), least({WINDOW}, starts[k + 1] - p),"
        f" {WINDOW})), 0L, (a, b) -> a + b), 0L)"
    )
    return starts.select("row", F.struct(*counts, covered.alias("n_repeat_words")).alias("base"))


def base_failed(base: Column) -> Column:
    """Too few words, or over 30 % of them in repeated windows."""
    return (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])


def measures(base: Column) -> dict[str, Column]:
    """The integer values that sketches hold and fences judge; null for a text without words."""

    def share(part: Column, factor: int, whole: Column) -> Column:
        return F.when(whole > 0, F.floor(part * factor / whole).cast("long"))

    return {
        "length_x100": share(base["word_chars"], 100, base["n_words"]),
        "symbols_per_100": share(base["n_symbols"], 100, base["n_words"]),
        "dup_line_percent": share(base["n_dup_lines"], 100, base["n_lines"]),
        "repeat_percent": share(base["n_repeat_words"], 100, base["n_words"]),
    }


def bucket(value: Column) -> Column:
    """Lower bound of the value's bucket: itself below 128, else cut to its seven leading bits."""
    step = F.pow(F.lit(2.0), F.length(F.bin(value)) - 7).cast("long")
    return F.when(value < 128, value).otherwise(F.floor(value / step).cast("long") * step)


def sketches(measured: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketch of each group: ``keys``, ``measure``, ``bucket``, ``n``. Documents that fail the base are left out."""
    values = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), v.alias("v")) for m, v in measures(F.col("base")).items()])
    )
    rows = measured.filter(~base_failed(F.col("base"))).select(
        *[F.col("row")[k].alias(f"key{i}") for i, k in enumerate(keys)], values.alias("x")
    )
    names = [f"key{i}" for i in range(len(keys))]
    return rows.groupBy(*names, F.col("x.measure").alias("measure"), bucket(F.col("x.v")).alias("bucket")).agg(
        F.count("*").alias("n")
    )


def merge_sketches(parts: DataFrame, names: Sequence[str]) -> DataFrame:
    return parts.groupBy(*names, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(parts: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per group: its number of documents ``n`` and the struct ``fence`` of cutoffs."""
    # A group's buckets are bounded in number, whatever the number of documents.
    each = Window.partitionBy(*names, "measure")
    summed = parts.select(
        *names,
        "measure",
        "bucket",
        F.sum("n").over(each.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(each).alias("total"),
    )
    quartiles = summed.groupBy(*names, "measure", "total").agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"),
    )

    def of(name: str, value: Column) -> Column:
        return F.max(F.when(F.col("measure") == name, value))

    cuts = []
    for name, least in SPREADS.items():
        spread = REACH * F.greatest(F.col("q3") - F.col("q1"), F.lit(least).cast("long"))
        cuts.append(of(name, F.col("q3") + spread).alias(f"{name}_max"))
        if name in LOWER:
            cuts.append(of(name, F.col("q1") - spread).alias(f"{name}_min"))
    return quartiles.groupBy(*names).agg(F.max("total").alias("n"), F.struct(*cuts).alias("fence"))


def adaptive_fences(parts: DataFrame, depth: int, min_rows: int) -> DataFrame:
    """Fences for every group of the finest level, taken from the finest level with enough documents."""
    names = [f"key{i}" for i in range(depth)]
    levels = [fences(parts, names)]
    for k in range(depth - 1, -1, -1):
        levels.append(fences(merge_sketches(parts, names[:k]), names[:k]))
    found = levels[0].select(*names, F.struct("n", "fence").alias("level0"))
    for i, level in enumerate(levels[1:], start=1):
        side = level.select(*[F.col(n).alias(f"other_{n}") for n in names[: depth - i]], F.struct("n", "fence").alias(f"level{i}"))
        same = [F.col(n).eqNullSafe(F.col(f"other_{n}")) for n in names[: depth - i]]
        if same:
            condition = same[0]
            for more in same[1:]:
                condition = condition & more
            found = found.join(side, condition, "left").drop(*[f"other_{n}" for n in names[: depth - i]])
        else:
            # The sketch of the whole corpus gives at most one row.
            found = found.join(side, F.lit(True), "left")
    chosen = F.coalesce(
        *[F.when(F.col(f"level{i}.n") >= min_rows, F.col(f"level{i}.fence")) for i in range(depth)],
        F.col(f"level{depth}.fence"),
    )
    return found.select(*names, chosen.alias("fence"))


def verdict(base: Column, fence: Column) -> Column:
    """True where every measure lies within its fence."""
    inside = F.lit(True)
    for name, value in measures(base).items():
        inside = inside & (value <= fence[f"{name}_max"])
        if name in LOWER:
            inside = inside & (value >= fence[f"{name}_min"])
    return inside


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    keys: Sequence[str] = ("lang", "source"),
    carry: Sequence[str] | None = None,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Judge every document: ``row`` (its columns, or those of ``carry``), ``base``, ``base_failed``, ``kept``.

    Null keys form a group of their own, like any value. Repeated rows are judged alike, each for itself.
    An empty table gives an empty result. Columns of the input stay inside ``row``, so their names can't
    clash with those of the result.

    Counting is the costly step, so its result is written once; sketches and verdicts read that table. The
    fences are written too: with their size known, Spark broadcasts them if they lie under its threshold
    and shuffles otherwise.
    """
    kept = list(docs.columns if carry is None else carry)
    measured = cut_lineage(measure(docs, text, kept + [k for k in keys if k not in kept]))
    cuts = cut_lineage(adaptive_fences(sketches(measured, keys), len(keys), min_rows))
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & F.col("row")[key].eqNullSafe(F.col(f"key{i}"))
    judged = measured.join(cuts, same, "left")
    failed = base_failed(F.col("base"))
    return judged.select(
        F.struct(*[F.col("row")[c].alias(c) for c in kept]).alias("row"),
        "base",
        failed.alias("base_failed"),
        (~failed & F.coalesce(verdict(F.col("base"), F.col("fence")), F.lit(False))).alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text", keys: Sequence[str] = ("lang", "source"), min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with their columns as they were."""
    return quality_rules(docs, text, keys, min_rows=min_rows).filter("kept").select("row.*")
