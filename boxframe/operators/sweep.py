"""Threshold ladder, metrics per threshold, and the choice of reference thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxframe.functions.boxes import SMALL_AREA_MAX, box_area, is_small, ratio
from boxframe.operators.matching import CROWDED_PAIRS, match_detections
from boxframe.operators.ranking import HOT_ROWS

# The default sweep.
DEFAULT_LADDER = {"start": 0.05, "stop": 0.95, "step": 0.05, "include": 0.25}
METRIC_COLUMNS = (
    "threshold",
    "images",
    "ground_truth",
    "predictions",
    "true_positives",
    "false_positives",
    "false_negatives",
    "precision",
    "recall",
    "f1",
    "false_negative_rate",
    "false_positives_per_image",
    "images_with_false_negatives",
    "fraction_of_images_with_false_negatives",
    "small_object_ground_truth_count",
    "small_object_true_positives",
    "small_object_false_negatives",
    "small_object_recall",
    "small_object_false_negative_rate",
)
TIE_SLACK = 1e-12


def ladder_values(
    start: float, stop: float, step: float, include: float | None = None
) -> list[float]:
    """Inclusive decimal-exact series plus one more value, sorted and distinct."""
    ok = 0.0 <= start <= stop <= 1.0 and step > 0.0
    if not ok or (include is not None and not 0.0 <= include <= 1.0):
        raise ValueError("invalid threshold ladder")
    first, last, gap = Decimal(str(start)), Decimal(str(stop)), Decimal(str(step))
    count = int((last - first) // gap) + 1
    values = {first + i * gap for i in range(count)}
    if include is not None:
        values.add(Decimal(str(include)))
    return [float(v) for v in sorted(values)]


def threshold_ladder(spark: SparkSession, thresholds: Sequence[float]) -> DataFrame:
    """``(step, threshold)``, step 1 being the lowest."""
    rows = ", ".join(f"({i + 1}, {float(t)!r}D)" for i, t in enumerate(sorted(set(thresholds))))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS ladder(step, threshold)")


def steps_reached(confidence: Column, thresholds: Sequence[float]) -> Column:
    """How many ladder values a confidence reaches. Compares, never divides."""
    total = F.lit(0)
    for value in sorted(set(thresholds)):
        total = total + F.when(confidence >= F.lit(float(value)), 1).otherwise(0)
    return total


def sweep(
    gt: DataFrame,
    pred: DataFrame,
    images: DataFrame,
    thresholds: Sequence[float],
    iou_threshold: float = 0.5,
    small_area: float = SMALL_AREA_MAX,
    crowded_pairs: int = CROWDED_PAIRS,
    hot_rows: int = HOT_ROWS,
    matches: DataFrame | None = None,
) -> DataFrame:
    """The 19 metric columns, one row per threshold.

    One matching at the lowest threshold serves all of them. Everything is then counted per ladder
    step, so the last join sees one row per step.
    """
    lowest = min(thresholds)
    if matches is None:
        matches = match_detections(gt, pred, iou_threshold, lowest, crowded_pairs, hot_rows)
    spark = gt.sparkSession
    counts = _count_per_step(gt, pred, matches, thresholds, small_area)
    # At most one row per ladder step from here on.
    everything = Window.partitionBy()
    totals = ("ground_truth", "small_gt", "images_with_gt")
    running = ("predictions", "tp", "small_tp", "clean_images")
    # Step 0 is reached by everything and every ladder step needs a row, so start from empty rows.
    ladder = threshold_ladder(spark, thresholds)
    blank = ladder.select(
        F.col("step").alias("reach"), *[F.lit(0).cast("bigint").alias(c) for c in (*running, *totals)]
    )
    cumulative = (
        counts.unionByName(blank)
        .withColumns({c: F.sum(c).over(everything) for c in totals})
        .withColumn("step", F.explode(F.sequence(F.lit(0), "reach")))
        .groupBy("step")
        .agg(*[F.sum(c).alias(c) for c in running], *[F.max(c).alias(c) for c in totals])
    )
    rows = ladder.join(cumulative, "step")
    n_images = images.agg(F.count("*").alias("images")).scalar()
    return _metric_columns(rows.withColumn("images", n_images))


def _count_per_step(
    gt: DataFrame,
    pred: DataFrame,
    matches: DataFrame,
    thresholds: Sequence[float],
    small_area: float,
) -> DataFrame:
    """Totals per number of ladder steps reached, in one chain of two aggregates.

    A match counts twice: for its step, and for its image, whose lowest matched confidence says up to
    which step it has no false negative. Area and confidence travel with the match, so nothing is
    joined back and the matching itself runs once.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    nothing = F.lit(None)
    image_type = gt.schema["image_id"].dataType
    area = box_area(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))

    def small(value: Column) -> Column:
        return F.when(is_small(value, small_area), one).otherwise(zero)

    names = ("image_id", "reach", "confidence", "predictions", "tp", "small_tp", "targets", "hits",
             "small_gt")

    def row(**given: Column) -> list[Column]:
        kinds = {"image_id": image_type, "reach": "int", "confidence": "double"}
        return [
            given.get(n, nothing.cast(kinds[n]) if n in kinds else zero)
            .cast(kinds.get(n, "bigint"))
            .alias(n)
            for n in names
        ]

    reach = steps_reached(F.col("confidence"), thresholds)
    by_step = F.struct(*row(reach=reach, tp=one, small_tp=small(F.col("gt_area"))))
    by_image = F.struct(*row(image_id=F.col("image_id"), confidence=F.col("confidence"), hits=one))
    rows = (
        matches.select(F.inline(F.array(by_step, by_image)))
        .unionByName(pred.select(*row(reach=reach, predictions=one)))
        .unionByName(
            gt.select(*row(image_id=F.col("image_id"), targets=one, small_gt=small(area)))
        )
    )
    sums = ("predictions", "tp", "small_tp", "targets", "hits", "small_gt")
    grouped = rows.groupBy("image_id", "reach").agg(
        *[F.sum(c).alias(c) for c in sums], F.min("confidence").alias("confidence")
    )
    is_image = F.col("reach").isNull()
    all_hit = F.col("hits") == F.col("targets")
    image_reach = F.when(all_hit, steps_reached(F.col("confidence"), thresholds)).otherwise(0)
    return (
        grouped.select(
            F.when(is_image, image_reach).otherwise(F.col("reach")).alias("reach"),
            "predictions",
            "tp",
            "small_tp",
            F.col("targets").alias("ground_truth"),
            "small_gt",
            F.when(is_image, one).otherwise(zero).alias("images_with_gt"),
        )
        .withColumn("clean_images", F.col("images_with_gt"))
        .groupBy("reach")
        .agg(
            *[
                F.sum(c).alias(c)
                for c in ("predictions", "tp", "small_tp", "clean_images", "ground_truth",
                          "small_gt", "images_with_gt")
            ]
        )
    )


def _metric_columns(rows: DataFrame) -> DataFrame:
    tp, preds, truth = F.col("tp"), F.col("predictions"), F.col("ground_truth")
    fp, fn = preds - tp, truth - tp
    small_tp, small_gt = F.col("small_tp"), F.col("small_gt")
    missed = F.col("images_with_gt") - F.col("clean_images")
    precision, recall = ratio(tp, preds), ratio(tp, truth)
    return rows.select(
        "threshold",
        "images",
        "ground_truth",
        "predictions",
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        fn.alias("false_negatives"),
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(F.lit(2.0) * precision * recall, precision + recall).alias("f1"),
        ratio(fn, truth).alias("false_negative_rate"),
        ratio(fp, F.col("images")).alias("false_positives_per_image"),
        missed.alias("images_with_false_negatives"),
        ratio(missed, F.col("images")).alias("fraction_of_images_with_false_negatives"),
        small_gt.alias("small_object_ground_truth_count"),
        small_tp.alias("small_object_true_positives"),
        (small_gt - small_tp).alias("small_object_false_negatives"),
        ratio(small_tp, small_gt).alias("small_object_recall"),
        ratio(small_gt - small_tp, small_gt).alias("small_object_false_negative_rate"),
    )


def reference_columns(rows: DataFrame, recall_tolerance: float = 0.01) -> tuple[DataFrame, dict[str, Column]]:
    """Sweep rows with the top recall added, and the aggregates that pick the three references."""
    # One row per ladder value, so a single partition is the right size.
    best = rows.withColumn("top_recall", F.max("recall").over(Window.partitionBy()))
    t = F.col("threshold")
    near_top = F.abs(F.col("recall") - F.col("top_recall")) <= TIE_SLACK
    high = F.col("recall") >= F.col("top_recall") - recall_tolerance
    calm = F.when(high, F.struct("false_positives_per_image", -t))
    return best, {
        "balanced_high_recall_threshold": F.min_by("threshold", calm),
        "best_f1_threshold": F.max_by("threshold", F.struct("f1", "threshold")),
        "max_recall_threshold": F.max(F.when(near_top, t)),
    }


def threshold_references(rows: DataFrame, recall_tolerance: float = 0.01) -> DataFrame:
    """One row: the best-F1, highest full-recall and balanced high-recall thresholds."""
    best, picks = reference_columns(rows, recall_tolerance)
    return best.agg(*[pick.alias(name) for name, pick in picks.items()])


def the_only_row(rows: DataFrame, message: str) -> DataFrame:
    """``rows``, which must be one; the job fails with ``message`` for none or several."""
    row = F.max(F.struct(*rows.columns)).alias("row")
    one = rows.agg(F.count("*").alias("n"), row)
    checked = F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(F.lit(message)))
    return one.select(checked.alias("row")).select("row.*")


def select_row(rows: DataFrame, threshold: float) -> DataFrame:
    """The sweep row of one threshold; a missing or repeated one is an error."""
    wanted = rows.filter(F.abs(F.col("threshold") - F.lit(float(threshold))) <= TIE_SLACK)
    return the_only_row(wanted, f"the sweep has no single row for the threshold {threshold}")


def evaluation_thresholds(
    split: str,
    locked: float | None = None,
    selection_split: str = "val",
    final_split: str = "test",
    default: float = DEFAULT_LADDER["include"],
    ladder: dict[str, float] | None = None,
) -> tuple[list[float], float, bool]:
    """Thresholds to evaluate, the selected one, and whether a choice may be made on this split."""
    if split not in (selection_split, final_split):
        raise ValueError("the split must be the selection or the final one")
    if split == final_split and locked is None:
        raise ValueError("the final split needs a locked threshold")
    if locked is not None and not 0.0 <= locked <= 1.0:
        raise ValueError("the locked threshold must be within [0, 1]")
    if split == final_split:
        return [float(locked)], float(locked), False
    values = ladder_values(**{**DEFAULT_LADDER, "include": default, **(ladder or {})})
    if locked is not None and locked not in values:
        values = sorted([*values, float(locked)])
    return values, default if locked is None else float(locked), True
