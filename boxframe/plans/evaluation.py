"""Evaluation of one split: checks, sweep, choice of thresholds, and the metrics document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.functions.boxes import SMALL_AREA_MAX, box_problem
from boxframe.operators.matching import coverage
from boxframe.operators.sweep import (
    TIE_SLACK,
    evaluation_thresholds,
    reference_columns,
    select_row,
    sweep,
    threshold_references,
)

_CORNERS = ("x1", "y1", "x2", "y2")


@dataclass(frozen=True)
class Evaluation:
    """Sweep rows, the chosen row, reference thresholds and the problems of one split."""

    rows: DataFrame
    selected: DataFrame
    references: DataFrame
    problems: DataFrame
    selection_allowed: bool


def _gt_problem() -> Column:
    return box_problem(*[F.col(c) for c in _CORNERS], F.col("class_id"), None)


def _pred_problem() -> Column:
    confidence = F.col("confidence")
    rule = box_problem(*[F.col(c) for c in _CORNERS], F.lit(0), confidence)
    return F.coalesce(rule, F.when(confidence.isNull(), "confidence_outside_unit_interval"))


def evaluation_problems(
    gt: DataFrame, pred: DataFrame, images: DataFrame, split: str, results: DataFrame | None = None
) -> DataFrame:
    """``(image_id, problem, n)``: what keeps a split from being evaluated.

    Images without a result, results without an image, repeated results (``missing``, ``extra``,
    ``duplicate``), invalid boxes of either side by their first broken rule, and ``empty_split``
    without an image.
    """
    ids = images.filter(F.col("split") == split).select("image_id")
    covered = coverage(ids, ids if results is None else results)

    def invalid(boxes: DataFrame, problem: Column, side: str) -> DataFrame:
        broken = boxes.join(ids, "image_id", "left_semi").withColumn("_p", problem).filter("_p is not null")
        counted = broken.groupBy("image_id", "_p").agg(F.count("*").alias("n"))
        return counted.select("image_id", F.concat(F.lit(f"{side}_"), "_p").alias("problem"), "n")

    kind = images.schema["image_id"].dataType
    empty = ids.agg(F.count("*").alias("_n")).filter("_n = 0")
    empty = empty.select(F.lit(None).cast(kind).alias("image_id"), F.lit("empty_split").alias("problem"), F.lit(1).cast("bigint").alias("n"))
    return (
        covered.withColumn("n", F.lit(1).cast("bigint"))
        .unionByName(invalid(gt, _gt_problem(), "target"))
        .unionByName(invalid(pred, _pred_problem(), "prediction"))
        .unionByName(empty)
    )


def evaluate(
    gt: DataFrame,
    pred: DataFrame,
    images: DataFrame,
    split: str,
    locked_threshold: float | None = None,
    results: DataFrame | None = None,
    iou_threshold: float = 0.5,
    small_area: float = SMALL_AREA_MAX,
    ladder: dict[str, float] | None = None,
) -> Evaluation:
    """Evaluate a split. The final split takes one locked threshold and allows no choice.

    ``results`` lists the images that were scored (``image_id``), for the coverage check; an image
    may well have been scored without any box. Invalid boxes are listed in ``problems`` and never
    matched; call :func:`assert_evaluable` to stop at any problem.
    """
    thresholds, chosen, may_choose = evaluation_thresholds(split, locked_threshold, ladder=ladder)
    wanted = images.filter(F.col("split") == split)
    ids = wanted.select("image_id")
    rows = sweep(
        gt.join(ids, "image_id", "left_semi").filter(_gt_problem().isNull()),
        pred.join(ids, "image_id", "left_semi").filter(_pred_problem().isNull()),
        wanted,
        thresholds,
        iou_threshold,
        small_area,
    )
    selected = select_row(rows, chosen)
    if may_choose:
        references = threshold_references(rows)
    else:
        names = ("balanced_high_recall_threshold", "best_f1_threshold", "max_recall_threshold")
        references = rows.select(*[F.lit(chosen).alias(n) for n in names]).limit(1)
    problems = evaluation_problems(gt, pred, images, split, results)
    return Evaluation(rows, selected, references, problems, may_choose)


def assert_evaluable(evaluation: Evaluation, shown: int = 10) -> None:
    """Raise with the first problems where there are any."""
    found = evaluation.problems.orderBy("problem", "image_id").limit(shown).collect()
    if found:
        raise ValueError("not evaluable: " + "; ".join(f"{r.problem} {r.image_id}" for r in found))


def metrics_document(
    rows: DataFrame,
    latency: DataFrame,
    run_id: str,
    split: str,
    selected: float,
    selection_allowed: bool,
    dataset_fingerprint: str | None = None,
    model_sha256: str | None = None,
    iou_threshold: float = 0.5,
    small_area: float = SMALL_AREA_MAX,
    precision: DataFrame | None = None,
) -> DataFrame:
    """One nested row: counts, metrics, latency and reference thresholds of an evaluation.

    ``precision`` is an optional one-row table of average-precision columns, which join the metrics.
    All parts are single rows.
    """
    counts = ("false_negatives", "false_positives", "ground_truth", "images", "predictions",
              "true_positives")
    metric_names = [c for c in rows.columns if c not in (*counts, "threshold")]
    best, picks = reference_columns(rows)
    is_chosen = F.abs(F.col("threshold") - F.lit(float(selected))) <= TIE_SLACK
    # One aggregate over the sweep rows gives the chosen row and the references together.
    chosen = F.max(F.when(is_chosen, F.struct(*rows.columns)))
    missing = F.raise_error(F.lit(f"the sweep has no single row for the threshold {selected}"))
    one = best.agg(
        F.when(F.count_if(is_chosen) == 1, chosen).otherwise(missing).alias("row"),
        F.struct(*[pick.alias(name) for name, pick in picks.items()]).alias("threshold_references"),
    )
    extra = {}
    if precision is not None:
        whole = precision.select(F.struct("*")).scalar()
        extra = {c: whole[c] for c in precision.columns}
    metrics = sorted([*metric_names, *extra])
    row = F.col("row")
    return one.select(
        row["threshold"].alias("confidence_threshold"),
        F.struct(*[row[c].alias(c) for c in counts]).alias("counts"),
        F.lit(dataset_fingerprint).alias("dataset_fingerprint"),
        latency.select(F.struct("*")).scalar().alias("latency"),
        F.lit(iou_threshold).alias("matching_iou_threshold"),
        F.struct(*[(extra[c] if c in extra else row[c]).alias(c) for c in metrics]).alias("metrics"),
        F.lit(model_sha256).alias("model_sha256"),
        F.lit(run_id).alias("run_id"),
        F.lit("1.0").alias("schema_version"),
        F.lit(small_area).alias("small_object_max_area_ratio"),
        F.lit(split).alias("split"),
        "threshold_references",
        F.lit(selection_allowed).alias("threshold_selection_allowed"),
    )
