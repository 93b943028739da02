"""Results built on a matching: average precision, examples, recall by size, promotion."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxframe.functions.boxes import area_bucket, box_area, is_small, ratio
from boxframe.operators.checkpoints import cut_lineage
from boxframe.operators.matching import (
    CROWDED_PAIRS,
    false_negatives,
    false_positives,
    match_levels,
)
from boxframe.operators.ranking import HOT_ROWS, grouped_row_number, grouped_running_sums

# Promotion metrics in order of weight, their direction, and the tolerance.
RANKING = (
    ("small_object_recall", 1),
    ("recall", 1),
    ("map50_95", 1),
    ("false_positives_per_image", -1),
    ("p95_inference_latency_ms", -1),
)
TOLERANCE = 0.002
RECALL_POINTS = 101


def average_precision(
    gt: DataFrame,
    pred: DataFrame,
    iou_levels: Sequence[float] = (0.5, 0.75),
    crowded_pairs: int = CROWDED_PAIRS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(iou_threshold, average_precision)`` with 101-point interpolation.

    Predictions are first counted per distinct confidence, so the curve is built from at most one
    row per confidence value; predictions of equal confidence enter together.
    """
    hits = match_levels(gt, pred, iou_levels, crowded_pairs, hot_rows)
    tagged = hits.groupBy("iou_threshold", "confidence").agg(F.count("*").alias("tp"))
    levels = F.explode(F.array(*[F.lit(float(level)) for level in iou_levels]))
    counts = (
        pred.groupBy("confidence")
        .agg(F.count("*").alias("n"))
        .withColumn("iou_threshold", levels)
        .join(tagged, ["iou_threshold", "confidence"], "left")
        .select("iou_threshold", "confidence", "n", F.coalesce("tp", F.lit(0)).alias("tp"))
    )
    truth = gt.agg(F.count("*").alias("n")).scalar()
    curve = _cumulative(counts, hot_rows).withColumns(
        {"recall": ratio(F.col("tp_sum"), truth), "precision": ratio(F.col("tp_sum"), F.col("n_sum"))}
    )
    # Each curve point serves the recall points it reaches; per point the best precision counts.
    # Whole-number division keeps the recall grid exact: recall >= k/100.
    steps = F.col("tp_sum") * (RECALL_POINTS - 1)
    reached = F.floor((steps - steps % truth) / truth).cast("int")
    best = (
        curve.withColumn("point", reached)
        .groupBy("iou_threshold", "point")
        .agg(F.max("precision").alias("precision"))
    )
    served = best.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("point"))))
    envelope = served.groupBy("iou_threshold", "at").agg(F.max("precision").alias("precision"))
    return envelope.groupBy("iou_threshold").agg(
        (F.sum("precision") / RECALL_POINTS).alias("average_precision")
    )


def _cumulative(counts: DataFrame, hot_rows: int) -> DataFrame:
    """Totals at or above each confidence."""
    return grouped_running_sums(
        counts,
        ["iou_threshold"],
        [F.desc("confidence")],
        [F.floor(-F.col("confidence") * 4096), F.floor(-F.col("confidence") * (1 << 26))],
        {"n_sum": "n", "tp_sum": "tp"},
        hot_rows,
    )


def mean_average_precision(levels: DataFrame) -> DataFrame:
    return levels.agg(F.avg("average_precision").alias("map"))


def top_false_positives(pred: DataFrame, matches: DataFrame, n: int = 50) -> DataFrame:
    """The most confident unmatched predictions. Sort and limit become one top-k."""
    wrong = false_positives(pred, matches)
    return wrong.orderBy(F.desc("confidence"), "image_id", "pred_idx").limit(n)


def missed_targets(
    gt: DataFrame, matches: DataFrame, n: int = 50, small_max: float | None = None
) -> DataFrame:
    """Examples of unmatched targets, the largest first; only small ones with ``small_max``."""
    missed = false_negatives(gt, matches).withColumn(
        "area", box_area(*[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    )
    if small_max is not None:
        missed = missed.filter(is_small(F.col("area"), small_max))
    return missed.orderBy(F.desc("area"), "image_id", "gt_idx").limit(n)


def images_by_detections(images: DataFrame, pred: DataFrame, minimum: int = 2) -> DataFrame:
    """``(image_id, n_detections, kind)`` of images with several or without any detection."""
    counts = pred.groupBy("image_id").agg(F.count("*").alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    kind = F.when(n == 0, "none").when(n >= minimum, "several")
    return (
        images.select("image_id")
        .join(counts, "image_id", "left")
        .select("image_id", n.alias("n_detections"), kind.alias("kind"))
        .filter("kind is not null")
    )


def recall_by_bucket(gt: DataFrame, matches: DataFrame) -> DataFrame:
    """Targets, hits and recall per area bucket; hits carry their area, so nothing is joined."""
    area = box_area(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    rows = gt.select(area_bucket(area).alias("bucket"), F.lit(0).alias("hit")).unionByName(
        matches.select(area_bucket(F.col("gt_area")).alias("bucket"), F.lit(1).alias("hit"))
    )
    counted = rows.groupBy("bucket").agg(
        F.count_if(F.col("hit") == 0).alias("ground_truth"),
        F.count_if(F.col("hit") == 1).alias("true_positives"),
    )
    return counted.withColumn("recall", ratio(F.col("true_positives"), F.col("ground_truth")))


def confusion_counts(gt: DataFrame, pred: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: true positives, false positives, false negatives of a matching."""
    tp = matches.agg(F.count("*").alias("n")).scalar()
    n_pred = pred.agg(F.count("*").alias("n")).scalar()
    return gt.agg(F.count("*").alias("_gt")).select(
        tp.alias("true_positives"),
        (n_pred - tp).alias("false_positives"),
        (F.col("_gt") - tp).alias("false_negatives"),
    )


def false_alarms_per_minute(
    pred: DataFrame, matches: DataFrame, frames: DataFrame
) -> DataFrame:
    """Unmatched detections per video and minute.

    ``frames`` is ``(image_id, video_id, timestamp_seconds)``, one row per frame. An image's predictions have
    different indices and ``matches`` are some of them, so the unmatched are what the counts differ by: predictions
    are neither numbered nor joined a second time.
    """
    hits = matches.groupBy("image_id").agg(F.count("*").alias("hits"))
    found = pred.groupBy("image_id").agg(F.count("*").alias("found"))
    wrong = found.join(hits, "image_id", "left").select(
        "image_id", (F.col("found") - F.coalesce("hits", F.lit(0))).alias("n")
    )
    minute = F.floor(F.col("timestamp_seconds") / 60)
    return (
        frames.join(wrong, "image_id", "left")
        .groupBy("video_id", minute.alias("minute"))
        .agg(
            F.count("*").alias("frames"),
            F.sum(F.coalesce("n", F.lit(0))).alias("false_alarms"),
        )
    )


def eligible(runs: DataFrame) -> DataFrame:
    """Runs that may be promoted: finished, evaluated on ``val``, complete and finite."""
    ok = (F.col("status") == "success") & (F.col("split") == "val")
    for name in ("dataset_fingerprint", "model_sha256"):
        ok = ok & F.col(name).isNotNull()
    for name, _ in RANKING:
        ok = ok & (F.abs(F.col(name)) < F.lit(float("inf")))
    return runs.filter(ok)


def _beats(challenger: Column, champion: Column, tolerance: float) -> Column:
    """Lexicographic compare: a metric decides when it differs by more than the tolerance."""
    result = F.lit(False)
    for name, direction in reversed(RANKING):
        gain = (challenger[name] - champion[name]) * direction
        result = (
            F.when(gain > tolerance, True).when(gain < -tolerance, False).otherwise(result)
        )
    return result


def _chunk_finals(part: pa.Table, tolerance: float) -> pa.Table:
    """For each run of a chunk, which of its runs holds the title at the end if that one holds it at its place."""
    part = part.take(pc.sort_indices(part.column("place")))
    runs = part.column("run").combine_chunks()
    gains = np.stack([direction * runs.field(name).to_numpy(zero_copy_only=False).astype(float) for name, direction in RANKING], 1)
    final = np.arange(len(gains))
    for i in range(len(gains) - 2, -1, -1):
        ahead = gains[i + 1 :] - gains[i]
        decides = np.abs(ahead) > tolerance
        first = decides.argmax(1)
        beats = decides.any(1) & (ahead[np.arange(len(ahead)), first] > 0)
        if beats.any():
            final[i] = final[i + 1 + beats.argmax()]
    return pa.table({"dataset_fingerprint": part.column("dataset_fingerprint"), "run": runs, "final": runs.take(pa.array(final))})


def champion(runs: DataFrame, tolerance: float = TOLERANCE, chunk: int = 1024, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Champion per dataset fingerprint: the first eligible run starts, later ones challenge in turn.

    With a tolerance the compare is not transitive, so the runs of a dataset can't be reduced in any order, and
    gathering them would put a large dataset into one task. Instead runs in order are cut into chunks. A chunk says,
    for each of its runs, who is champion at the chunk's end once that run has the title; so whoever comes in, the
    first run of the chunk that beats it decides what goes out. A round finds, for all datasets at once, the first
    later run that beats the present champion, and goes to the end of its chunk. There are at most as many rounds as
    chunks, however often the title changes.
    """
    names = [name for name, _ in RANKING]
    entry = F.struct("finished_at", "run_id", *names)
    order = [F.asc("finished_at"), F.asc("run_id")]
    placed = grouped_row_number(eligible(runs), ["dataset_fingerprint"], order, [F.col("finished_at")], "_place", hot_rows)
    slim = placed.select("dataset_fingerprint", entry.alias("run"), (F.col("_place") - 1).alias("place"))
    shape = T.StructType([slim.schema["dataset_fingerprint"], slim.schema["run"], T.StructField("final", slim.schema["run"].dataType)])
    chunks = slim.groupBy("dataset_fingerprint", F.floor(F.col("place") / chunk).alias("_chunk"))
    pool = cut_lineage(chunks.applyInArrow(lambda part: _chunk_finals(part, tolerance), shape))
    first = pool.groupBy("dataset_fingerprint").agg(F.min(F.struct("run", "final")).alias("first"))
    best = cut_lineage(first.select("dataset_fingerprint", F.col("first.final").alias("best")))
    active = best
    while True:
        run, held = F.col("run"), F.col("best")
        later = F.struct(run["finished_at"], run["run_id"]) > F.struct(
            held["finished_at"], held["run_id"]
        )
        # One champion per dataset on the right side.
        taken = (
            pool.join(active, "dataset_fingerprint")
            .filter(later & _beats(run, held, tolerance))
            .groupBy("dataset_fingerprint")
            .agg(F.min(F.struct("run", "final")).alias("first"))
            .select("dataset_fingerprint", F.col("first.final").alias("best"))
        )
        active = cut_lineage(taken)
        if active.isEmpty():
            break
        best = cut_lineage(
            best.join(active, "dataset_fingerprint", "left_anti").unionByName(active)
        )
    return best.select("dataset_fingerprint", "best.*")
