"""One-to-one matching of predictions to ground truth inside each image.

Inputs
    ``gt(image_id, gt_idx, x1, y1, x2, y2)`` and
    ``pred(image_id, pred_idx, x1, y1, x2, y2, confidence)``, valid normalised boxes.

Rule: predictions go by descending confidence, then ascending index; each takes the free target of
highest IoU (ties: lowest index) if that IoU reaches the threshold. Because only higher-ranked
predictions matter to a decision, one matching at the lowest confidence serves every threshold.

Two plans give the same result. An ordinary image has few candidate pairs, which are gathered and
folded in one array. A crowded image (``gt x pred`` above ``crowded_pairs``) is never gathered:
equal boxes are collapsed, candidates come from a grid join, and the assignment is found by rounds
of proposals over the whole cluster (see ``_match_crowded``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.functions.boxes import box_area, iou
from boxframe.operators.checkpoints import cut_lineage
from boxframe.operators.ranking import HOT_ROWS, grouped_row_number

CROWDED_PAIRS = 1 << 16
CORNERS = ("x1", "y1", "x2", "y2")


def _corners(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}{c}") for c in CORNERS]


def _ready(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    return df.select("image_id", *keep, *[F.col(c).alias(f"{prefix}{c}") for c in CORNERS])


def _crowded_images(gt: DataFrame, pred: DataFrame, crowded_pairs: int) -> DataFrame:
    counts = (
        gt.select("image_id", F.lit(1).alias("g"), F.lit(0).alias("p"))
        .unionByName(pred.select("image_id", F.lit(0).alias("g"), F.lit(1).alias("p")))
        .groupBy("image_id")
        .agg(F.sum("g").alias("g"), F.sum("p").alias("p"))
    )
    return counts.filter(F.col("g") * F.col("p") > crowded_pairs).select("image_id")


def _split_crowded(
    gt: DataFrame, pred: DataFrame, crowded_pairs: int
) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame] | None]:
    """Boxes of ordinary images, and those of crowded images or None when there are none.

    Looks once at the image sizes.
    """
    crowded = cut_lineage(_crowded_images(gt, pred, crowded_pairs))
    if crowded.isEmpty():
        return (gt, pred), None

    def part(how: str) -> tuple[DataFrame, DataFrame]:
        return gt.join(crowded, "image_id", how), pred.join(crowded, "image_id", how)

    return part("left_anti"), part("left_semi")


def _direct_pairs(gt: DataFrame, pred: DataFrame, iou_threshold: float) -> DataFrame:
    overlap = iou(_corners("p_"), _corners("g_"))
    return (
        pred.join(gt, "image_id")
        .withColumn("iou", overlap)
        .filter(F.col("iou") >= F.lit(float(iou_threshold)))
    )


def _level(width: Column, height: Column) -> Column:
    return F.floor(F.log2(F.greatest(width, height)) + F.lit(1e-12)).cast("int")


def _grid_pairs(
    gt: DataFrame, pred: DataFrame, iou_threshold: float
) -> DataFrame:
    """Pairs with enough overlap, by an equi-join on image, size level and grid cell.

    IoU >= t bounds both the ratio of the longer sides (between t and 1/t) and the distance of the
    centres (at most (1 - t) times the longer box side). So a prediction lies in one cell of the
    grid of its own size level, and a target is copied to the few cells and levels it can reach.
    """
    reach = max(0, math.ceil(-math.log2(iou_threshold) - 1e-12))

    def middle(prefix: str, axis: str) -> Column:
        return (F.col(f"{prefix}{axis}1") + F.col(f"{prefix}{axis}2")) / 2

    def side(prefix: str) -> list[Column]:
        return [
            F.col(f"{prefix}x2") - F.col(f"{prefix}x1"),
            F.col(f"{prefix}y2") - F.col(f"{prefix}y1"),
        ]

    def cell_size(level: Column) -> Column:
        return F.pow(F.lit(2.0), level.cast("double"))

    own = pred.withColumn("_level", _level(*side("p_")))
    size = cell_size(F.col("_level"))
    own = own.withColumns(
        {
            "_cx": F.floor(middle("p_", "x") / size),
            "_cy": F.floor(middle("p_", "y") / size),
        }
    )
    near = gt.withColumn("_own", _level(*side("g_"))).withColumn(
        "_level", F.explode(F.sequence(F.col("_own") - reach, F.col("_own") + reach))
    )
    size = cell_size(F.col("_level"))
    longest = F.greatest(*side("g_"), size * 2)
    slack = longest * F.lit(1.0 - iou_threshold + 1e-9)

    def cells(axis: str) -> Column:
        centre = middle("g_", axis)
        return F.sequence(F.floor((centre - slack) / size), F.floor((centre + slack) / size))

    near = near.withColumn("_cx", F.explode(cells("x"))).withColumn("_cy", F.explode(cells("y")))
    overlap = iou(_corners("p_"), _corners("g_"))
    return (
        own.join(near.drop("_own"), ["image_id", "_level", "_cx", "_cy"])
        .withColumn("iou", overlap)
        .filter(F.col("iou") >= F.lit(float(iou_threshold)))
        .drop("_level", "_cx", "_cy")
    )


def _check(iou_threshold: float) -> None:
    if not 0.0 < iou_threshold <= 1.0:
        raise ValueError("iou_threshold must be within (0, 1]")


def candidate_pairs(
    gt: DataFrame,
    pred: DataFrame,
    iou_threshold: float = 0.5,
    crowded_pairs: int = CROWDED_PAIRS,
) -> DataFrame:
    """``(image_id, pred_idx, gt_idx, iou)`` of every pair that reaches the threshold."""
    _check(iou_threshold)
    g, p = _ready(gt, "g_", ["gt_idx"]), _ready(pred, "p_", ["pred_idx"])
    plain, packed = _split_crowded(g, p, crowded_pairs)
    columns = ["image_id", "pred_idx", "gt_idx", "iou"]
    pairs = _direct_pairs(*plain, iou_threshold).select(*columns)
    if packed is None:
        return pairs
    return pairs.unionByName(_grid_pairs(*packed, iou_threshold).select(*columns))


def _fold_pairs(pairs: DataFrame, iou_levels: Sequence[float] | None = None) -> DataFrame:
    """Take an image's pairs in order and keep each whose two boxes are both still free.

    With ``iou_levels`` this is done for each level with the pairs that reach it, and an ``iou_threshold`` is added.
    An image's pairs are gathered once for all levels. Where no box is in two pairs there is nothing to decide, at the
    lowest level or above it; such pairs are kept as they are.
    """
    entry = F.struct(
        (-F.col("confidence")).alias("rank"),
        "pred_idx",
        (-F.col("iou")).alias("far"),
        "gt_idx",
        "gt_area",
    )
    grouped = pairs.groupBy("image_id").agg(F.collect_list(entry).alias("pairs"))
    kind = dict(grouped.dtypes)["pairs"]

    def step(taken: Column, pair: Column) -> Column:
        # An image's pairs are ordered by prediction, so a used prediction is the last one taken.
        last = F.try_element_at(taken, F.lit(-1))
        busy = F.coalesce(last["pred_idx"] == pair["pred_idx"], F.lit(False)) | F.exists(
            taken, lambda t: t["gt_idx"] == pair["gt_idx"]
        )
        return F.when(busy, taken).otherwise(F.concat(taken, F.array(pair)))

    none = F.array().cast(kind)
    free = F.lit(True)
    for index in ("pred_idx", "gt_idx"):
        free = free & (F.size(F.array_distinct(F.col("pairs")[index])) == F.size("pairs"))
    columns = [
        "image_id",
        "pred_idx",
        "gt_idx",
        (-F.col("far")).alias("iou"),
        (-F.col("rank")).alias("confidence"),
        "gt_area",
    ]
    if iou_levels is None:
        kept = F.when(free, F.col("pairs")).otherwise(F.aggregate(F.sort_array("pairs"), none, step))
        return grouped.select("image_id", F.inline(kept)).select(*columns)
    rising = sorted(iou_levels)
    levels = F.array(*[F.lit(float(level)) for level in rising])

    def fold(level: Column) -> Column:
        near = F.filter("pairs", lambda pair: level <= -pair["far"])
        return F.struct(level.alias("level"), F.aggregate(near, none, step).alias("kept"))

    whole = F.array(F.struct(F.lit(None).cast("double").alias("level"), F.col("pairs").alias("kept")))
    ordered = grouped.select("image_id", free.alias("free"), F.when(free, F.col("pairs")).otherwise(F.sort_array("pairs")).alias("pairs"))
    folds = ordered.select("image_id", F.inline(F.when(F.col("free"), whole).otherwise(F.transform(levels, fold))))
    reached = sum((F.when(F.col("far") <= F.lit(-float(level)), 1).otherwise(0) for level in rising), F.lit(0))
    # Pairs that nothing contests stand for all levels that they reach.
    at = F.when(F.col("level").isNull(), F.slice(levels, F.lit(1), reached)).otherwise(F.array("level"))
    return folds.select("image_id", "level", F.inline("kept")).select(*columns, F.explode(at).alias("iou_threshold"))


def _match_crowded(
    gt: DataFrame, pred: DataFrame, iou_threshold: float, hot_rows: int
) -> DataFrame:
    """Exact matching of crowded images by deferred acceptance.

    All targets rank predictions the same way (confidence, then index), so the greedy result is the
    one stable assignment, and proposals in any order reach it: every prediction proposes to its
    best target that has not refused it, every target keeps the best proposers it has room for, and
    a refusal is final. Equal ground-truth boxes form one target with room for all of them, so
    copies cost neither pairs nor rounds. Where a prediction sees two different boxes at exactly the
    same IoU, the index decides; the boxes concerned are split into runs of neighbouring indices.
    """
    box = [f"g_{c}" for c in CORNERS]
    pbox = [f"p_{c}" for c in CORNERS]
    ranked = cut_lineage(
        grouped_row_number(
            pred,
            ["image_id"],
            [F.desc("confidence"), F.asc("pred_idx")],
            [
                F.floor(-F.col("confidence") * 4096),
                -F.col("confidence"),
                F.floor(F.col("pred_idx") / 65536),
            ],
            "turn",
            hot_rows,
        )
    )
    # Pairs between distinct boxes only.
    pairs = cut_lineage(
        _grid_pairs(
            gt.select("image_id", *box).distinct(),
            ranked.select("image_id", *pbox).distinct(),
            iou_threshold,
        )
    )
    tie = ["image_id", *pbox, "iou"]
    tied = pairs.groupBy(*tie).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    tied_boxes = pairs.join(tied, tie, "left_semi").select("image_id", *box).distinct()
    members = cut_lineage(_runs(gt, tied_boxes, box, hot_rows))
    targets = members.groupBy("image_id", *box, "run").agg(
        F.min("gt_idx").alias("first_idx"), F.count("*").alias("room")
    )
    targets = cut_lineage(targets)
    choices = cut_lineage(
        ranked.select("image_id", "turn", *pbox)
        .join(pairs, ["image_id", *pbox])
        .join(targets, ["image_id", *box])
        .select("image_id", "turn", "first_idx", "room", "iou")
    )
    # limits: the last turn a full target still serves.
    limits = targets.select("image_id", "first_idx").limit(0).withColumn(
        "last_turn", F.lit(0).cast("bigint")
    )
    while True:
        open_choices = (
            choices.join(limits, ["image_id", "first_idx"], "left")
            .filter(F.col("last_turn").isNull() | (F.col("turn") <= F.col("last_turn")))
        )
        proposals = open_choices.groupBy("image_id", "turn").agg(
            F.max_by(
                F.struct("first_idx", "room", "iou"), F.struct("iou", -F.col("first_idx"))
            ).alias("best")
        )
        proposals = cut_lineage(proposals.select("image_id", "turn", "best.*"))
        new_limits = cut_lineage(_last_served(proposals))
        over = proposals.join(new_limits, ["image_id", "first_idx"]).filter("turn > last_turn")
        if over.isEmpty():
            break
        # A limit only ever tightens.
        limits = cut_lineage(
            limits.unionByName(new_limits)
            .groupBy("image_id", "first_idx")
            .agg(F.min("last_turn").alias("last_turn"))
        )
    served = grouped_row_number(
        proposals,
        ["image_id", "first_idx"],
        [F.asc("turn")],
        [F.floor(F.col("turn") / 65536)],
        "place",
        hot_rows,
    )
    # The k-th served prediction takes the k-th lowest index among the equal boxes.
    members = members.join(
        targets.select("image_id", *box, "run", "first_idx"), ["image_id", *box, "run"]
    )
    placed = grouped_row_number(
        members,
        ["image_id", "first_idx"],
        [F.asc("gt_idx")],
        [F.floor(F.col("gt_idx") / 65536)],
        "place",
        hot_rows,
    ).select("image_id", "first_idx", "place", "gt_idx", "gt_area")
    return (
        served.join(placed, ["image_id", "first_idx", "place"])
        .join(ranked.select("image_id", "turn", "pred_idx", "confidence"), ["image_id", "turn"])
        .select("image_id", "pred_idx", "gt_idx", "iou", "confidence", "gt_area")
    )


def _runs(gt: DataFrame, tied_boxes: DataFrame, box: list[str], hot_rows: int) -> DataFrame:
    """Mark the run of every target: equal boxes with no other tied box between their indices.

    Two runs never interleave, so comparing their first indices is comparing any of their indices.
    A box that ties with no other is one run.
    """
    order, levels = [F.asc("gt_idx")], [F.floor(F.col("gt_idx") / 65536)]
    mixed = gt.join(tied_boxes, ["image_id", *box], "left_semi")
    mixed = grouped_row_number(mixed, ["image_id"], order, levels, "overall", hot_rows)
    mixed = grouped_row_number(mixed, ["image_id", *box], order, levels, "own", hot_rows)
    mixed = mixed.withColumn("run", F.col("overall") - F.col("own")).drop("overall", "own")
    pure = gt.join(tied_boxes, ["image_id", *box], "left_anti")
    return mixed.unionByName(pure.withColumn("run", F.lit(0).cast("bigint")))


def _last_served(proposals: DataFrame) -> DataFrame:
    """Turn of the last proposer that a full target can serve.

    Found by counting proposers per block of turns, then ranking only the block where the room
    ends, so a target that a third of all predictions choose is not sorted in one task.
    """
    keys = ["image_id", "first_idx"]
    blocks = (
        proposals.withColumn("block", F.floor(F.col("turn") / 65536))
        .groupBy(*keys, "block")
        .agg(F.count("*").alias("n"), F.first("room").alias("room"))
    )
    before = (
        Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    last = (
        blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .filter((F.col("before") < F.col("room")) & (F.col("room") <= F.col("before") + F.col("n")))
        .select(*keys, "block", "before")
    )
    inside = Window.partitionBy(*keys, "block").orderBy("turn")
    return (
        proposals.withColumn("block", F.floor(F.col("turn") / 65536))
        .join(last, [*keys, "block"])
        .withColumn("place", F.col("before") + F.row_number().over(inside))
        .filter(F.col("place") == F.col("room"))
        .select(*keys, F.col("turn").cast("bigint").alias("last_turn"))
    )


def match_detections(
    gt: DataFrame,
    pred: DataFrame,
    iou_threshold: float = 0.5,
    confidence_threshold: float = 0.0,
    crowded_pairs: int = CROWDED_PAIRS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``(image_id, pred_idx, gt_idx, iou, confidence, gt_area)`` of every true positive."""
    _check(iou_threshold)
    if not 0.0 <= confidence_threshold <= 1.0:
        raise ValueError("confidence_threshold must be within [0, 1]")
    pred = pred.filter(F.col("confidence") >= F.lit(float(confidence_threshold)))
    area = box_area(*[F.col(c) for c in CORNERS])
    g = _ready(gt.withColumn("gt_area", area), "g_", ["gt_idx", "gt_area"])
    p = _ready(pred, "p_", ["pred_idx", "confidence"])
    plain, packed = _split_crowded(g, p, crowded_pairs)
    result = _fold_pairs(_direct_pairs(*plain, iou_threshold))
    if packed is None:
        return result
    found = _match_crowded(cut_lineage(packed[0]), packed[1], iou_threshold, hot_rows)
    return result.unionByName(found.select(*result.columns))


def match_levels(
    gt: DataFrame,
    pred: DataFrame,
    iou_levels: Sequence[float],
    crowded_pairs: int = CROWDED_PAIRS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``match_detections`` at several IoU thresholds, with an ``iou_threshold`` column.

    The pairs are built once at the lowest threshold; each level folds those that reach it.
    """
    for level in iou_levels:
        _check(level)
    area = box_area(*[F.col(c) for c in CORNERS])
    g = _ready(gt.withColumn("gt_area", area), "g_", ["gt_idx", "gt_area"])
    p = _ready(pred, "p_", ["pred_idx", "confidence"])
    plain, packed = _split_crowded(g, p, crowded_pairs)
    result = _fold_pairs(_direct_pairs(*plain, min(iou_levels)), iou_levels)
    if packed is None:
        return result
    g_packed, p_packed = (cut_lineage(part) for part in packed)
    for level in iou_levels:
        found = _match_crowded(g_packed, p_packed, level, hot_rows)
        found = found.withColumn("iou_threshold", F.lit(float(level)))
        result = result.unionByName(found.select(*result.columns))
    return result


def false_positives(pred: DataFrame, matches: DataFrame) -> DataFrame:
    return pred.join(matches, ["image_id", "pred_idx"], "left_anti")


def false_negatives(gt: DataFrame, matches: DataFrame) -> DataFrame:
    return gt.join(matches, ["image_id", "gt_idx"], "left_anti")


def confidence_rank(pred: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Place of each prediction within its image: confidence descending, then index."""
    return grouped_row_number(
        pred,
        ["image_id"],
        [F.desc("confidence"), F.asc("pred_idx")],
        [
            F.floor(-F.col("confidence") * 4096),
            -F.col("confidence"),
            F.floor(F.col("pred_idx") / 65536),
        ],
        "rank",
        hot_rows,
    )


def coverage(expected: DataFrame, results: DataFrame) -> DataFrame:
    """``(image_id, problem)`` for images without a result, results without an image, and repeats."""
    seen = results.groupBy("image_id").agg(F.count("*").alias("n_results"))
    wanted = expected.select("image_id").distinct().withColumn("expected", F.lit(True))
    problem = (
        F.when(F.col("n_results").isNull(), "missing")
        .when(F.col("expected").isNull(), "extra")
        .when(F.col("n_results") > 1, "duplicate")
    )
    return (
        wanted.join(seen, "image_id", "full_outer")
        .select("image_id", problem.alias("problem"))
        .filter("problem is not null")
    )
