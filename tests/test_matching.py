"""Matching and sweep against a plain loop, on the ordinary and on the crowded plan."""

import random
import re

import pytest

from boxframe.functions.boxes import iou
from boxframe.operators import matching, reports, sweep
from boxframe.schemas import GROUND_TRUTH, PREDICTIONS
from pyspark.sql import functions as F


def loop_iou(a, b):
    w = max(0.0, min(a[2], b[2]) - max(a[0], b[0]))
    h = max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    inter = w * h
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return inter / union if union > 0 else 0.0


def loop_match(truth, preds, conf, level):
    """``truth`` and ``preds`` map an index to a box; predictions carry confidence last."""
    free, hits = set(truth), []
    chosen = [i for i, p in preds.items() if p[4] >= conf]
    for i in sorted(chosen, key=lambda k: (-preds[k][4], k)):
        options = [(loop_iou(preds[i], truth[g]), -g) for g in free]
        if options:
            best, g = max(options)
            if best >= level:
                free.remove(-g)
                hits.append((i, -g, best))
    return hits


def make(seed, images, n_gt, n_pred, cells=12, confs=6):
    """Boxes on a coarse grid, so equal boxes and equal IoUs are common."""
    rng = random.Random(seed)

    def box():
        x, y = rng.randrange(cells), rng.randrange(cells)
        return (x / 16, y / 16, (x + rng.randint(1, 4)) / 16, (y + rng.randint(1, 4)) / 16)

    data = {}
    for k in range(images):
        truth = {i: box() for i in range(rng.randint(0, n_gt))}
        preds = {i: (*box(), rng.randint(1, confs) / 8) for i in range(rng.randint(0, n_pred))}
        data[f"i{k}"] = (truth, preds)
    return data


def frames(spark, data):
    gt = [(k, g, *b, 0) for k, (t, _) in data.items() for g, b in t.items()]
    pred = [(k, p, *b[:4], 0, b[4]) for k, (_, q) in data.items() for p, b in q.items()]
    images = spark.createDataFrame([(k,) for k in data], "image_id string")
    return spark.createDataFrame(gt, GROUND_TRUTH), spark.createDataFrame(pred, PREDICTIONS), images


def collected(matches):
    return {(r.image_id, r.pred_idx, r.gt_idx) for r in matches.collect()}


def looped(data, conf, level):
    return {
        (k, p, g) for k, (t, q) in data.items() for p, g, _ in loop_match(t, q, conf, level)
    }


def test_iou_value(spark):
    a, b = [(0.0, 0.0, 0.5, 0.5), (0.25, 0.25, 0.75, 0.75)]
    value = spark.range(1).select(iou([F.lit(v) for v in a], [F.lit(v) for v in b])).head()[0]
    assert value == pytest.approx(1 / 7)


def test_known_image(spark):
    truth = {0: (0.1, 0.1, 0.3, 0.3), 1: (0.6, 0.6, 0.8, 0.8)}
    preds = {
        0: (0.4, 0.1, 0.5, 0.2, 0.80),
        1: (0.1, 0.1, 0.3, 0.3, 0.95),
        2: (0.6, 0.6, 0.8, 0.8, 0.40),
    }
    gt, pred, _ = frames(spark, {"a": (truth, preds)})
    hits = matching.match_detections(gt, pred, 0.5, 0.5)
    assert collected(hits) == {("a", 1, 0)}
    wrong = matching.false_positives(pred.filter("confidence >= 0.5"), hits)
    assert [r.pred_idx for r in wrong.collect()] == [0]
    assert [r.gt_idx for r in matching.false_negatives(gt, hits).collect()] == [1]


@pytest.mark.parametrize("seed,level", [(1, 0.5), (2, 0.3), (3, 0.75)])
def test_ordinary_plan(spark, seed, level):
    data = make(seed, 60, 12, 16)
    gt, pred, _ = frames(spark, data)
    assert collected(matching.match_detections(gt, pred, level, 0.3)) == looped(data, 0.3, level)


@pytest.mark.parametrize("seed,level,cells", [(4, 0.5, 3), (5, 0.34, 12), (6, 0.9, 2), (7, 1.0, 2)])
def test_crowded_plan(spark, seed, level, cells):
    """Every image counts as crowded and every group as large; many equal boxes and equal IoUs."""
    data = make(seed, 8, 40, 50, cells)
    gt, pred, _ = frames(spark, data)
    found = matching.match_detections(gt, pred, level, 0.0, crowded_pairs=0, hot_rows=5)
    assert collected(found) == looped(data, 0.0, level)
    pairs = matching.candidate_pairs(gt, pred, level, crowded_pairs=0)
    direct = matching.candidate_pairs(gt, pred, level)
    key = ("image_id", "pred_idx", "gt_idx")
    assert {tuple(r[k] for k in key) for r in pairs.collect()} == {
        tuple(r[k] for k in key) for r in direct.collect()
    }


def test_copies_need_no_pairs(spark):
    """Ten thousand equal boxes on either side: one pair of distinct boxes, matched in order."""
    n = 10_000
    base = spark.range(n)
    box = [F.lit(v).alias(c) for v, c in zip((0.25, 0.25, 0.5, 0.5), ("x1", "y1", "x2", "y2"))]
    gt = base.select(F.lit("a").alias("image_id"), F.col("id").cast("int").alias("gt_idx"), *box)
    pred = base.select(
        F.lit("a").alias("image_id"),
        F.col("id").cast("int").alias("pred_idx"),
        *box,
        (F.col("id") % 4 / 4).alias("confidence"),
    )
    hits = matching.match_detections(gt, pred, 0.5, hot_rows=1000)
    assert hits.count() == n
    first = hits.filter("gt_idx = 0").head()
    assert (first.pred_idx, first.confidence) == (3, 0.75)


@pytest.mark.parametrize("crowded_pairs", [matching.CROWDED_PAIRS, 0])
def test_sweep_against_loop(spark, crowded_pairs):
    data = make(11, 25, 8, 10)
    gt, pred, images = frames(spark, data)
    ladder = sweep.ladder_values(0.1, 0.9, 0.2, 0.25)
    rows = sweep.sweep(gt, pred, images, ladder, 0.5, 0.02, crowded_pairs)
    for row in rows.collect():
        t = row.threshold
        tp = fp = fn = missed = small = small_tp = 0
        for truth, preds in data.values():
            hits = loop_match(truth, preds, t, 0.5)
            used = {g for _, g, _ in hits}
            tp += len(hits)
            fp += sum(p[4] >= t for p in preds.values()) - len(hits)
            fn += len(truth) - len(used)
            missed += bool(set(truth) - used)
            little = {g for g, b in truth.items() if (b[2] - b[0]) * (b[3] - b[1]) <= 0.02 + 1e-12}
            small += len(little)
            small_tp += len(little & used)
        assert (row.true_positives, row.false_positives, row.false_negatives) == (tp, fp, fn)
        assert row.images == len(data)
        assert row.images_with_false_negatives == missed
        assert row.small_object_ground_truth_count == small
        assert row.small_object_true_positives == small_tp


def test_sweep_without_predictions(spark):
    gt, pred, images = frames(spark, {"a": ({0: (0.1, 0.1, 0.2, 0.2)}, {0: (0.5, 0.5, 0.6, 0.6, 0.01)})})
    rows = sweep.sweep(gt, pred, images, [0.05, 0.5]).collect()
    assert [(r.predictions, r.false_negatives, r.f1) for r in rows] == [(0, 1, 0.0)] * 2


def test_ladder_and_references(spark):
    assert sweep.ladder_values(0.05, 0.15, 0.05, 0.12) == [0.05, 0.1, 0.12, 0.15]
    assert len(sweep.ladder_values(**sweep.DEFAULT_LADDER)) == 19
    rows = spark.createDataFrame(
        [(0.1, 0.9, 0.6, 2.0), (0.2, 0.9, 0.7, 1.0), (0.3, 0.895, 0.7, 0.5), (0.4, 0.5, 0.6, 0.1)],
        "threshold double, recall double, f1 double, false_positives_per_image double",
    )
    best = sweep.threshold_references(rows).head()
    assert best.best_f1_threshold == 0.3
    assert best.max_recall_threshold == 0.2
    assert best.balanced_high_recall_threshold == 0.3


def test_locked_split():
    assert sweep.evaluation_thresholds("test", 0.4) == ([0.4], 0.4, False)
    with pytest.raises(ValueError):
        sweep.evaluation_thresholds("test")
    values, chosen, may_choose = sweep.evaluation_thresholds("val", 0.33)
    assert 0.33 in values and chosen == 0.33 and may_choose


def test_average_precision_of_perfect_and_crowded(spark):
    data = make(21, 10, 10, 14)
    gt, pred, _ = frames(spark, data)
    plain = {r[0]: r[1] for r in reports.average_precision(gt, pred, [0.5, 0.75]).collect()}
    packed = reports.average_precision(gt, pred, [0.5, 0.75], crowded_pairs=0, hot_rows=3)
    assert {r[0]: r[1] for r in packed.collect()} == pytest.approx(plain)
    perfect = gt.withColumnRenamed("gt_idx", "pred_idx").withColumn("confidence", F.lit(0.9))
    value = reports.average_precision(gt, perfect, [0.5]).head()
    assert value.average_precision == pytest.approx(1.0)


def test_levels_gather_pairs_once(spark):
    levels = [0.9, 0.25, 0.5, 0.75]
    data = make(31, 12, 9, 12) | {f"lone{k}": v for k, v in make(32, 8, 1, 1, cells=2).items()}
    data["apart"] = ({0: (0.0, 0.0, 0.25, 0.25), 1: (0.5, 0.5, 1.0, 1.0)}, {3: (0.0, 0.0, 0.25, 0.25, 0.5), 4: (0.5, 0.5, 1.0, 0.75, 0.25)})
    gt, pred, _ = frames(spark, data)
    matches = matching.match_levels(gt, pred, levels)
    found = {(r.iou_threshold, r.image_id, r.pred_idx, r.gt_idx) for r in matches.collect()}
    wanted = {(level, k, p, g) for level in levels for k, (t, q) in data.items() for p, g, _ in loop_match(t, q, 0.0, level)}
    assert found == wanted and matches.count() == len(wanted)
    assert {(r[0], *r[1:]) for r in found if r[1] == "apart"} == {(0.9, "apart", 3, 0), (0.75, "apart", 3, 0), (0.5, "apart", 3, 0), (0.25, "apart", 3, 0), (0.5, "apart", 4, 1), (0.25, "apart", 4, 1)}
    # No image's pairs are grouped again for each level.
    plan = matches._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [image_id#" in plan and not re.search(r"Aggregate \[[^\]]*iou_threshold", plan)


def test_false_alarms_join_images_only(spark):
    data = make(33, 15, 6, 8)
    gt, pred, images = frames(spark, data)
    times = images.select("image_id", F.lit("v").alias("video_id"), (F.substring("image_id", 2, 9).cast("int") * 10.0).alias("timestamp_seconds"))
    rows = reports.false_alarms_per_minute(pred, matching.match_detections(gt, pred, 0.5), times)
    wanted = {}
    for k, (truth, preds) in data.items():
        n, wrong = wanted.get(int(k[1:]) // 6, (0, 0))
        wanted[int(k[1:]) // 6] = (n + 1, wrong + len(preds) - len(loop_match(truth, preds, 0.0, 0.5)))
    assert {r.minute: (r.frames, r.false_alarms) for r in rows.collect()} == wanted
    assert rows.schema["false_alarms"].dataType.simpleString() == "bigint"
    # Predictions are counted, not joined by their indices.
    joins = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join " in line]
    assert joins and not any("pred_idx" in line for line in joins)
