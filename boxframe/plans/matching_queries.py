"""Queries on matching, sweeps, threshold choice and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions.boxes import iou
from boxframe.operators import frames, matching, quality, reports, sweep
from boxframe.plans import evaluation
from boxframe.plans.fixtures import Inputs
from boxframe.plans.registry import query

IOU = 0.5
LADDER = sweep.ladder_values(**sweep.DEFAULT_LADDER)
_LADDER_SQL = ", ".join(f"({t!r}::DOUBLE)" for t in LADDER)

_OVERLAP = """(greatest(0, least(p.x2, g.x2) - greatest(p.x1, g.x1))
    * greatest(0, least(p.y2, g.y2) - greatest(p.y1, g.y1)))"""
_IOU = f"""({_OVERLAP} / ((p.x2 - p.x1) * (p.y2 - p.y1) + (g.x2 - g.x1) * (g.y2 - g.y1)
    - {_OVERLAP}))"""


def match_sql(levels: str, first: str = "0.0") -> str:
    """Common table expressions ending in ``hits``: the plain loop, one prediction at a time.

    ``levels`` are rows of ``(confidence threshold, IoU threshold)``; every pair of them is matched
    on its own, so this does not rely on one matching serving several thresholds.
    """
    return f"""WITH RECURSIVE levels(t, level) AS (VALUES {levels}),
pairs AS MATERIALIZED (
  SELECT p.image_id, p.pred_idx, g.gt_idx, p.confidence, {_IOU} AS iou
  FROM fx_pred p JOIN fx_gt g ON p.image_id = g.image_id AND {_IOU} >= (SELECT min(level) FROM levels)
  WHERE p.confidence >= {first}),
choices AS (
  SELECT t, level, image_id, pred_idx, confidence,
    list({{'g': gt_idx, 'i': iou}} ORDER BY iou DESC, gt_idx) AS options
  FROM pairs, levels WHERE confidence >= t AND iou >= level GROUP BY ALL),
turns AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY t, level, image_id ORDER BY confidence DESC, pred_idx)
    AS turn FROM choices),
steps(t, level, image_id, turn, used, pred_idx, confidence, pick) AS (
  SELECT DISTINCT t, level, image_id, 0::BIGINT, []::INTEGER[], NULL::INTEGER, NULL::DOUBLE,
    NULL::STRUCT(g INTEGER, i DOUBLE) FROM turns
  UNION ALL
  SELECT t, level, image_id, turn,
    CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick.g) END, pred_idx, confidence, pick
  FROM (
    SELECT c.t, c.level, c.image_id, c.turn, s.used, c.pred_idx, c.confidence,
      list_filter(c.options, lambda o: NOT list_contains(s.used, o.g))[1] AS pick
    FROM steps s JOIN turns c ON c.t = s.t AND c.level = s.level AND c.image_id = s.image_id
      AND c.turn = s.turn + 1) AS next),
hits AS (
  SELECT t, level, image_id, pred_idx, confidence, pick.g AS gt_idx, pick.i AS iou
  FROM steps WHERE pick IS NOT NULL)
"""


_ONE = match_sql("(0.0, 0.5)")


def _matches(inputs: Inputs) -> DataFrame:
    return matching.match_detections(inputs.view("fx_gt"), inputs.view("fx_pred"), IOU)


@query(
    "iou_pairs",
    f"""SELECT p.image_id, p.pred_idx, g.gt_idx, round({_IOU}, 9) AS iou
FROM fx_pred p JOIN fx_gt g ON p.image_id = g.image_id AND p.pred_idx = g.gt_idx""",
)
def iou_pairs(inputs: Inputs) -> DataFrame:
    p, g = inputs.view("fx_pred").alias("p"), inputs.view("fx_gt").alias("g")
    same = (F.col("p.image_id") == F.col("g.image_id")) & (F.col("p.pred_idx") == F.col("g.gt_idx"))
    corners = [[F.col(f"{side}.{c}") for c in matching.CORNERS] for side in "pg"]
    return p.join(g, same).select(
        "p.image_id", "p.pred_idx", "g.gt_idx", F.round(iou(*corners), 9).alias("iou")
    )


@query(
    "candidate_pairs",
    f"""SELECT p.image_id, p.pred_idx, g.gt_idx, round({_IOU}, 9) AS iou
FROM fx_pred p JOIN fx_gt g ON p.image_id = g.image_id AND {_IOU} >= 0.5""",
)
def candidate_pairs(inputs: Inputs) -> DataFrame:
    pairs = matching.candidate_pairs(inputs.view("fx_gt"), inputs.view("fx_pred"), IOU)
    return pairs.withColumn("iou", F.round("iou", 9))


@query(
    "match_greedy",
    _ONE + "SELECT image_id, pred_idx, gt_idx, round(iou, 9) AS iou, confidence FROM hits",
)
def match_greedy(inputs: Inputs) -> DataFrame:
    return _matches(inputs).select(
        "image_id", "pred_idx", "gt_idx", F.round("iou", 9).alias("iou"), "confidence"
    )


@query(
    "match_fp",
    _ONE + """SELECT image_id, pred_idx, confidence FROM fx_pred
ANTI JOIN hits USING (image_id, pred_idx)""",
)
def match_fp(inputs: Inputs) -> DataFrame:
    wrong = matching.false_positives(inputs.view("fx_pred"), _matches(inputs))
    return wrong.select("image_id", "pred_idx", "confidence")


@query(
    "match_fn",
    _ONE + "SELECT image_id, gt_idx FROM fx_gt ANTI JOIN hits USING (image_id, gt_idx)",
)
def match_fn(inputs: Inputs) -> DataFrame:
    missed = matching.false_negatives(inputs.view("fx_gt"), _matches(inputs))
    return missed.select("image_id", "gt_idx")


@query(
    "confidence_rank",
    """SELECT image_id, pred_idx, confidence, row_number() OVER (
  PARTITION BY image_id ORDER BY confidence DESC, pred_idx) AS rank FROM fx_pred""",
)
def confidence_rank(inputs: Inputs) -> DataFrame:
    pred = inputs.view("fx_pred").select("image_id", "pred_idx", "confidence")
    return matching.confidence_rank(pred)


@query(
    "coverage",
    """WITH results AS (
  SELECT doc_id AS image_id FROM labels
  UNION ALL SELECT doc_id FROM labels WHERE doc_id % 10 = 0
  UNION ALL SELECT doc_id + 10000000 FROM labels WHERE doc_id % 25 = 0),
seen AS (SELECT image_id, count(*) AS n FROM results GROUP BY 1)
SELECT coalesce(d.doc_id, s.image_id) AS image_id,
  CASE WHEN s.n IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'extra' ELSE 'duplicate' END
    AS problem
FROM documents d FULL JOIN seen s ON d.doc_id = s.image_id
WHERE s.n IS NULL OR d.doc_id IS NULL OR s.n > 1""",
)
def coverage(inputs: Inputs) -> DataFrame:
    results = inputs.sql("""SELECT doc_id AS image_id FROM {labels}
UNION ALL SELECT doc_id FROM {labels} WHERE doc_id % 10 = 0
UNION ALL SELECT doc_id + 10000000 FROM {labels} WHERE doc_id % 25 = 0""")
    expected = inputs.table("documents").select(F.col("doc_id").alias("image_id"))
    return matching.coverage(expected, results)


@query(
    "top_detections",
    """SELECT image_id, pred_idx, confidence FROM (
  SELECT image_id, pred_idx, confidence, row_number() OVER (
    PARTITION BY image_id ORDER BY confidence DESC, pred_idx) AS r FROM fx_pred) WHERE r <= 3""",
)
def top_detections(inputs: Inputs) -> DataFrame:
    pred = inputs.view("fx_pred").select("image_id", "pred_idx", "confidence")
    return quality.top_per_image(pred, 3).drop("rank")


@query(
    "threshold_ladder",
    f"""WITH ladder(threshold) AS (VALUES {_LADDER_SQL})
SELECT threshold, count(confidence) AS predictions
FROM ladder LEFT JOIN fx_pred ON confidence >= threshold GROUP BY 1""",
)
def threshold_ladder(inputs: Inputs) -> DataFrame:
    pred = inputs.view("fx_pred")
    reach = sweep.steps_reached(F.col("confidence"), LADDER)
    # Counted per step first; the explode sees one row per step.
    counted = pred.select(reach.alias("reach")).groupBy("reach").agg(F.count("*").alias("n"))
    at_least = counted.filter("reach > 0").select(
        F.explode(F.sequence(F.lit(1), "reach")).alias("step"), "n"
    )
    return (
        sweep.threshold_ladder(inputs.spark, LADDER)
        .join(at_least, "step", "left")
        .groupBy("threshold")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("predictions"))
    )


def sweep_sql(thresholds: list[float], images: str = "SELECT * FROM fx_images") -> str:
    """The 19 metric columns by matching anew at every threshold."""
    levels = ", ".join(f"({t!r}::DOUBLE, 0.5)" for t in thresholds)
    return (
        match_sql(levels)
        + f"""SELECT threshold, images, ground_truth, predictions, true_positives,
  predictions - true_positives AS false_positives,
  ground_truth - true_positives AS false_negatives,
  precision, recall,
  CASE WHEN precision + recall = 0 THEN 0 ELSE 2.0 * precision * recall / (precision + recall) END
    AS f1,
  CASE WHEN ground_truth = 0 THEN 0 ELSE (ground_truth - true_positives) / ground_truth END
    AS false_negative_rate,
  CASE WHEN images = 0 THEN 0 ELSE (predictions - true_positives) / images END
    AS false_positives_per_image,
  missed AS images_with_false_negatives,
  CASE WHEN images = 0 THEN 0 ELSE missed / images END AS fraction_of_images_with_false_negatives,
  small_gt AS small_object_ground_truth_count, small_tp AS small_object_true_positives,
  small_gt - small_tp AS small_object_false_negatives,
  CASE WHEN small_gt = 0 THEN 0 ELSE small_tp / small_gt END AS small_object_recall,
  CASE WHEN small_gt = 0 THEN 0 ELSE (small_gt - small_tp) / small_gt END
    AS small_object_false_negative_rate
FROM (
  SELECT *, CASE WHEN predictions = 0 THEN 0 ELSE true_positives / predictions END AS precision,
    CASE WHEN ground_truth = 0 THEN 0 ELSE true_positives / ground_truth END AS recall
  FROM (
    SELECT l.t AS threshold,
      (SELECT count(*) FROM ({images}) AS i) AS images,
      (SELECT count(*) FROM fx_gt) AS ground_truth,
      (SELECT count(*) FROM fx_pred p WHERE p.confidence >= l.t) AS predictions,
      (SELECT count(*) FROM hits h WHERE h.t = l.t) AS true_positives,
      (SELECT count(DISTINCT g.image_id) FROM fx_gt g WHERE NOT EXISTS (
        SELECT 1 FROM hits h WHERE h.t = l.t AND h.image_id = g.image_id AND h.gt_idx = g.gt_idx))
        AS missed,
      (SELECT count(*) FROM fx_gt g WHERE (g.x2 - g.x1) * (g.y2 - g.y1) <= 0.01 + 1e-12) AS small_gt,
      (SELECT count(*) FROM hits h JOIN fx_gt g ON h.image_id = g.image_id AND h.gt_idx = g.gt_idx
        WHERE h.t = l.t AND (g.x2 - g.x1) * (g.y2 - g.y1) <= 0.01 + 1e-12) AS small_tp
    FROM levels l) AS counts) AS ratios
"""
    )


_SWEEP_SQL = sweep_sql(LADDER)


def _rounded(rows: DataFrame) -> DataFrame:
    doubles = [n for n, kind in rows.dtypes if kind == "double" and n != "threshold"]
    return rows.withColumns({n: F.round(n, 9) for n in doubles})


_RATIOS = {
    "precision",
    "recall",
    "f1",
    "false_negative_rate",
    "false_positives_per_image",
    "fraction_of_images_with_false_negatives",
    "small_object_recall",
    "small_object_false_negative_rate",
}


def _rounded_sql(body: str) -> str:
    columns = ", ".join(
        f"round({c}, 9) AS {c}" if c in _RATIOS else c for c in sweep.METRIC_COLUMNS
    )
    head, tail = body.split("SELECT threshold, images", 1)
    return f"{head}SELECT {columns} FROM (SELECT threshold, images{tail}) AS m"


def _sweep(inputs: Inputs, thresholds: list[float]) -> DataFrame:
    return sweep.sweep(
        inputs.view("fx_gt"), inputs.view("fx_pred"), inputs.view("fx_images"), thresholds, IOU
    )


@query("threshold_sweep", _rounded_sql(_SWEEP_SQL))
def threshold_sweep(inputs: Inputs) -> DataFrame:
    return _rounded(_sweep(inputs, LADDER))


@query("threshold_metrics", _rounded_sql(sweep_sql([0.25])))
def threshold_metrics(inputs: Inputs) -> DataFrame:
    return _rounded(_sweep(inputs, [0.25]))


_REFS_SQL = (
    _SWEEP_SQL.replace("SELECT threshold, images", ", m AS (SELECT threshold, images", 1)
    + """), best AS (SELECT *, max(recall) OVER () AS top FROM m)
"""
)


@query(
    "threshold_refs",
    _REFS_SQL
    + """SELECT
  (SELECT threshold FROM best WHERE recall >= top - 0.01
    ORDER BY false_positives_per_image, threshold DESC LIMIT 1) AS balanced_high_recall_threshold,
  (SELECT threshold FROM best ORDER BY f1 DESC, threshold DESC LIMIT 1) AS best_f1_threshold,
  (SELECT max(threshold) FROM best WHERE abs(recall - top) <= 1e-12) AS max_recall_threshold""",
)
def threshold_refs(inputs: Inputs) -> DataFrame:
    return sweep.threshold_references(_sweep(inputs, LADDER))


@query(
    "selected_row",
    _REFS_SQL
    + """SELECT threshold, true_positives, false_positives, false_negatives FROM best
WHERE abs(threshold - 0.25) <= 1e-12""",
)
def selected_row(inputs: Inputs) -> DataFrame:
    row = sweep.select_row(_sweep(inputs, LADDER), 0.25)
    return row.select("threshold", "true_positives", "false_positives", "false_negatives")


def _one_split(sql: str, split: str) -> str:
    """The same check over the boxes of one split."""
    for view in ("fx_pred", "fx_gt"):
        sql = sql.replace(view, f"one_{view}")
    keep = f"(SELECT image_id FROM fx_images WHERE split = '{split}')"
    views = "".join(
        f"one_{v} AS (SELECT * FROM {v} WHERE image_id IN {keep}),\n" for v in ("fx_pred", "fx_gt")
    )
    return sql.replace("WITH RECURSIVE ", f"WITH RECURSIVE {views}", 1)


@query(
    "locked_eval",
    _one_split(
        _rounded_sql(sweep_sql([0.4], "SELECT * FROM fx_images WHERE split = 'test'")), "test"
    ),
)
def locked_eval(inputs: Inputs) -> DataFrame:
    result = evaluation.evaluate(
        inputs.view("fx_gt"),
        inputs.view("fx_pred"),
        inputs.view("fx_images"),
        split="test",
        locked_threshold=0.4,
    )
    return _rounded(result.rows)


# Predictions with invalid values in some rows, and results that don't fit the images.
_SPOILED = """SELECT image_id, pred_idx, CASE WHEN image_id % 41 = 0 THEN CAST('NaN' AS DOUBLE) ELSE x1 END AS x1,
  y1, CASE WHEN image_id % 43 = 0 THEN 1.5 ELSE x2 END AS x2, y2,
  CASE WHEN image_id % 47 = 0 THEN CAST('NaN' AS DOUBLE) WHEN image_id % 53 = 0 THEN 1.25
    WHEN image_id % 59 = 0 THEN NULL ELSE confidence END AS confidence
FROM {fx_pred}"""
_RESULTS = """SELECT image_id FROM {fx_images} WHERE image_id % 31 <> 0
UNION ALL SELECT image_id FROM {fx_images} WHERE image_id % 37 = 0
UNION ALL SELECT -image_id FROM {fx_images} WHERE image_id % 61 = 0"""


def _plain(sql: str) -> str:
    return sql.replace("{", "").replace("}", "")


@query(
    "eval_problems",
    f"""WITH p AS ({_plain(_SPOILED)}), r AS ({_plain(_RESULTS)}),
v AS (SELECT image_id FROM fx_images WHERE split = 'val'),
c AS (SELECT coalesce(v.image_id, r.image_id) AS image_id, CASE WHEN r.image_id IS NULL THEN 'missing'
    WHEN v.image_id IS NULL THEN 'extra' WHEN r.n > 1 THEN 'duplicate' END AS problem
  FROM v FULL JOIN (SELECT image_id, count(*) AS n FROM r GROUP BY 1) AS r ON v.image_id = r.image_id),
b AS (SELECT image_id, CASE WHEN isnan(x1) THEN 'not_finite' WHEN x2 > 1 THEN 'outside_unit_square'
    WHEN x2 <= x1 OR y2 <= y1 THEN 'not_positive_size'
    WHEN confidence IS NULL OR isnan(confidence) OR confidence > 1 THEN 'confidence_outside_unit_interval' END AS problem
  FROM p WHERE image_id IN (SELECT image_id FROM v))
SELECT image_id, problem, CAST(1 AS BIGINT) AS n FROM c WHERE problem IS NOT NULL
UNION ALL SELECT image_id, 'prediction_' || problem, count(*) FROM b WHERE problem IS NOT NULL GROUP BY 1, 2""",
)
def eval_problems(inputs: Inputs) -> DataFrame:
    return evaluation.evaluation_problems(
        inputs.view("fx_gt"),
        inputs.spark.sql(_SPOILED, fx_pred=inputs.view("fx_pred")),
        inputs.view("fx_images"),
        "val",
        inputs.spark.sql(_RESULTS, fx_images=inputs.view("fx_images")),
    )


@query(
    "metrics_document",
    _REFS_SQL
    + """SELECT 'run_sf' AS run_id, 'val' AS split, threshold AS confidence_threshold,
  true_positives, false_positives, false_negatives, round(f1, 9) AS f1, round(recall, 9) AS recall,
  (SELECT threshold FROM best ORDER BY f1 DESC, threshold DESC LIMIT 1) AS best_f1_threshold,
  (SELECT round(avg(value), 6) FROM events) AS mean_inference_ms, true AS threshold_selection_allowed
FROM best WHERE abs(threshold - 0.25) <= 1e-12""",
)
def metrics_document(inputs: Inputs) -> DataFrame:
    rows = _sweep(inputs, LADDER)
    document = evaluation.metrics_document(
        rows,
        frames.latency_summary(inputs.view("fx_frames")),
        run_id="run_sf",
        split="val",
        selected=0.25,
        selection_allowed=True,
    )
    return document.select(
        "run_id",
        "split",
        "confidence_threshold",
        "counts.true_positives",
        "counts.false_positives",
        "counts.false_negatives",
        F.round("metrics.f1", 9).alias("f1"),
        F.round("metrics.recall", 9).alias("recall"),
        "threshold_references.best_f1_threshold",
        F.round("latency.mean_inference_ms", 6).alias("mean_inference_ms"),
        "threshold_selection_allowed",
    )


_AP_LEVELS = [round(0.5 + 0.05 * i, 2) for i in range(10)]


@query(
    "average_precision",
    match_sql(", ".join(f"(0.0, {level!r}::DOUBLE)" for level in _AP_LEVELS))
    + """, per AS (
  SELECT level, p.confidence, count(*) AS n, count(h.gt_idx) AS tp
  FROM levels JOIN fx_pred p ON true
  LEFT JOIN (SELECT level AS lv, image_id, pred_idx, gt_idx FROM hits) h
    ON h.lv = level AND h.image_id = p.image_id AND h.pred_idx = p.pred_idx
  GROUP BY ALL),
curve AS (
  SELECT level, sum(tp) OVER w AS tp, sum(tp) OVER w / sum(n) OVER w AS precision
  FROM per WINDOW w AS (PARTITION BY level ORDER BY confidence DESC)),
grid AS (SELECT level, k FROM (SELECT DISTINCT level FROM levels), range(101) r(k))
SELECT level AS iou_threshold, round(sum(best) / 101, 9) AS average_precision FROM (
  SELECT g.level, g.k, coalesce(max(c.precision), 0) AS best FROM grid g LEFT JOIN curve c
  ON c.level = g.level AND c.tp * 100 >= g.k * (SELECT count(*) FROM fx_gt) GROUP BY ALL)
GROUP BY 1""",
)
def average_precision(inputs: Inputs) -> DataFrame:
    levels = reports.average_precision(inputs.view("fx_gt"), inputs.view("fx_pred"), _AP_LEVELS)
    return levels.withColumn("average_precision", F.round("average_precision", 9))


@query(
    "top_false_positives",
    _ONE + """SELECT image_id, pred_idx, confidence FROM fx_pred
ANTI JOIN hits USING (image_id, pred_idx) ORDER BY confidence DESC, image_id, pred_idx LIMIT 50""",
)
def top_false_positives(inputs: Inputs) -> DataFrame:
    top = reports.top_false_positives(inputs.view("fx_pred"), _matches(inputs), 50)
    return top.select("image_id", "pred_idx", "confidence")


@query(
    "small_missed_targets",
    _ONE + """SELECT image_id, gt_idx, (x2 - x1) * (y2 - y1) AS area FROM fx_gt
ANTI JOIN hits USING (image_id, gt_idx) WHERE (x2 - x1) * (y2 - y1) <= 0.01 + 1e-12
ORDER BY area DESC, image_id, gt_idx LIMIT 50""",
)
def small_missed_targets(inputs: Inputs) -> DataFrame:
    missed = reports.missed_targets(inputs.view("fx_gt"), _matches(inputs), 50, 0.01)
    return missed.select("image_id", "gt_idx", "area")


@query(
    "images_by_detections",
    """WITH counted AS (SELECT image_id, count(*) AS n FROM fx_pred GROUP BY 1)
SELECT i.image_id, coalesce(n, 0) AS n_detections,
  CASE WHEN coalesce(n, 0) = 0 THEN 'none' ELSE 'several' END AS kind
FROM fx_images i LEFT JOIN counted c ON i.image_id = c.image_id WHERE coalesce(n, 0) <> 1""",
)
def images_by_detections(inputs: Inputs) -> DataFrame:
    return reports.images_by_detections(inputs.view("fx_images"), inputs.view("fx_pred"))


@query(
    "recall_by_bucket",
    _ONE + """, sized AS (
  SELECT *, CASE WHEN (x2 - x1) * (y2 - y1) <= 0.01 THEN 'small'
    WHEN (x2 - x1) * (y2 - y1) <= 0.1 THEN 'medium' ELSE 'large' END AS bucket FROM fx_gt)
SELECT bucket, count(*) AS ground_truth, count(h.pred_idx) AS true_positives,
  round(count(h.pred_idx) / count(*), 9) AS recall
FROM sized s LEFT JOIN hits h ON h.image_id = s.image_id AND h.gt_idx = s.gt_idx GROUP BY 1""",
)
def recall_by_bucket(inputs: Inputs) -> DataFrame:
    rows = reports.recall_by_bucket(inputs.view("fx_gt"), _matches(inputs))
    return rows.withColumn("recall", F.round("recall", 9))


@query(
    "confusion_counts",
    _ONE + """SELECT (SELECT count(*) FROM hits) AS true_positives,
  (SELECT count(*) FROM fx_pred) - (SELECT count(*) FROM hits) AS false_positives,
  (SELECT count(*) FROM fx_gt) - (SELECT count(*) FROM hits) AS false_negatives""",
)
def confusion_counts(inputs: Inputs) -> DataFrame:
    gt, pred = inputs.view("fx_gt"), inputs.view("fx_pred")
    return reports.confusion_counts(gt, pred, _matches(inputs))


_FRAME_TIMES = """SELECT o_orderkey AS image_id, o_custkey AS video_id,
  CAST(o_orderkey % 6000 AS DOUBLE) / 25 AS timestamp_seconds FROM """


@query(
    "false_alarms_per_minute",
    _ONE + f""", frames AS ({_FRAME_TIMES} orders),
wrong AS (SELECT image_id, count(*) AS n FROM fx_pred ANTI JOIN hits USING (image_id, pred_idx)
  GROUP BY 1)
SELECT video_id, CAST(floor(timestamp_seconds / 60) AS BIGINT) AS minute, count(*) AS frames,
  CAST(sum(coalesce(n, 0)) AS BIGINT) AS false_alarms
FROM frames f LEFT JOIN wrong w ON f.image_id = w.image_id GROUP BY 1, 2""",
)
def false_alarms_per_minute(inputs: Inputs) -> DataFrame:
    frames = inputs.sql(_FRAME_TIMES + "{orders}")
    return reports.false_alarms_per_minute(inputs.view("fx_pred"), _matches(inputs), frames)


def _beats_sql() -> str:
    """Nested CASE of the promotion order: r challenges, b holds."""
    text = "false"
    for name, direction in reversed(reports.RANKING):
        gain = f"(r.{name} - b.{name}) * {direction}"
        text = f"CASE WHEN {gain} > 0.002 THEN true WHEN {gain} < -0.002 THEN false ELSE {text} END"
    return text


@query(
    "champion",
    f"""WITH RECURSIVE ok AS (
  SELECT *, row_number() OVER (PARTITION BY dataset_fingerprint ORDER BY finished_at, run_id) AS n
  FROM fx_runs WHERE status = 'success' AND split = 'val' AND model_sha256 IS NOT NULL),
fold(dataset_fingerprint, n, run_id) AS (
  SELECT dataset_fingerprint, n, run_id FROM ok WHERE n = 1
  UNION ALL
  SELECT r.dataset_fingerprint, r.n, CASE WHEN {_beats_sql()} THEN r.run_id ELSE b.run_id END
  FROM fold f JOIN ok b ON b.dataset_fingerprint = f.dataset_fingerprint AND b.run_id = f.run_id
  JOIN ok r ON r.dataset_fingerprint = f.dataset_fingerprint AND r.n = f.n + 1)
SELECT dataset_fingerprint, arg_max(run_id, n) AS run_id FROM fold GROUP BY 1""",
)
def champion(inputs: Inputs) -> DataFrame:
    return reports.champion(inputs.view("fx_runs")).select("dataset_fingerprint", "run_id")
