"""Queries on frames, latency, runs, scoring and streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions import text as tx
from boxframe.operators import frames, runs, scoring
from boxframe.plans.fixtures import Inputs
from boxframe.plans.registry import query
from boxframe.streaming import frames as streams
from boxframe.streaming import state


def _round(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    "frame_select",
    """SELECT video_id, frame_index, round(frame_index / fps, 9) AS timestamp_seconds FROM fx_frames
WHERE frame_index >= 5 AND frame_index / fps <= 2.0 AND (frame_index - 5) % 3 = 0""",
)
def frame_select(inputs: Inputs) -> DataFrame:
    chosen = frames.select_frames(inputs.view("fx_frames"), 3, 0.2, 2.0)
    rows = chosen.select("video_id", "frame_index", "timestamp_seconds")
    return _round(rows, "timestamp_seconds", digits=9)


@query(
    "running_detections",
    """SELECT video_id, frame_index, detections, CAST(sum(detections) OVER (
  PARTITION BY video_id ORDER BY frame_index) AS BIGINT) AS detections_so_far FROM fx_frames""",
)
def running_detections(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_frames").select("video_id", "frame_index", "detections")
    return frames.running_detections(rows)


def _detections(inputs: Inputs) -> DataFrame:
    """One detection per object, on the frame of its image."""
    size = inputs.view("fx_images").select("image_id", "width", "height")
    return (
        inputs.view("fx_objects")
        .join(size, "image_id")
        .select(
            F.concat(F.lit("v"), F.col("image_id") % 50).alias("video_name"),
            F.col("image_id").alias("frame_index"),
            (F.col("image_id") / 25.0).alias("timestamp_seconds"),
            "width",
            "height",
            F.lit(0).alias("class_id"),
            "class_name",
            (F.col("obj_idx") % 64 / 64.0).alias("confidence"),
            F.col("xmin").alias("x1"),
            F.col("ymin").alias("y1"),
            F.col("xmax").alias("x2"),
            F.col("ymax").alias("y2"),
            F.lit(0.5).alias("preprocess_ms"),
            (F.col("width") / 64.0).alias("inference_ms"),
            F.lit(0.25).alias("postprocess_ms"),
            "obj_idx",
        )
    )


_DETECTIONS = """WITH d AS (
  SELECT 'v' || (o.image_id % 50) AS video_name, o.image_id AS frame_index, o.image_id / 25.0::DOUBLE AS ts,
    i.width, i.height, class_name, obj_idx % 64 / 64.0::DOUBLE AS confidence, xmin, ymin, xmax, ymax
  FROM fx_objects o JOIN fx_images i ON o.image_id = i.image_id),
l AS (SELECT *, least(greatest(xmin, 0), width - 1) AS x1, least(greatest(ymin, 0), height - 1) AS y1 FROM d),
c AS (SELECT *, least(greatest(xmax, x1 + 1), width) AS x2, least(greatest(ymax, y1 + 1), height) AS y2 FROM l)
"""


def _fixed(expression: str) -> str:
    return f"printf('%.6f', ({expression})::DOUBLE)"


@query(
    "detection_rows",
    _DETECTIONS + f"""SELECT video_name, frame_index, {_fixed('ts')} AS timestamp_seconds, 0 AS class_id,
  class_name, {_fixed('confidence')} AS confidence, {_fixed('x1')} AS x1, {_fixed('x2')} AS x2,
  {_fixed('y1')} AS y1, {_fixed('y2')} AS y2, {_fixed('x2 - x1')} AS box_width_pixels,
  {_fixed('y2 - y1')} AS box_height_pixels, {_fixed('(x2 - x1) * (y2 - y1)')} AS box_area_pixels,
  {_fixed('(x2 - x1) * (y2 - y1) / (width * height)')} AS box_area_ratio, '0.500000' AS preprocess_ms,
  {_fixed('width / 64.0::DOUBLE')} AS inference_ms, '0.250000' AS postprocess_ms FROM c""",
)
def detection_rows(inputs: Inputs) -> DataFrame:
    return frames.detection_rows(_detections(inputs), as_text=True)


@query(
    "latency_summary",
    """WITH s AS (SELECT preprocess_ms AS a, inference_ms AS b, postprocess_ms AS c,
  preprocess_ms + inference_ms + postprocess_ms AS t FROM fx_frames)
SELECT round(avg(a), 6) AS mean_preprocess_ms, round(avg(b), 6) AS mean_inference_ms,
  round(avg(c), 6) AS mean_postprocess_ms, round(avg(t), 6) AS mean_end_to_end_ms,
  round(quantile_cont(t, 0.5), 6) AS median_end_to_end_ms,
  round(quantile_cont(t, 0.95), 6) AS p95_end_to_end_ms, round(1000 / avg(t), 6) AS fps FROM s""",
)
def latency_summary(inputs: Inputs) -> DataFrame:
    rows = frames.latency_summary(inputs.view("fx_frames"))
    return _round(rows, *rows.columns)


_VIDEOS = """SELECT user_id AS video_name, CAST(25 AS DOUBLE) AS fps,
  CAST(count(*) AS DOUBLE) / 8 AS elapsed_seconds, 'complete' AS status FROM """


@query(
    "video_summary",
    f"""WITH v AS ({_VIDEOS} events GROUP BY user_id),
f AS (SELECT video_id, count(*) AS n, count(*) FILTER (WHERE detections > 0) AS w,
  avg(inference_ms) AS m, quantile_cont(inference_ms, 0.95) AS p FROM fx_frames GROUP BY 1),
d AS (SELECT user_id, count(*) AS n, max(c) AS mx, avg(c) AS me, quantile_cont(c, 0.5) AS md FROM (
  SELECT user_id, CAST(event_id % 64 AS DOUBLE) / 64 AS c FROM events WHERE event_type <> 'error')
  GROUP BY 1)
SELECT v.video_name, f.n AS frames_processed, f.w AS frames_with_detections,
  coalesce(d.n, 0) AS total_detections, mx AS confidence_max, round(me, 6) AS confidence_mean,
  md AS confidence_median, round(m, 6) AS mean_inference_ms, round(p, 6) AS p95_inference_ms,
  round(f.n / elapsed_seconds, 6) AS processing_fps, round(f.n / elapsed_seconds / fps, 6) AS real_time_ratio,
  status FROM v LEFT JOIN f ON f.video_id = v.video_name LEFT JOIN d ON d.user_id = v.video_name""",
)
def video_summary(inputs: Inputs) -> DataFrame:
    videos = inputs.sql(_VIDEOS + "{events} GROUP BY user_id")
    detections = inputs.table("events").filter("event_type <> 'error'")
    rows = frames.video_summary(
        inputs.view("fx_frames").withColumnRenamed("video_id", "video_name"),
        detections.select(
            F.col("user_id").alias("video_name"), (F.col("event_id") % 64 / 64.0).alias("confidence")
        ),
        videos,
    )
    return _round(
        rows,
        "confidence_mean",
        "mean_inference_ms",
        "p95_inference_ms",
        "processing_fps",
        "real_time_ratio",
    )


_META = """SELECT event_id AS video_name, CAST(event_id % 5 * 320 AS INT) AS width, 480 AS height,
  CASE WHEN event_id % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(25 AS DOUBLE) END AS fps,
  user_id - 3 AS frame_count, CAST(0 AS INT) AS fourcc FROM """


@query(
    "video_metadata",
    f"""SELECT video_name, width, height, fps, CAST(NULL AS VARCHAR) AS codec,
  greatest(frame_count, 0) AS frame_count,
  CASE WHEN frame_count > 0 AND fps > 0 THEN frame_count / fps END AS duration_seconds,
  CASE WHEN width <= 0 OR height <= 0 OR fps <= 0 THEN 'invalid_metadata' END AS problem
FROM ({_META} events) AS v""",
)
def video_metadata(inputs: Inputs) -> DataFrame:
    return frames.video_metadata(inputs.sql(_META + "{events}"))


_FAILURES = """SELECT event_id, event_type, CASE WHEN event_id % 5 = 0 THEN 'CUDA Out Of Memory at step '
  || CAST(event_id AS STRING) WHEN event_id % 5 = 1 THEN event_type END AS message FROM """


@query(
    "failure_class",
    f"""SELECT event_id, message, lower(message) LIKE '%out of memory%' AS out_of_memory,
  CASE WHEN lower(message) LIKE '%out of memory%' THEN '{tx.OUT_OF_MEMORY_ADVICE}' END AS recommendation
FROM ({_FAILURES} events) AS f""",
)
def failure_class(inputs: Inputs) -> DataFrame:
    rows = inputs.sql(_FAILURES + "{events}").drop("event_type")
    return runs.classify_failures(rows)


_LEDGER = """SELECT user_id AS run_id, ts, event_id, CASE event_type WHEN 'signup' THEN 'initializing'
  WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'running' END AS status FROM """


@query(
    "run_latest",
    f"""SELECT run_id, arg_max(event_id, (ts, event_id)) AS event_id,
  arg_max(status, (ts, event_id)) AS status, count(*) AS n_events FROM ({_LEDGER} events) AS l GROUP BY 1""",
)
def run_latest(inputs: Inputs) -> DataFrame:
    return runs.run_latest(inputs.sql(_LEDGER + "{events}")).drop("ts")


@query(
    "run_history",
    f"""SELECT run_id, event_id, status, row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id)
  AS seq FROM ({_LEDGER} events) AS l""",
)
def run_history(inputs: Inputs) -> DataFrame:
    return runs.run_history(inputs.sql(_LEDGER + "{events}")).drop("ts")


@query(
    "run_transitions",
    f"""WITH h AS (SELECT run_id, status, row_number() OVER w AS seq, lag(status) OVER w AS previous
  FROM ({_LEDGER} events) AS l WINDOW w AS (PARTITION BY run_id ORDER BY ts, event_id))
SELECT run_id, seq, status, previous, CASE WHEN previous IS NULL THEN status = 'initializing'
  ELSE (previous || '>' || status) IN ('initializing>running', 'initializing>failed',
    'initializing>initializing', 'running>initializing', 'running>success', 'running>failed', 'failed>initializing') END AS allowed FROM h""",
)
def run_transitions(inputs: Inputs) -> DataFrame:
    return runs.transitions(inputs.sql(_LEDGER + "{events}"))


_RUNS = """SELECT CAST(c_custkey AS STRING) AS run_id,
  CASE WHEN c_custkey % 9 = 0 THEN 'elsewhere' ELSE CAST(c_custkey AS STRING) END AS directory,
  CASE WHEN c_custkey % 4 = 0 THEN 'success' ELSE 'failed' END AS status, c_nationkey AS dataset,
  CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN 'old' ELSE n_name END
    AS dataset_fingerprint FROM """


@query(
    "resume_gate",
    f"""SELECT run_id, status, CASE WHEN run_id <> directory THEN 'run_id_mismatch'
  WHEN status = 'success' THEN 'already_successful' WHEN dataset_fingerprint = '' THEN 'no_fingerprint'
  WHEN dataset_fingerprint <> n_name THEN 'fingerprint_changed' END AS refusal
FROM ({_RUNS} customer JOIN nation ON c_nationkey = n_nationkey) AS r
JOIN nation ON n_nationkey = r.dataset""",
)
def resume_gate(inputs: Inputs) -> DataFrame:
    asked = inputs.sql(_RUNS + "{customer} JOIN {nation} ON c_nationkey = n_nationkey")
    datasets = inputs.table("nation").select(
        F.col("n_nationkey").alias("dataset"), F.col("n_name").alias("current_fingerprint")
    )
    return runs.resume_gate(asked, datasets)


_ATTEMPTS = """SELECT user_id AS run_id, ts, event_id,
  CASE WHEN user_id % 9 = 0 THEN 'elsewhere' ELSE 'runs/' || CAST(user_id AS STRING) END ||
    CASE event_type WHEN 'click' THEN '/weights/best.pt' ELSE '/weights/last.pt' END AS checkpoint,
  sha256(event_type) AS checkpoint_sha256, event_id % 3 = 0 AS allow_dataset_change FROM """
_RECORDED = """SELECT c_custkey AS run_id, CASE WHEN c_custkey % 4 = 0 THEN 'success' ELSE 'failed' END AS status,
  c_nationkey AS dataset, CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN 'old' ELSE n_name END
    AS dataset_fingerprint FROM """


@query(
    "resume_records",
    f"""WITH j AS (SELECT a.*, nullif(r.dataset_fingerprint, '') AS original_fingerprint, n_name AS current_fingerprint,
  CASE WHEN a.checkpoint LIKE '%best.pt' THEN 'checkpoint_layout' WHEN r.run_id IS NULL THEN 'unknown_run'
    WHEN a.run_id % 9 = 0 THEN 'run_id_mismatch' WHEN status = 'success' THEN 'already_successful'
    WHEN r.dataset_fingerprint = '' THEN 'no_fingerprint'
    WHEN r.dataset_fingerprint <> n_name AND NOT allow_dataset_change THEN 'fingerprint_changed' END AS refusal
  FROM ({_ATTEMPTS} events) AS a LEFT JOIN
    ({_RECORDED} customer JOIN nation ON c_nationkey = n_nationkey) AS r ON r.run_id = a.run_id
    LEFT JOIN nation ON n_nationkey = r.dataset)
SELECT run_id, event_id, refusal, original_fingerprint, current_fingerprint,
  original_fingerprint <> current_fingerprint AS dataset_changed, checkpoint, checkpoint_sha256,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS resumed_at_utc,
  CASE WHEN refusal IS NULL THEN row_number() OVER (PARTITION BY run_id, refusal IS NULL ORDER BY ts, event_id) END AS seq FROM j""",
)
def resume_records(inputs: Inputs) -> DataFrame:
    attempts = inputs.sql(_ATTEMPTS.replace("sha256(event_type)", "sha2(event_type, 256)") + "{events}")
    recorded = inputs.sql(_RECORDED + "{customer} JOIN {nation} ON c_nationkey = n_nationkey")
    datasets = inputs.table("nation").select(
        F.col("n_nationkey").alias("dataset"), F.col("n_name").alias("current_fingerprint")
    )
    return runs.resume_records(attempts, recorded, datasets)


@query(
    "artifact_verify",
    """SELECT doc_id AS run_id, 'best' AS name, CASE WHEN l.doc_id IS NULL THEN 'missing'
  WHEN l.quality = 0 AND l.toxic = 1 THEN 'empty' WHEN l.toxic = 1 THEN 'hash_mismatch' END AS problem
FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def artifact_verify(inputs: Inputs) -> DataFrame:
    docs = inputs.table("documents")
    sha = F.sha2("text", 256)
    recorded = docs.select(
        F.col("doc_id").alias("run_id"), F.lit("best").alias("name"), sha.alias("sha256")
    )
    toxic = F.col("toxic") == 1
    found = docs.join(inputs.table("labels"), "doc_id").select(
        F.col("doc_id").alias("run_id"),
        F.lit("best").alias("name"),
        F.when(toxic, "other").otherwise(sha).alias("sha256"),
        F.when(toxic & (F.col("quality") == 0), 0).otherwise(F.col("n_chars") + 1).alias("size_bytes"),
    )
    return runs.verify_artifacts(recorded, found)


_PROMOTIONS = """SELECT event_id AS promotion_id, event_type AS name, ts AS promoted_at FROM """


@query(
    "registry_view",
    f"""SELECT promotion_id, name, promotion_id = arg_max(promotion_id, (promoted_at, promotion_id))
  OVER (PARTITION BY name) AS active FROM ({_PROMOTIONS} events) AS p""",
)
def registry_view(inputs: Inputs) -> DataFrame:
    return runs.registry_view(inputs.sql(_PROMOTIONS + "{events}")).drop("promoted_at")


def _fixed_detector():
    """A detector for tests: box and confidence follow from the frame itself."""

    def detect(batch: pd.DataFrame, confidence: float) -> pd.DataFrame:
        found = []
        for event_id, value in zip(batch["event_id"], batch["value"]):
            score = (event_id % 128) / 128
            left = float(event_id % 100)
            box = {
                "class_id": 0,
                "class_name": "object",
                "confidence": score,
                "x1": left,
                "y1": left,
                "x2": left + 8.0,
                "y2": left + 4.0,
            }
            found.append([box] if score >= confidence else [])
        return pd.DataFrame(
            {
                "detections": found,
                "preprocess_ms": 0.5,
                "inference_ms": batch["value"].to_numpy(),
                "postprocess_ms": 0.25,
            }
        )

    return detect


@query(
    "score_frames",
    """SELECT event_id, CAST((event_id % 128) / 128.0::DOUBLE >= 0.25 AS INTEGER) AS n,
  CASE WHEN (event_id % 128) / 128.0::DOUBLE >= 0.25 THEN (event_id % 100)::DOUBLE END AS x1,
  value AS inference_ms FROM events""",
)
def score_frames(inputs: Inputs) -> DataFrame:
    scored = scoring.score_frames(
        inputs.table("events").select("event_id", "value"),
        _fixed_detector,
        ["event_id"],
        confidence=0.25,
    )
    first = F.try_element_at("detections", F.lit(1))
    return scored.select(
        "event_id", F.size("detections").alias("n"), first["x1"].alias("x1"), "inference_ms"
    )


def _event_stream(inputs: Inputs, parts: int = 4) -> DataFrame:
    """The events as a stream of files in time order, one file a batch."""
    folder = f"{streams.work_folder(inputs.spark)}/events"
    events = inputs.table("events")
    streams.write_in_order(events, "ts", parts, folder)
    reader = inputs.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(folder)


def _frame_stream(inputs: Inputs) -> DataFrame:
    return _event_stream(inputs).select(
        F.col("user_id").alias("video_name"),
        F.col("event_id").cast("int").alias("frame_index"),
        F.lit(25.0).alias("fps"),
        F.when(F.col("event_type") == "error", 0)
        .otherwise(F.col("event_id") % 4)
        .cast("int")
        .alias("detections"),
        (F.col("event_id") % 16 / 8.0).alias("preprocess_ms"),
        F.col("value").alias("inference_ms"),
        (F.col("event_id") % 8 / 16.0).alias("postprocess_ms"),
    )


@query(
    "stream_frame_metrics",
    """SELECT user_id AS video_name, CAST(event_id AS INTEGER) AS frame_index,
  round(event_id / 25.0::DOUBLE, 9) AS timestamp_seconds,
  CASE WHEN event_type = 'error' THEN 0 ELSE CAST(event_id % 4 AS INTEGER) END AS detections,
  round(event_id % 16 / 8.0::DOUBLE + value + event_id % 8 / 16.0::DOUBLE, 6) AS end_to_end_ms
FROM events WHERE event_id >= 50 AND (event_id - 50) % 2 = 0""",
)
def stream_frame_metrics(inputs: Inputs) -> DataFrame:
    rows = streams.run_append(streams.stream_frame_metrics(_frame_stream(inputs), 2, 2.0))
    kept = rows.select("video_name", "frame_index", "timestamp_seconds", "detections", "end_to_end_ms")
    return kept.withColumns(
        {
            "timestamp_seconds": F.round("timestamp_seconds", 9),
            "end_to_end_ms": F.round("end_to_end_ms", 6),
        }
    )


@query(
    "stream_video_summary",
    """SELECT user_id AS video_name, count(*) AS frames_processed,
  count(*) FILTER (WHERE d > 0) AS frames_with_detections, CAST(sum(d) AS BIGINT) AS total_detections,
  round(sum(value), 6) AS inference_ms_sum, max(value) AS inference_ms_max,
  quantile_disc(value, 0.95) AS p95_inference_ms
FROM (SELECT *, CASE WHEN event_type = 'error' THEN 0 ELSE event_id % 4 END AS d FROM events) AS e
GROUP BY 1""",
)
def stream_video_summary(inputs: Inputs) -> DataFrame:
    totals = streams.run_totals(state.stream_totals(_frame_stream(inputs), shares=2), ["video_name", "share"])
    return _round(state.merged_totals(totals), "inference_ms_sum")


_GAP, _DELAY = "6 hours", "10 minutes"


@query(
    "stream_completion",
    """WITH e AS (SELECT user_id, ts, event_type, event_id,
  CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS part FROM e),
s AS (SELECT user_id, part, count(*) AS frames, min(ts) AS a, max(ts) + INTERVAL 6 HOUR AS b,
  bool_or(event_type = 'purchase') AS ended, bool_or(event_type = 'error') AS bad,
  arg_min(event_id, ts) FILTER (WHERE event_type = 'error') AS first_bad
  FROM g GROUP BY 1, 2)
SELECT user_id AS video_name, strftime(a, '%Y-%m-%dT%H:%M:%SZ') AS started_at, frames,
  CASE WHEN bad THEN 'failed' WHEN ended THEN 'complete' ELSE 'incomplete' END AS status,
  CASE WHEN bad THEN 'error at ' || first_bad WHEN NOT ended THEN 'Interrupted by user' END AS error
FROM s""",
)
def stream_completion(inputs: Inputs) -> DataFrame:
    marks = _event_stream(inputs).select(
        F.col("user_id").alias("video_name"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_type") == "purchase").alias("is_end"),
        F.when(
            F.col("event_type") == "error", F.concat(F.lit("error at "), F.col("event_id"))
        ).alias("error"),
    )
    rows = streams.run_runs(marks, _GAP, _DELAY)
    return rows.select(
        "video_name", tx.utc_seconds(F.col("started_at")).alias("started_at"), "frames", "status", "error"
    )


@query("stream_dedup", "SELECT DISTINCT user_id AS image_id FROM events")
def stream_dedup(inputs: Inputs) -> DataFrame:
    results = _event_stream(inputs).select(
        F.col("user_id").alias("image_id"), F.col("ts").cast("timestamp").alias("ts")
    )
    # The delay spans the input, so a repeat is dropped wherever it comes.
    low, high = inputs.table("events").agg(F.min("ts"), F.max("ts")).first()
    days = (high - low).days + 1 if high is not None else 1
    return streams.run_append(streams.stream_dedup(results, "image_id", f"{days} days")).select("image_id")


@query(
    "stream_repeats",
    """SELECT user_id AS image_id, count(*) AS n_results, CASE WHEN count(*) > 1 THEN 'duplicate' END AS problem
FROM events GROUP BY 1""",
)
def stream_repeats(inputs: Inputs) -> DataFrame:
    results = _event_stream(inputs).select(F.col("user_id").alias("image_id"))
    return streams.run_totals(streams.stream_repeats(results), ["image_id"])
