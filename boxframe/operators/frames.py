"""Video frames: selection, detection rows, latency and per-video summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.functions.boxes import clip_to_pixels, is_finite, ratio
from boxframe.functions.text import fixed6, fourcc
from boxframe.operators.checkpoints import cut_lineage
from boxframe.operators.quantiles import exact_quantiles
from boxframe.operators.ranking import HOT_ROWS, grouped_running_sums
from boxframe.schemas import DETECTION_COLUMNS

STAGES = ("preprocess_ms", "inference_ms", "postprocess_ms")


def video_metadata(videos: DataFrame) -> DataFrame:
    """Codec name, duration and ``problem`` for unusable size or frame rate."""
    fps = F.col("fps")
    bad = (F.col("width") <= 0) | (F.col("height") <= 0) | ~is_finite(fps) | (fps <= 0)
    usable = F.when(fps > 0, fps)
    return videos.select(
        *[c for c in videos.columns if c not in ("fourcc", "frame_count")],
        fourcc(F.col("fourcc")).alias("codec"),
        F.greatest(F.col("frame_count"), F.lit(0)).alias("frame_count"),
        F.when(F.col("frame_count") > 0, F.col("frame_count") / usable).alias("duration_seconds"),
        F.when(bad, "invalid_metadata").alias("problem"),
    )


def select_frames(
    frames: DataFrame,
    stride: int = 1,
    start_seconds: float | None = None,
    end_seconds: float | None = None,
) -> DataFrame:
    """Frames from the start, up to the end, every ``stride``-th counted from the start frame.

    A plain filter, so it also works on a stream.
    """
    if stride < 1:
        raise ValueError("stride must be at least 1")
    index, fps = F.col("frame_index"), F.col("fps")
    first = F.floor(F.lit(float(start_seconds or 0.0)) * fps)
    seconds = index / fps
    wanted = (index >= first) & ((index - first) % stride == 0)
    if end_seconds is not None:
        wanted = wanted & (seconds <= F.lit(float(end_seconds)))
    return frames.filter(wanted).withColumn("timestamp_seconds", seconds)


def detection_rows(detections: DataFrame, as_text: bool = False) -> DataFrame:
    """The 17 columns of a detection: clipped corners, pixel size, area ratio and stage times.

    Input columns: the frame's ``video_name, frame_index, timestamp_seconds, width, height`` and
    stage times, and the detection's class, confidence and corners. ``as_text`` renders numbers with
    six decimals, as in the CSV file.
    """
    names = ("x1", "y1", "x2", "y2")
    clipped = clip_to_pixels(*[F.col(c) for c in names], F.col("width"), F.col("height"))
    placed = detections.withColumns(dict(zip(names, clipped)))
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    frame_area = (F.col("width") * F.col("height")).cast("double")
    # Numbers first, text after: each value is then worked out once.
    numeric = placed.withColumns(
        {
            "box_width_pixels": w,
            "box_height_pixels": h,
            "box_area_pixels": w * h,
            "box_area_ratio": w * h / frame_area,
        }
    ).select(*DETECTION_COLUMNS)
    plain = ("video_name", "frame_index", "class_id", "class_name")
    return numeric.select(
        *[c if c in plain else _number(F.col(c), as_text).alias(c) for c in DETECTION_COLUMNS]
    )


def _number(value: Column, as_text: bool) -> Column:
    return fixed6(value) if as_text else value.cast("double")


def frame_rows(frames: DataFrame, as_text: bool = False) -> DataFrame:
    """The 7 frame columns, the video name first."""
    end_to_end = (
        F.col("end_to_end_ms") if "end_to_end_ms" in frames.columns else stage_sum(*STAGES)
    )
    return frames.select(
        "video_name",
        "frame_index",
        _number(F.col("timestamp_seconds"), as_text).alias("timestamp_seconds"),
        "detections",
        *[_number(F.col(s), as_text).alias(s) for s in STAGES],
        _number(end_to_end, as_text).alias("end_to_end_ms"),
    )


def stage_sum(*stages: str) -> Column:
    total = F.lit(0.0)
    for stage in stages:
        total = total + F.coalesce(F.col(stage), F.lit(0.0))
    return total


def bad_latency_samples(samples: DataFrame) -> DataFrame:
    """Samples with a stage that is negative or not finite."""
    bad = F.lit(False)
    for stage in STAGES:
        value = F.col(stage)
        bad = bad | (value.isNotNull() & (~is_finite(value) | (value < 0)))
    return samples.filter(bad)


def latency_summary(
    samples: DataFrame, by: Sequence[str] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Mean per stage, mean, median and p95 of their sum, and frames per second.

    Negative or non-finite samples, and a summary of nothing, are errors raised by the job itself.
    """
    clean = []
    for stage in STAGES:
        value = F.coalesce(F.col(stage), F.lit(0.0))
        clean.append(
            F.when(is_finite(value) & (value >= 0), value)
            .otherwise(F.raise_error(F.lit("latency samples must be finite and non-negative")).cast("double"))
            .alias(stage)
        )
    rows = samples.select(*by, *clean).withColumn("total", stage_sum(*STAGES))
    keys = list(by) or ["_all"]
    rows = cut_lineage(rows if by else rows.withColumn("_all", F.lit(0)))
    means = rows.groupBy(*keys).agg(
        *[F.avg(s).alias(f"mean_{s}") for s in STAGES],
        F.avg("total").alias("mean_end_to_end_ms"),
    )
    spread = exact_quantiles(
        rows,
        F.col("total"),
        {"median_end_to_end_ms": 0.5, "p95_end_to_end_ms": 0.95},
        keys,
        hot_rows,
        written=True,
    )
    result = means.join(spread, keys).withColumn(
        "fps", ratio(F.lit(1000.0), F.col("mean_end_to_end_ms"))
    )
    if by:
        return result
    one = result.drop("_all")
    whole = one.agg(F.count("*").alias("n"), F.max(F.struct(*one.columns)).alias("row"))
    nothing = F.raise_error(F.lit("a latency summary needs at least one sample"))
    return whole.select(F.when(F.col("n") == 1, F.col("row")).otherwise(nothing).alias("row")).select("row.*")


def video_summary(
    frames: DataFrame,
    detections: DataFrame,
    videos: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per-video totals, confidence and inference figures, processing rate and status.

    ``videos`` is ``(video_name, fps, elapsed_seconds, status)``; a video without frames keeps its
    row. Frames and detections are each aggregated before they meet.
    """
    frames = cut_lineage(frames.select("video_name", "detections", "inference_ms"))
    detections = cut_lineage(detections.select("video_name", "confidence"))
    by_frame = frames.groupBy("video_name").agg(
        F.count("*").alias("frames_processed"),
        F.count_if(F.col("detections") > 0).alias("frames_with_detections"),
        F.avg("inference_ms").alias("mean_inference_ms"),
    )
    by_detection = detections.groupBy("video_name").agg(
        F.count("*").alias("total_detections"),
        F.max("confidence").alias("confidence_max"),
        F.avg("confidence").alias("confidence_mean"),
    )
    inference = exact_quantiles(
        frames, F.col("inference_ms"), {"p95_inference_ms": 0.95}, ["video_name"], hot_rows, written=True
    )
    confidence = exact_quantiles(
        detections, F.col("confidence"), {"confidence_median": 0.5}, ["video_name"], hot_rows, written=True
    )
    joined = videos
    for part in (by_frame, by_detection, inference, confidence):
        joined = joined.join(part, "video_name", "left")
    counts = ("frames_processed", "frames_with_detections", "total_detections")
    joined = joined.na.fill(0, list(counts))
    rate = ratio(F.col("frames_processed"), F.col("elapsed_seconds"))
    return joined.select(
        "video_name",
        *counts,
        "confidence_max",
        "confidence_mean",
        "confidence_median",
        "mean_inference_ms",
        "p95_inference_ms",
        rate.alias("processing_fps"),
        F.when(F.col("fps") > 0, F.try_divide(rate, F.col("fps"))).alias("real_time_ratio"),
        "status",
    )


def running_detections(
    frames: DataFrame, key: str = "video_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``detections_so_far``, the running total while a video is scanned."""
    counted = frames.withColumn("_found", F.col("detections").cast("bigint"))
    order = [F.asc("frame_index")]
    levels = [F.floor(F.col("frame_index") / 65536)]
    totals = {"detections_so_far": "_found"}
    rows = grouped_running_sums(counted, [key], order, levels, totals, hot_rows)
    return rows.drop("_found")
