"""Summary of scored video frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.operators.frames import (
    detection_rows,
    frame_rows,
    select_frames,
    video_metadata,
    video_summary,
)


def video_tables(
    scored: DataFrame,
    videos: DataFrame,
    stride: int = 1,
    start_seconds: float | None = None,
    end_seconds: float | None = None,
    as_text: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(detections, frames, summary)`` of scored frames.

    ``scored`` is ``(video_name, frame_index, detections, stage times)``, ``videos``
    ``(video_name, width, height, fps, frame_count, fourcc, elapsed_seconds, status)``. Videos with
    unusable metadata are left out of the frame tables.
    """
    known = video_metadata(videos).filter("problem is null").drop("problem")
    frames = scored.join(known.select("video_name", "width", "height", "fps"), "video_name")
    chosen = select_frames(frames, stride, start_seconds, end_seconds)
    exploded = chosen.select(
        *[c for c in chosen.columns if c != "detections"], F.explode("detections").alias("d")
    ).select("*", "d.*")
    counted = chosen.withColumn("detections", F.size("detections"))
    summary = video_summary(
        counted,
        exploded.select("video_name", "confidence"),
        known.select("video_name", "fps", "elapsed_seconds", "status"),
    )
    return detection_rows(exploded, as_text), frame_rows(counted, as_text), summary
