"""Column layouts, as Spark DDL."""

from __future__ import annotations

# Annotation XML, all text: values are cast with a reason kept for each failure.
VOC_XML = (
    "filename string, "
    "size struct<width: string, height: string, depth: string>, "
    "object array<struct<name: string, truncated: string, difficult: string, "
    "bndbox: struct<xmin: string, ymin: string, xmax: string, ymax: string>>>, "
    "_corrupt_record string"
)
GROUND_TRUTH = (
    "image_id string, gt_idx int, x1 double, y1 double, x2 double, y2 double, class_id int"
)
PREDICTIONS = (
    "image_id string, pred_idx int, x1 double, y1 double, x2 double, y2 double, class_id int, "
    "confidence double"
)
DETECTION = (
    "struct<class_id: int, class_name: string, confidence: double, "
    "x1: double, y1: double, x2: double, y2: double>"
)
FRAME_PREDICTION = (
    f"detections array<{DETECTION}>, preprocess_ms double, inference_ms double, "
    "postprocess_ms double"
)
REGISTRY = (
    "active_model struct<name: string, release_tag: string, asset_name: string, sha256: string, "
    "imgsz: int, class_names: array<string>, selected_confidence_threshold: double, "
    "published_at_utc: string>, history array<struct<name: string, release_tag: string, "
    "sha256: string, published_at_utc: string>>, schema_version string, _corrupt_record string"
)

SPLITS = ("train", "val", "test")
# Column order of the two frame tables.
DETECTION_COLUMNS = (
    "video_name",
    "frame_index",
    "timestamp_seconds",
    "class_id",
    "class_name",
    "confidence",
    "x1",
    "x2",
    "y1",
    "y2",
    "box_width_pixels",
    "box_height_pixels",
    "box_area_pixels",
    "box_area_ratio",
    "preprocess_ms",
    "inference_ms",
    "postprocess_ms",
)
FRAME_COLUMNS = (
    "frame_index",
    "timestamp_seconds",
    "detections",
    "preprocess_ms",
    "inference_ms",
    "postprocess_ms",
    "end_to_end_ms",
)
# File types taken as images.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff", ".ppm")
