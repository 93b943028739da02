"""Column functions on axis-aligned boxes.

Every function takes and returns ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reasons for which an object is rejected, in the order they are tested.
REJECT_BAD_IMAGE = "Image dimensions must be positive"
REJECT_NOT_FINITE = "Bounding box contains NaN or infinite coordinates"
REJECT_DEGENERATE = "Bounding box is degenerate after clipping"
REJECT_OUT_OF_RANGE = "Normalized bounding box falls outside [0, 1]"
REJECT_NO_SIZE = "Normalized bounding box has non-positive size"
REJECT_OUTSIDE = "Normalized bounding box extends outside the image"

# Numeric slack and the default area limits.
NORMALIZE_SLACK = 1e-9
LABEL_SLACK = 1e-6
AREA_SLACK = 1e-12
SMALL_AREA_MAX = 0.01
MEDIUM_AREA_MAX = 0.10


def is_finite(value: Column) -> Column:
    """True for ordinary numbers. NaN sorts above infinity in Spark, so one compare rejects both."""
    return F.coalesce(F.abs(value.cast("double")) < F.lit(float("inf")), F.lit(False))


def all_finite(values: Sequence[Column]) -> Column:
    result = is_finite(values[0])
    for value in values[1:]:
        result = result & is_finite(value)
    return result


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)


def box_area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return (x2 - x1) * (y2 - y1)


def iou(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Intersection over union of two ``(x1, y1, x2, y2)`` boxes; 0 where the union is empty."""
    zero = F.lit(0.0)
    overlap_w = F.greatest(zero, F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    overlap_h = F.greatest(zero, F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    overlap = overlap_w * overlap_h
    union = box_area(*a) + box_area(*b) - overlap
    return F.when(union > 0, F.try_divide(overlap, union)).otherwise(zero)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0.0 for a zero denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def center_to_corners(xc: Column, yc: Column, w: Column, h: Column) -> list[Column]:
    return [xc - w / 2, yc - h / 2, xc + w / 2, yc + h / 2]


def area_bucket(
    area: Column, small_max: float = SMALL_AREA_MAX, medium_max: float = MEDIUM_AREA_MAX
) -> Column:
    if not 0.0 < small_max < medium_max <= 1.0:
        raise ValueError("area limits must satisfy 0 < small < medium <= 1")
    return (
        F.when(area <= small_max, "small").when(area <= medium_max, "medium").otherwise("large")
    )


def is_small(area: Column, small_max: float = SMALL_AREA_MAX) -> Column:
    return area <= F.lit(small_max + AREA_SLACK)


def clip_to_pixels(
    x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column
) -> list[Column]:
    """Clip a detection to the frame and keep it at least one pixel wide and high."""
    w, h = width.cast("double"), height.cast("double")
    zero = F.lit(0.0)
    left, top = clamp(x1, zero, w - 1), clamp(y1, zero, h - 1)
    return [left, top, clamp(x2, left + 1, w), clamp(y2, top + 1, h)]


def box_problem(
    x1: Column, y1: Column, x2: Column, y2: Column, class_id: Column, confidence: Column | None
) -> Column:
    """First broken rule of a normalised box, or null for a valid one."""
    corners = [x1, y1, x2, y2]
    inside = (x1 >= 0) & (y1 >= 0) & (x2 <= 1) & (y2 <= 1)
    rule = (
        F.when(~all_finite(corners), "not_finite")
        .when(~inside, "outside_unit_square")
        .when((x2 <= x1) | (y2 <= y1), "not_positive_size")
        .when(F.coalesce(class_id != 0, F.lit(True)), "class_not_zero")
    )
    if confidence is not None:
        rule = rule.when(
            confidence.isNotNull() & ~(is_finite(confidence) & confidence.between(0, 1)),
            "confidence_outside_unit_interval",
        )
    return rule


def detection_problem(
    x1: Column, y1: Column, x2: Column, y2: Column, confidence: Column
) -> Column:
    """First broken rule of a pixel detection, or null for a valid one."""
    return (
        F.when(~all_finite([confidence, x1, y1, x2, y2]), "not_finite")
        .when(~confidence.between(0, 1), "confidence_outside_unit_interval")
        .when((x2 <= x1) | (y2 <= y1), "degenerate")
    )


def outside_problem(xc: Column, yc: Column, w: Column, h: Column) -> Column:
    """Reason why a normalised centre box is not inside its image, or null."""
    low, high = F.lit(-NORMALIZE_SLACK), F.lit(1.0 + NORMALIZE_SLACK)
    in_unit = xc.between(0, 1) & yc.between(0, 1) & w.between(0, 1) & h.between(0, 1)
    within = (
        (xc - w / 2 >= low) & (xc + w / 2 <= high) & (yc - h / 2 >= low) & (yc + h / 2 <= high)
    )
    return (
        F.when(~in_unit, REJECT_OUT_OF_RANGE)
        .when((w <= 0) | (h <= 0), REJECT_NO_SIZE)
        .when(~within, REJECT_OUTSIDE)
    )
