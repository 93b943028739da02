"""The scalar helpers as SQL functions, for callers who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

_BODIES = {
    "box_ratio(n DOUBLE, d DOUBLE)": "coalesce(try_divide(n, d), 0D)",
    "box_overlap(a1 DOUBLE, a2 DOUBLE, b1 DOUBLE, b2 DOUBLE)": (
        "greatest(0D, least(a2, b2) - greatest(a1, b1))"
    ),
    "box_iou(ax1 DOUBLE, ay1 DOUBLE, ax2 DOUBLE, ay2 DOUBLE,"
    " bx1 DOUBLE, by1 DOUBLE, bx2 DOUBLE, by2 DOUBLE)": (
        "box_ratio(box_overlap(ax1, ax2, bx1, bx2) * box_overlap(ay1, ay2, by1, by2),"
        " (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1)"
        " - box_overlap(ax1, ax2, bx1, bx2) * box_overlap(ay1, ay2, by1, by2))"
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create temporary SQL functions ``box_ratio``, ``box_overlap`` and ``box_iou``."""
    for signature, body in _BODIES.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS DOUBLE RETURN {body}"
        )
    return [signature.split("(")[0] for signature in _BODIES]
