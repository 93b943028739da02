"""Raw model results: parallel arrays to box rows, stage timings, class names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.functions.boxes import is_finite

STAGES = ("preprocess", "inference", "postprocess")


def check_results(results: DataFrame, boxes_col: str = "xyxyn") -> DataFrame:
    """Add ``problem``: uneven arrays, rows that are not four numbers, missing or bad timings."""
    boxes, conf, cls, speed = (F.col(c) for c in (boxes_col, "conf", "cls", "speed"))

    def count(values: Column) -> Column:
        return F.when(values.isNull(), 0).otherwise(F.size(values))

    uneven = (count(boxes) != count(conf)) | (count(boxes) != count(cls))
    wrong_arity = F.exists(boxes, lambda b: b.isNull() | (F.size(b) != 4))
    not_numeric = F.exists(boxes, lambda b: F.exists(b, lambda v: ~is_finite(v))) | F.exists(
        F.concat(conf, cls), lambda v: ~is_finite(v)
    )
    bad_timing = F.lit(False)
    for stage in STAGES:
        value = F.try_element_at(speed, F.lit(stage))
        bad_timing = bad_timing | (value.isNotNull() & (~is_finite(value) | (value < 0)))
    problem = (
        F.when(uneven, "uneven_arrays")
        .when(F.coalesce(wrong_arity, F.lit(False)), "box_arity")
        .when(F.coalesce(not_numeric, F.lit(False)), "not_numeric")
        .when(speed.isNull(), "missing_timing")
        .when(bad_timing, "invalid_timing")
    )
    return results.withColumn("problem", problem)


def explode_predictions(
    results: DataFrame, id_col: str = "image_id", boxes_col: str = "xyxyn"
) -> DataFrame:
    """One row per predicted box of the results without a problem."""
    good = check_results(results, boxes_col).filter("problem is null")
    zipped = F.arrays_zip(
        F.col(boxes_col).alias("box"), F.col("conf").alias("conf"), F.col("cls").alias("cls")
    )
    rows = good.select(id_col, F.posexplode(zipped).alias("pred_idx", "z"))
    box = F.col("z")["box"]
    return rows.select(
        id_col,
        "pred_idx",
        *[F.element_at(box, i + 1).alias(name) for i, name in enumerate(("x1", "y1", "x2", "y2"))],
        F.col("z")["cls"].cast("int").alias("class_id"),
        F.col("z")["conf"].alias("confidence"),
    )


def stage_timings(results: DataFrame, id_col: str = "image_id") -> DataFrame:
    """Milliseconds per stage; a stage without an entry took 0."""
    good = results.filter("speed is not null")
    return good.select(
        id_col,
        *[
            F.coalesce(F.try_element_at("speed", F.lit(s)), F.lit(0.0)).alias(f"{s}_ms")
            for s in STAGES
        ],
    )

