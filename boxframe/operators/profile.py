"""Dataset profile: counts per split, source classes, repairs, box areas, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions.boxes import (
    MEDIUM_AREA_MAX,
    REJECT_BAD_IMAGE,
    REJECT_DEGENERATE,
    REJECT_NOT_FINITE,
    SMALL_AREA_MAX,
    all_finite,
    area_bucket,
    clamp,
    outside_problem,
)
from boxframe.functions.text import label_line
from boxframe.operators.splits import split_names
from boxframe.schemas import SPLITS


def normalize_boxes(objects: DataFrame, clip: bool = True) -> DataFrame:
    """Add normalised centre boxes and ``reject_reason`` to pixel objects with their image size.

    The coordinates are null exactly when a reason is set. The steps are separate projections, so
    that each value is computed once instead of being copied into every expression that uses it.
    """
    sides = ("xmin", "ymin", "xmax", "ymax")
    if clip:
        limits = {"x": F.col("width"), "y": F.col("height")}
        cut = {f"_{s}": clamp(F.col(s), F.lit(0.0), limits[s[0]].cast("double")) for s in sides}
    else:
        cut = {f"_{s}": F.col(s) for s in sides}
    left, top, right, bottom = (F.col(f"_{s}") for s in sides)
    first = (
        F.when(~((F.col("width") > 0) & (F.col("height") > 0)), REJECT_BAD_IMAGE)
        .when(~all_finite([F.col(s) for s in sides]), REJECT_NOT_FINITE)
        .when((right <= left) | (bottom <= top), REJECT_DEGENERATE)
    )
    width = F.when(F.col("_reason").isNull(), F.col("width"))
    height = F.when(F.col("_reason").isNull(), F.col("height"))
    box = {
        "x_center": (left + right) / 2 / width,
        "y_center": (top + bottom) / 2 / height,
        "box_width": (right - left) / width,
        "box_height": (bottom - top) / height,
    }
    result = objects.withColumns(cut).withColumn("_reason", first).withColumns(box)
    if clip:
        # A clipped box of positive size is inside its image, so the further rules cannot fail.
        return result.withColumnRenamed("_reason", "reject_reason").drop(*cut)
    later = F.coalesce("_reason", outside_problem(*[F.col(c) for c in box]))
    kept = {c: F.when(F.col("reject_reason").isNull(), F.col(c)) for c in box}
    return result.withColumn("reject_reason", later).withColumns(kept).drop("_reason", *cut)


def remap_classes(objects: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Set ``class_id``: 0 for everything, or by a ``(class_name, class_id)`` table."""
    if mapping is None:
        return objects.withColumn("class_id", F.lit(0))
    return objects.drop("class_id").join(mapping, "class_name", "left")


def check_dimensions(
    annotated: DataFrame, measured: DataFrame | None = None, verify: bool = True
) -> DataFrame:
    """Image size to use and ``dimension_mismatch``.

    ``annotated`` has ``xml_width, xml_height``, ``measured`` is ``(image_id, width, height)``; without
    it the measured size is already part of ``annotated``. With ``verify`` the measured size is used,
    otherwise the annotated one.
    """
    if measured is not None:
        sizes = measured.select("image_id", "width", "height")
        annotated = annotated.join(sizes, "image_id", "left")
    mismatch = (F.col("width") != F.col("xml_width")) | (F.col("height") != F.col("xml_height"))
    flagged = annotated.withColumn("dimension_mismatch", mismatch)
    if verify:
        return flagged
    return flagged.withColumns({"width": F.col("xml_width"), "height": F.col("xml_height")})


def split_stats(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Images, objects and empty images of the three splits; a split without images has zeros."""
    per_image = boxes.groupBy("image_id").agg(F.count("*").alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    stats = (
        images.select("image_id", "split")
        .join(per_image, "image_id", "left")
        .groupBy("split")
        .agg(
            F.count("*").alias("images"),
            F.sum(n).alias("objects"),
            F.count_if(n == 0).alias("empty_images"),
        )
    )
    return split_names(images.sparkSession).join(stats, "split", "left").na.fill(0)


def category_counts(objects: DataFrame) -> DataFrame:
    """Objects per source class, rejected ones included."""
    return objects.groupBy("class_name").agg(F.count("*").alias("objects"))


def repair_counts(images: DataFrame, objects: DataFrame) -> DataFrame:
    """One row: images with a size mismatch and rejected objects."""
    rejected = objects.agg(F.count("reject_reason").alias("n")).scalar()
    return images.agg(F.count_if("dimension_mismatch").alias("dimension_mismatches")).withColumn(
        "rejected_objects", rejected
    )


def area_buckets(
    boxes: DataFrame, small_max: float = SMALL_AREA_MAX, medium_max: float = MEDIUM_AREA_MAX
) -> DataFrame:
    """One row: small, medium and large box counts."""
    bucket = area_bucket(F.col("box_width") * F.col("box_height"), small_max, medium_max)
    return boxes.select(bucket.alias("b")).agg(
        *[F.count_if(F.col("b") == name).alias(name) for name in ("small", "medium", "large")]
    )


def dataset_counts(items: DataFrame) -> DataFrame:
    """Images and objects per source and split."""
    return items.groupBy("source", "split").agg(
        F.count("*").alias("images"), F.sum("object_count").alias("objects")
    )


def dataset_counts_wide(items: DataFrame) -> DataFrame:
    """Images and objects per source with a column pair per split."""
    columns = []
    for split in SPLITS:
        here = F.col("split") == split
        columns.append(F.count_if(here).alias(f"{split}_images"))
        columns.append(
            F.coalesce(F.sum(F.when(here, F.col("object_count"))), F.lit(0)).alias(
                f"{split}_objects"
            )
        )
    return items.groupBy("source").agg(*columns)


def label_text(
    images: DataFrame, boxes: DataFrame, lines_per_part: int = 1024
) -> DataFrame:
    """``(image_id, part, text)``: label lines of an image in object order.

    The parts of an image, one after the other, are its label file. A part covers a fixed range of
    object numbers, so its size is bounded however many objects an image has. An image without
    boxes has one empty part.
    """
    line = label_line(*[F.col(c) for c in ("class_id", "x_center", "y_center", "box_width", "box_height")])
    numbered = boxes.select(
        "image_id", "obj_idx", F.floor(F.col("obj_idx") / lines_per_part).alias("part"), line.alias("line")
    )
    entries = F.array_sort(F.collect_list(F.struct("obj_idx", "line")))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["line"], F.lit("\n"))), "")
    parts = numbered.groupBy("image_id", "part").agg(text.alias("text"))
    empty = images.select("image_id").join(boxes, "image_id", "left_anti")
    return parts.unionByName(
        empty.select("image_id", F.lit(0).cast("bigint").alias("part"), F.lit("").alias("text"))
    )
