"""Label text: ``class x_center y_center width height`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.functions.boxes import LABEL_SLACK, all_finite, box_problem, center_to_corners
from boxframe.functions.text import stem_of, strip
from boxframe.operators.checkpoints import cut_lineage
from boxframe.operators.ranking import HOT_ROWS, grouped_row_number
from boxframe.sources.file_source import read_text_files, read_text_folders

_FIELDS = ("x_center", "y_center", "box_width", "box_height")


def read_label_files(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """``(label_path, image_id, text)``, one row per ``*.txt`` file in a folder.

    An empty file says that its image has no objects, so it keeps its row, unlike with Spark's own file sources.
    """
    files = read_text_files(spark, path, ".txt", "path string, text string", recursive="false", **options)
    return files.select(F.col("path").alias("label_path"), stem_of(F.col("path")).alias("image_id"), "text")


def read_label_folders(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_label_files`, for the folders in a folder, which are listed by tasks."""
    files = read_text_folders(spark, path, ".txt")
    return files.select(F.col("path").alias("label_path"), stem_of(F.col("path")).alias("image_id"), "text")


def file_reports(files: DataFrame, text_col: str = "text") -> DataFrame:
    """``(image_id, n_lines, rules)`` of every label file, an empty one too; ``rules`` are those broken, last name first.

    The texts are written down first, so that files are read once; one aggregate then counts lines and rules.
    """
    texts = cut_lineage(files.select("image_id", text_col))
    lines = label_lines(texts, text_col)
    nothing = F.lit(None).cast("string").alias("rule")
    rows = (
        texts.select("image_id", F.lit(0).alias("n"), nothing)
        .unionByName(lines.select("image_id", F.lit(1).alias("n"), nothing))
        .unionByName(label_issues(lines).select("image_id", F.lit(0).alias("n"), "rule"))
    )
    rules = F.sort_array(F.collect_set("rule"), False)
    return rows.groupBy("image_id").agg(
        F.sum("n").cast("int").alias("n_lines"), F.when(F.size(rules) > 0, F.array_join(rules, ",")).alias("rules")
    )


def label_lines(files: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per non-blank line with its 1-based number and typed fields.

    ``counted`` marks lines that stand for an object: five numeric, finite fields, even where a
    later rule is broken.
    """
    keep = [c for c in files.columns if c != text_col]
    # Lines are cut into fields inside the generator, so no later filter repeats that work.
    rows = F.transform(
        F.split(F.col(text_col), r"\r\n|[\n\r]"), lambda line: F.split(strip(line), r"\s+")
    )
    lines = files.select(*keep, F.posexplode(rows).alias("_pos", "_f")).filter(
        F.element_at("_f", 1) != ""
    )
    typed = lines.select(
        *keep,
        (F.col("_pos") + 1).alias("line_number"),
        F.size("_f").alias("n_fields"),
        F.try_element_at("_f", F.lit(1)).try_cast("int").alias("class_id"),
        *[
            F.try_element_at("_f", F.lit(i + 2)).try_cast("double").alias(name)
            for i, name in enumerate(_FIELDS)
        ],
    )
    numbers = [F.col(c) for c in ("class_id", *_FIELDS)]
    numeric = numbers[0].isNotNull()
    for number in numbers[1:]:
        numeric = numeric & number.isNotNull()
    counted = (F.col("n_fields") == 5) & numeric & all_finite(numbers[1:])
    return typed.withColumns({"numeric": numeric, "counted": counted})


def label_issues(lines: DataFrame) -> DataFrame:
    """Every broken rule of every line as a row ``(..., line_number, rule)``."""
    xc, yc, w, h = (F.col(c) for c in _FIELDS)
    counted = F.col("counted")
    outside = (
        (xc - w / 2 < -LABEL_SLACK)
        | (xc + w / 2 > 1 + LABEL_SLACK)
        | (yc - h / 2 < -LABEL_SLACK)
        | (yc + h / 2 > 1 + LABEL_SLACK)
    )
    unit = xc.between(0, 1) & yc.between(0, 1)
    sized = (w > 0) & (w <= 1) & (h > 0) & (h <= 1)

    def rule(broken: Column, name: str) -> Column:
        return F.when(broken, name)

    rules = F.array_compact(
        F.array(
            rule(F.col("n_fields") != 5, "field_count"),
            rule((F.col("n_fields") == 5) & ~F.col("numeric"), "not_numeric"),
            rule((F.col("n_fields") == 5) & F.col("numeric") & ~counted, "not_finite"),
            rule(counted & (F.col("class_id") != 0), "class_not_zero"),
            rule(counted & ~unit, "center_outside"),
            rule(counted & ~sized, "size_outside"),
            rule(counted & outside, "box_outside_image"),
        )
    )
    own = {"n_fields", "class_id", *_FIELDS, "numeric", "counted"}
    keep = [c for c in lines.columns if c not in own]
    return lines.select(*keep, F.explode(rules).alias("rule"))


def parse_labels(files: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(boxes, issues)``: the lines that count as objects, and every broken rule."""
    lines = label_lines(files, text_col)
    boxes = lines.filter("counted").drop("n_fields", "numeric", "counted")
    return boxes, label_issues(lines)


def strict_boxes(lines: DataFrame) -> DataFrame:
    """Corner boxes with the first problem under the strict rules of evaluation (no slack)."""
    corners = center_to_corners(*[F.col(c) for c in _FIELDS])
    cornered = lines.withColumns(dict(zip(("x1", "y1", "x2", "y2"), corners)))
    problem = (
        F.when(F.col("n_fields") != 5, "field_count")
        .when(~F.col("numeric"), "not_numeric")
        .otherwise(box_problem(*[F.col(c) for c in ("x1", "y1", "x2", "y2", "class_id")], None))
    )
    return cornered.withColumn("problem", problem).drop(
        "n_fields", "numeric", "counted", *_FIELDS
    )


def ground_truth(
    images: DataFrame, files: DataFrame, split: str, text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``(image_id, gt_idx, x1, y1, x2, y2, class_id, problem)`` of a split from its label files.

    ``gt_idx`` counts an image's lines from 0. A line that breaks a strict rule keeps its row and
    says so in ``problem``; an image of the split without a label file has one row, ``missing_label``,
    and one with an empty file none.
    """
    wanted = images.filter(F.col("split") == split).groupBy("image_id").agg(F.count("*").alias("_images"))
    # One join says which images have a file and which have none, and deals lines out by image for their numbers.
    texts = files.select("image_id", text_col, F.lit(True).alias("_file"))
    joined = wanted.join(texts, "image_id", "left")
    boxes = strict_boxes(label_lines(joined.filter("_file").select("image_id", text_col), text_col))
    corners = ("x1", "y1", "x2", "y2")
    # Two files of one image repeat line numbers; what the lines say orders those.
    order = [F.asc(c) for c in ("line_number", *corners, "class_id", "problem")]
    # Ends of lines say which images may have very many, so lines need not be parsed to find those.
    text = F.col(text_col)
    ends = F.coalesce(F.length(text) - F.length(F.translate(text, "\n\r", "")) + 1, F.lit(0)).cast("bigint")
    numbered = grouped_row_number(
        boxes, ["image_id"], order, [F.floor(F.col("line_number") / 65536)], "_n", hot_rows, files.select("image_id", ends.alias("_rows"))
    )
    rows = numbered.select(
        "image_id", (F.col("_n") - 1).cast("int").alias("gt_idx"), *corners, "class_id", "problem"
    )
    each = F.explode(F.array_repeat(F.lit("missing_label"), F.col("_images").cast("int")))
    lost = joined.filter("_file is null").select("image_id", each.alias("problem")).select(
        "image_id",
        F.lit(None).cast("int").alias("gt_idx"),
        *[F.lit(None).cast("double").alias(c) for c in corners],
        F.lit(None).cast("int").alias("class_id"),
        "problem",
    )
    return rows.unionByName(lost)


def evaluation_images(images: DataFrame, boxes: DataFrame, split: str) -> DataFrame:
    """Box count per image of one split, images without boxes included."""
    counts = boxes.groupBy("image_id").agg(F.count("*").alias("n_boxes"))
    wanted = images.filter(F.col("split") == split).select("image_id")
    return wanted.join(counts, "image_id", "left").withColumn(
        "n_boxes", F.coalesce("n_boxes", F.lit(0))
    )


def inventory_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Four typed fields of a comma-separated device inventory line, and what is wrong with it."""
    parts = F.transform(F.split(line_col, ","), strip)
    typed = lines.withColumn("_p", parts).select(
        *lines.columns,
        F.size("_p").alias("n_fields"),
        F.try_element_at("_p", F.lit(1)).try_cast("int").alias("device_index"),
        F.try_element_at("_p", F.lit(2)).alias("device_name"),
        F.try_element_at("_p", F.lit(3)).try_cast("int").alias("memory_mib"),
        F.try_element_at("_p", F.lit(4)).alias("driver_version"),
    )
    wrong = F.col("device_index").isNull() | F.col("memory_mib").isNull()
    problem = F.when(F.col("n_fields") != 4, "field_count").when(wrong, "not_numeric")
    return typed.withColumn("problem", problem).drop("n_fields")
