"""Annotation XML: one document per row, typed objects and rejects as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.functions.boxes import all_finite
from boxframe.functions.text import stem_of, strip
from boxframe.schemas import VOC_XML

# Fixed value: larger documents are refused.
MAX_XML_BYTES = 10 * 1024 * 1024
_SIDES = ("xmin", "ymin", "xmax", "ymax")
_FLAGS = ("difficult", "truncated")
_DIMENSIONS = ("width", "height", "depth")


def _bare(value: Column) -> Column:
    """``strip``, which looks at each end for 30 characters, only where a text is not all visible ASCII."""
    return F.when(value.rlike(r"\A[!-~]*\z"), value).otherwise(strip(value))


def _full(bare: Column) -> Column:
    return F.nullif(bare, F.lit(""))


def _bare_object(obj: Column) -> Column:
    """Texts of one object without white space around them."""
    box = obj["bndbox"]
    return F.struct(
        _bare(obj["name"]).alias("class_name"),
        box.isNull().alias("no_box"),
        *[_bare(box[side]).alias(side) for side in _SIDES],
        *[_bare(obj[flag]).alias(flag) for flag in _FLAGS],
    )


def _typed_object(bare: Column) -> Column:
    """Texts and numbers of one object, still unchecked."""
    sides = [
        part
        for side in _SIDES
        for part in (
            _full(bare[side]).isNull().alias(f"no_{side}"),
            bare[side].try_cast("double").alias(side),
        )
    ]
    flags = [
        part
        for flag in _FLAGS
        for part in (
            _full(bare[flag]).isNotNull().alias(f"has_{flag}"),
            bare[flag].try_cast("int").alias(flag),
        )
    ]
    return F.struct(_full(bare["class_name"]).alias("class_name"), bare["no_box"].alias("no_box"), *sides, *flags)


def _object_problem(o: Column) -> Column:
    missing, wrong = F.lit(False), F.lit(False)
    for side in _SIDES:
        missing = missing | o[f"no_{side}"]
        wrong = wrong | o[side].isNull()
    return (
        F.when(o["class_name"].isNull(), "missing_name")
        .when(o["no_box"], "missing_bndbox")
        .when(missing, "missing_coordinate")
        .when(wrong, "invalid_coordinate")
        .when(~all_finite([o[s] for s in _SIDES]), "not_finite_coordinate")
        .when(o["has_difficult"] & o["difficult"].isNull(), "invalid_difficult")
        .when(o["has_truncated"] & o["truncated"].isNull(), "invalid_truncated")
    )


def parse_voc(
    documents: DataFrame, id_col: str = "image_id", xml_col: str = "xml", *keep: str, max_bytes: int = MAX_XML_BYTES
) -> DataFrame:
    """Add ``filename, width, height, depth, objects, reject_reason`` to one document per row.

    A document is refused as a whole with the first problem found; its other columns are then null.
    One of more than ``max_bytes`` is ``too_large``.
    ``objects`` is an array in document order, empty where the document names none.
    """
    xml = F.col(xml_col)
    # Upper case is only looked at where there is any declaration or comment.
    upper = F.upper(xml)
    unsafe = xml.contains("<!") & (upper.contains("<!DOCTYPE") | upper.contains("<!ENTITY"))
    too_big = F.octet_length(xml) > max_bytes
    # The parser only sees documents that are small and free of declarations.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    document = F.from_xml(F.when(~F.col("_unsafe") & ~F.col("_too_big"), xml), VOC_XML, options)
    # A generator keeps later filters from copying the parser into their conditions.
    parsed = documents.withColumns({"_unsafe": unsafe, "_too_big": too_big}).select(
        "*", F.explode(F.array(document)).alias("_doc")
    )
    doc = F.col("_doc")
    none = F.array().cast(f"array<{_object_kind()}>")
    size = doc["size"]
    # Each step is its own projection, so a value is worked out once and then referred to.
    bare = parsed.select(
        id_col,
        *keep,
        "_unsafe",
        "_too_big",
        (F.col(xml_col).isNull() | doc.isNull() | doc["_corrupt_record"].isNotNull()).alias("_bad"),
        size.isNull().alias("_no_size"),
        _bare(doc["filename"]).alias("_filename"),
        *[_bare(size[name]).alias(f"_{name}") for name in _DIMENSIONS],
        F.transform(F.coalesce(doc["object"], none), _bare_object).alias("_objects"),
    )
    texts = bare.select(
        id_col,
        *keep,
        "_unsafe",
        "_too_big",
        "_bad",
        "_no_size",
        _full(F.col("_filename")).alias("_filename"),
        *[
            part
            for name in _DIMENSIONS
            for part in (
                _full(F.col(f"_{name}")).alias(f"_{name}_text"),
                F.col(f"_{name}").try_cast("int").alias(f"_{name}"),
            )
        ],
        F.transform("_objects", _typed_object).alias("_objects"),
    )
    width, height = F.col("_width"), F.col("_height")
    problems = F.filter(F.transform("_objects", _object_problem), lambda p: p.isNotNull())
    reason = (
        F.when(F.col("_too_big"), "too_large")
        .when(F.col("_unsafe"), "declaration_not_allowed")
        .when(F.col("_bad"), "invalid_xml")
        .when(F.col("_filename").isNull(), "missing_filename")
        .when(F.col("_no_size"), "missing_size")
        .when(
            F.col("_width_text").isNull() | F.col("_height_text").isNull(), "missing_dimension"
        )
        .when(width.isNull() | height.isNull(), "invalid_dimension")
        .when((width <= 0) | (height <= 0), "non_positive_dimension")
        .when(F.col("_depth_text").isNotNull() & F.col("_depth").isNull(), "invalid_depth")
        .otherwise(F.try_element_at(problems, F.lit(1)))
    )
    final = F.transform(
        "_objects",
        lambda o: F.struct(
            *[o[c].alias(c) for c in ("class_name", *_SIDES)],
            *[(F.coalesce(o[c], F.lit(0)) != 0).alias(c) for c in _FLAGS],
        ),
    )
    good = F.col("reject_reason").isNull()
    return texts.withColumn("reject_reason", reason).select(
        id_col,
        *keep,
        *[F.when(good, F.col(f"_{c}")).alias(c) for c in ("filename", *_DIMENSIONS)],
        F.when(good, final).alias("objects"),
        "reject_reason",
    )


def _object_kind() -> str:
    return VOC_XML.split("object array<", 1)[1].rsplit(">,", 1)[0]


def voc_objects(annotations: DataFrame, id_col: str = "image_id") -> DataFrame:
    """One row per object with its 0-based place in the document."""
    # The outer form: filters before it, asked for or inferred, would check every document once more.
    return (
        annotations.select(
            id_col,
            "width",
            "height",
            F.posexplode_outer(F.when(F.col("reject_reason").isNull(), F.col("objects"))).alias("obj_idx", "o"),
        )
        .filter("obj_idx is not null")
        .select(id_col, "obj_idx", "width", "height", "o.*")
    )


def read_voc(spark: SparkSession, path: str, max_bytes: int = MAX_XML_BYTES) -> DataFrame:
    """Parse every ``*.xml`` below a folder; files of more than ``max_bytes`` are never read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xml")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    small = files.filter(F.col("length") <= max_bytes).select(
        stem_of(F.col("path")).alias("image_id"),
        F.col("path").alias("xml_path"),
        F.col("content").cast("string").alias("xml"),
    )
    large = files.filter(F.col("length") > max_bytes).select(
        stem_of(F.col("path")).alias("image_id"), F.col("path").alias("xml_path")
    )
    parsed = parse_voc(small, "image_id", "xml", "xml_path", max_bytes=max_bytes)
    refused = large.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in parsed.schema[2:-1]}
    ).withColumn("reject_reason", F.lit("too_large"))
    return parsed.unionByName(refused)
