"""Operators over file paths: image index, dataset roots, duplicate stems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.functions.text import extension_of, file_name, stem_of
from boxframe.schemas import IMAGE_EXTENSIONS


def image_index(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """``(stem_key, n_paths, first_path, last_path)`` per case-insensitive stem of image files.

    The paths are aggregated, not collected: a stem that occurs once has its path in ``first_path``.
    """
    path = F.col(path_col)
    return (
        paths.filter(extension_of(path).isin(*IMAGE_EXTENSIONS))
        .groupBy(F.lower(stem_of(path)).alias("stem_key"))
        .agg(
            F.count("*").alias("n_paths"),
            F.min(path).alias("first_path"),
            F.max(path).alias("last_path"),
        )
    )


def resolve_images(annotations: DataFrame, paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Find the one image of every ``(image_id, filename)``.

    The declared file name wins when a file has exactly that name. Otherwise the declared stem and
    the image ID are looked up without regard to case and must lead to exactly one path. Adds
    ``image_path`` and ``n_found``; ``image_path`` is null unless exactly one was found.
    """
    path = F.col(path_col)
    images = paths.filter(extension_of(path).isin(*IMAGE_EXTENSIONS))
    exact = paths.groupBy(file_name(path).alias("_name")).agg(F.min(path).alias("_exact"))
    index = image_index(images, path_col).select("stem_key", "n_paths", "first_path")

    def lookup(tag: str) -> DataFrame:
        return index.toDF(f"_key_{tag}", f"_n_{tag}", f"_path_{tag}")

    by_id = F.lower(F.col("image_id").cast("string"))
    name = F.nullif(file_name(F.col("filename")), F.lit(""))
    by_name = F.lower(stem_of(name))
    keyed = annotations.withColumns({"_name": name, "_key_id": by_id}).withColumn(
        # A second look-up only where it asks for something else.
        "_key_name", F.when(by_name != by_id, by_name)
    )
    found = (
        keyed.join(exact, "_name", "left")
        .join(lookup("id"), "_key_id", "left")
        .join(lookup("name"), "_key_name", "left")
    )
    total = F.coalesce("_n_id", F.lit(0)) + F.coalesce("_n_name", F.lit(0))
    n_found = F.when(F.col("_exact").isNotNull(), 1).otherwise(total).cast("bigint")
    single = F.coalesce("_exact", F.when(total == 1, F.coalesce("_path_name", "_path_id")))
    return found.select(
        *annotations.columns, single.alias("image_path"), n_found.alias("n_found")
    )


def discover_roots(
    paths: DataFrame,
    path_col: str = "path",
    trainval: str = "ImageSets/Main/trainval.txt",
    test: str = "ImageSets/Main/test.txt",
) -> DataFrame:
    """Candidate dataset roots with ``has_split_files`` and ``chosen``.

    A root holds ``Annotations``, ``JPEGImages`` and ``ImageSets/Main``. It is chosen when it is the
    only one, or the only one that has both split files; no chosen row means none or several.
    """
    path = F.col(path_col)
    parts = r"^(.*?)/?((?:Annotations|JPEGImages|ImageSets/Main)/.*)$"
    rooted = paths.select(
        F.regexp_extract(path, parts, 1).alias("root"),
        F.regexp_extract(path, parts, 2).alias("inner"),
    ).filter("inner <> ''")

    def has(condition: Column) -> Column:
        return F.bool_or(condition)

    inner = F.col("inner")
    candidates = (
        rooted.groupBy("root")
        .agg(
            has(inner.startswith("Annotations/")).alias("a"),
            has(inner.startswith("JPEGImages/")).alias("j"),
            has(inner.startswith("ImageSets/Main/")).alias("m"),
            (has(inner == trainval) & has(inner == test)).alias("has_split_files"),
        )
        .filter("a and j and m")
        .select("root", "has_split_files")
    )
    totals = candidates.agg(
        F.count("*").alias("n"), F.count_if("has_split_files").alias("n_split")
    )
    n, n_split = totals.select("n").scalar(), totals.select("n_split").scalar()
    return candidates.withColumn(
        "chosen", (n == 1) | ((n_split == 1) & F.col("has_split_files"))
    )


def duplicate_stems(files: DataFrame, path_col: str = "path", by: str = "split") -> DataFrame:
    """``(split, stem_key, n_files, exact_duplicate)`` of stems that occur more than once.

    Stems are compared without regard to case; ``exact_duplicate`` says whether some spelling
    occurs twice, which is the case-sensitive rule.
    """
    stem = stem_of(F.col(path_col))
    per_stem = files.groupBy(by, stem.alias("stem")).agg(F.count("*").alias("n"))
    return (
        per_stem.groupBy(by, F.lower("stem").alias("stem_key"))
        .agg(F.sum("n").alias("n_files"), F.bool_or(F.col("n") > 1).alias("exact_duplicate"))
        .filter("n_files > 1")
    )
