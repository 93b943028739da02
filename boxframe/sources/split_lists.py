"""Split lists: one image ID per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.functions.text import normalize_id, strip


def clean_split_list(lines: DataFrame, line_col: str = "value", *keep: str) -> DataFrame:
    """``(..., image_id, problem)`` of non-blank lines; a byte-order mark is dropped.

    An entry that is no valid ID keeps its row with a null ``image_id`` and a ``problem``.
    """
    text = F.regexp_replace(F.col(line_col), "^﻿", "")
    return (
        lines.withColumn("_text", text)
        .filter(strip(F.col("_text")) != "")
        .select(*keep, normalize_id(F.col("_text")).alias("image_id"))
        .withColumn("problem", F.when(F.col("image_id").isNull(), "invalid_id"))
    )


def read_split_list(spark: SparkSession, path: str) -> DataFrame:
    return clean_split_list(spark.read.text(path))


def duplicate_ids(ids: DataFrame, *keys: str) -> DataFrame:
    """IDs that occur more than once, with their number of occurrences."""
    by = [*keys, "image_id"]
    return ids.groupBy(*by).agg(F.count("*").alias("n")).filter("n > 1")


def unique_ids(ids: DataFrame, *keys: str) -> DataFrame:
    return ids.select(*keys, "image_id").filter("image_id is not null").distinct()
