"""JSON documents whose root must be an object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_json(documents: DataFrame, json_col: str, schema: str, out: str = "doc") -> DataFrame:
    """Add the parsed struct and ``problem``: ``unreadable`` or ``not_an_object``.

    The schema should name a ``_corrupt_record`` column, which tells broken text from missing keys.
    """
    text = F.trim(F.col(json_col))
    doc = F.from_json(
        F.col(json_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )
    parsed = documents.withColumn(out, doc)
    problem = (
        F.when(text.isNull(), "unreadable")
        .when(text.rlike(r'^(\[|"|-?[0-9]|true|false|null)'), "not_an_object")
        .when(F.col(f"{out}._corrupt_record").isNotNull(), "unreadable")
    )
    return parsed.withColumn("problem", problem)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per JSON file, parsed against ``schema``."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .load(path)
        .select("path", F.col("content").cast("string").alias("json"))
    )
    return parse_json(files, "json", schema)


def required(doc: Column, *names: str) -> Column:
    """First of the named fields that is missing, or null."""
    result = F.when(doc[names[0]].isNull(), names[0])
    for name in names[1:]:
        result = result.when(doc[name].isNull(), name)
    return result
