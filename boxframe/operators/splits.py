"""Deterministic disjoint splits with exact counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.functions.text import bounded_count
from boxframe.operators.ranking import label_by_hash_rank
from boxframe.schemas import SPLITS
from boxframe.sources.split_lists import unique_ids

# Shares of the fallback split and names of the two strategies.
FALLBACK_TEST_SHARE = 0.15
FALLBACK_VAL_SHARE = 0.15 / 0.85
STRATEGY_OFFICIAL = "official_test_trainval_80_20"
STRATEGY_FALLBACK = "fallback_70_15_15"


def split_names(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{s}')" for s in SPLITS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS names(split)")


def apply_test_precedence(trainval: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train/validation IDs without the test members, and the IDs removed for that reason."""
    return (
        trainval.join(test, "image_id", "left_anti"),
        trainval.join(test, "image_id", "left_semi"),
    )


def assign_splits(
    trainval: DataFrame, test: DataFrame, val_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """``(image_id, split)`` from official lists.

    The test list is kept as it is. Of the other IDs an exact, seeded share becomes ``val``. The
    order comes from a hash of seed and ID, so it does not depend on row order or partitioning.
    """
    if not 0.0 < val_fraction < 1.0:
        raise ValueError("val_fraction must be between zero and one")
    held_out = unique_ids(test)
    free, _ = apply_test_precedence(unique_ids(trainval), held_out)
    labelled = label_by_hash_rank(
        free,
        "image_id",
        seed,
        [("val", bounded_count(F.col("total"), val_fraction))],
        "train",
        "split",
        minimum=2,
    )
    return labelled.unionByName(held_out.withColumn("split", F.lit("test")))


def assign_fallback_splits(ids: DataFrame, seed: int = 42) -> DataFrame:
    """``(image_id, split)`` in shares of 70/15/15 where there are no official lists."""
    total = F.col("total")
    n_test = bounded_count(total, FALLBACK_TEST_SHARE)
    return label_by_hash_rank(
        unique_ids(ids),
        "image_id",
        seed,
        [("test", n_test), ("val", bounded_count(total - n_test, FALLBACK_VAL_SHARE))],
        "train",
        "split",
        minimum=3,
    )


def replay_splits(ids: DataFrame, membership: DataFrame) -> DataFrame:
    """Use a stored ``(image_id, split)`` membership instead of drawing one."""
    return unique_ids(ids).join(membership.select("image_id", "split"), "image_id")


def split_warnings(trainval: DataFrame, test: DataFrame) -> DataFrame:
    """``(rule, list, image_id)`` for repeated entries and for entries on both lists."""
    entries = trainval.select("image_id", F.lit("trainval").alias("list")).unionByName(
        test.select("image_id", F.lit("test").alias("list"))
    ).filter("image_id is not null")
    # One pass: entries per list and ID show both kinds of warning.
    counted = entries.groupBy("image_id").agg(
        F.count_if(F.col("list") == "trainval").alias("trainval"),
        F.count_if(F.col("list") == "test").alias("test"),
    )

    def warning(rule: str, name: str) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("list"))

    n_trainval, n_test = F.col("trainval"), F.col("test")
    found = F.array_compact(
        F.array(
            F.when(n_trainval > 1, warning("duplicate", "trainval")),
            F.when(n_test > 1, warning("duplicate", "test")),
            F.when((n_trainval > 0) & (n_test > 0), warning("overlap", "trainval")),
        )
    )
    return counted.select(F.inline(found), "image_id")


def split_overlap(members: DataFrame) -> DataFrame:
    """``(split_a, split_b, image_id)`` of IDs in more than one split. No self-join.

    The set per ID is bounded by the number of splits.
    """
    held = members.groupBy("image_id").agg(F.sort_array(F.collect_set("split")).alias("s"))
    pairs = F.flatten(
        F.transform(
            F.col("s"),
            lambda a: F.transform(
                F.filter(F.col("s"), lambda b: b > a),
                lambda b: F.struct(a.alias("split_a"), b.alias("split_b")),
            ),
        )
    )
    return held.filter(F.size("s") > 1).select(F.inline(pairs), "image_id")


def split_integrity(members: DataFrame, annotations: DataFrame, images: DataFrame) -> DataFrame:
    """``(rule, split, image_id)`` of members without annotation or without exactly one image.

    ``images`` is an image index (``stem_key, n_paths``). An empty split is a row without an ID.
    """
    noted = annotations.select("image_id", F.lit(True).alias("_noted")).distinct()
    index = images.select(F.col("stem_key").alias("_key"), "n_paths")
    looked_up = (
        members.withColumn("_key", F.lower(F.col("image_id").cast("string")))
        .join(noted, "image_id", "left")
        .join(index, "_key", "left")
    )
    rule = (
        F.when(F.col("_noted").isNull(), "missing_annotation")
        .when(F.col("n_paths").isNull(), "missing_image")
        .when(F.col("n_paths") > 1, "ambiguous_image")
    )
    problems = looked_up.select(rule.alias("rule"), "split", "image_id").filter("rule is not null")
    empty = split_names(members.sparkSession).join(
        members.select("split").distinct(), "split", "left_anti"
    )
    id_type = members.schema["image_id"].dataType
    return problems.unionByName(
        empty.select(
            F.lit("empty_split").alias("rule"), "split", F.lit(None).cast(id_type).alias("image_id")
        )
    )


def included_splits(members: DataFrame, included: DataFrame) -> DataFrame:
    return members.join(included, "image_id", "left_semi")

