"""Combining sources into one dataset; images are referenced by path, not copied."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.schemas import SPLITS

_PREFIX = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]*")


def check_prefixes(prefixes: list[str]) -> None:
    for prefix in prefixes:
        if _PREFIX.fullmatch(prefix) is None:
            raise ValueError(f"unsafe source prefix: {prefix!r}")
    if len({p.lower() for p in prefixes}) != len(prefixes):
        raise ValueError("source prefixes must be distinct")


def combine_sources(sources: dict[str, DataFrame], prefixes: dict[str, str]) -> DataFrame:
    """Union of sources with ``prefix__id`` IDs; every item keeps the split of its source."""
    check_prefixes([prefixes[name] for name in sources])
    combined = None
    for name, items in sources.items():
        new_id = F.concat(F.lit(f"{prefixes[name]}__"), F.col("image_id").cast("string"))
        part = items.select(
            F.lit(name).alias("source"),
            new_id.alias("image_id"),
            *[c for c in items.columns if c not in ("image_id", "source")],
        )
        combined = part if combined is None else combined.unionByName(part)
    return combined


def common_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("image_id").intersect(right.select("image_id"))


def missing_ids(expected: DataFrame, present: DataFrame) -> DataFrame:
    return expected.select("image_id").subtract(present.select("image_id"))


def source_issues(images: DataFrame, labels: DataFrame, line_issues: DataFrame, sources: list[str]) -> DataFrame:
    """``(severity, rule, source, split, image_id, line_number)``: what forbids combining these sources.

    ``images`` and ``labels`` are ``(source, split, image_id)``, ``line_issues`` has ``line_number`` and ``rule``
    besides. Rules: ``missing_label``, ``orphan_label``, ``repeated_id`` (an ID that, without regard to case, a
    source holds more than once: each of its items but the first, in the order train, val, test and then by ID, and
    an item with several images), ``unknown_split``, ``empty_split`` and those of label lines. Images and labels
    meet in one aggregate by source, split and ID; an ID's entry is then as long as there are splits and ways to
    write it. A null source, split or ID is a value like any other.
    """
    known = F.array(*[F.lit(s) for s in SPLITS])

    def tagged(df: DataFrame, image: int) -> DataFrame:
        return df.select("source", "split", F.col("image_id").cast("string").alias("image_id"), F.lit(image).alias("image"))

    each = (
        tagged(images, 1)
        .unionByName(tagged(labels, 0))
        .groupBy("source", "split", "image_id")
        .agg(F.sum("image").alias("images"), F.count_if(F.col("image") == 0).alias("labels"))
    )
    place = F.coalesce(F.array_position(known, F.col("split")), F.lit(0))
    item = F.struct(place.alias("place"), "image_id", "split", "images", "labels")
    held = each.groupBy("source", F.lower("image_id").alias("key")).agg(F.array_sort(F.collect_list(item)).alias("held"))

    def named(name: str, items: Column) -> Column:
        return F.transform(items, lambda h: F.struct(F.lit(name).alias("rule"), h["split"].alias("split"), h["image_id"].alias("image_id")))

    with_image = F.filter("held", lambda h: h["images"] > 0)
    later = F.filter(with_image, lambda h, k: (k > 0) | (h["images"] > 1))
    rules = F.concat(
        named("missing_label", F.filter(with_image, lambda h: h["labels"] == 0)),
        named("orphan_label", F.filter("held", lambda h: h["images"] == 0)),
        named("repeated_id", later),
        named("unknown_split", F.filter("held", lambda h: h["place"] == 0)),
    )
    nothing = F.lit(None).cast("int").alias("line_number")
    keyed = held.select("source", F.inline(rules)).select("rule", "source", "split", "image_id", nothing)
    # A row for each source and split that should be there: as many as there are names.
    wanted = images.sparkSession.createDataFrame([(n, s) for n in sources for s in SPLITS], "source string, split string")
    empty = wanted.join(each.filter("images > 0").select("source", "split").distinct(), ["source", "split"], "left_anti")
    lacking = empty.select(F.lit("empty_split").alias("rule"), "source", "split", F.lit(None).cast("string").alias("image_id"), nothing)
    lines = line_issues.select("rule", "source", "split", F.col("image_id").cast("string").alias("image_id"), F.col("line_number").cast("int").alias("line_number"))
    return keyed.unionByName(lacking).unionByName(lines).select(F.lit("error").alias("severity"), "*")
