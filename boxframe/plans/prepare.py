"""From annotation files to a checked, published dataset version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.operators.checkpoints import cut_lineage
from boxframe.operators.fingerprint import DIGEST_RULE, LEAF_DIGITS, dataset_fingerprint, split_hash
from boxframe.operators.profile import (
    area_buckets,
    category_counts,
    check_dimensions,
    label_text,
    normalize_boxes,
    remap_classes,
    repair_counts,
    split_stats,
)
from boxframe.operators.quality import assert_valid, issue_rows
from boxframe.operators.quantiles import distribution
from boxframe.operators.splits import (
    STRATEGY_FALLBACK,
    STRATEGY_OFFICIAL,
    assign_fallback_splits,
    assign_splits,
    split_integrity,
    split_warnings,
)
from boxframe.schemas import SPLITS
from boxframe.sinks.files import manifest_json, publish
from boxframe.sources.images import image_meta, read_images
from boxframe.sources.listing import image_index, resolve_images
from boxframe.sources.split_lists import read_split_list
from boxframe.sources.voc import read_voc, voc_objects

# Conversion options that enter the fingerprint.
OPTIONS: dict[str, object] = {
    "clip_boxes": True,
    "image_transfer_mode": "copy",
    "keep_empty_images": True,
    "reject_degenerate_boxes": True,
    "target_class_id": 0,
    "target_class_name": "object",
    "verify_image_dimensions": True,
}


def checked_options(options: dict[str, object] | None, verify_dimensions: bool) -> dict[str, object]:
    """All conversion options. Only clipping and the check of dimensions can be switched."""
    merged = {**OPTIONS, **(options or {}), "verify_image_dimensions": verify_dimensions}
    if unknown := sorted(set(merged) - set(OPTIONS)):
        raise ValueError(f"unknown conversion options: {', '.join(unknown)}")
    fixed = [k for k in OPTIONS if k not in ("clip_boxes", "verify_image_dimensions", "target_class_name")]
    for name in fixed:
        if merged[name] != OPTIONS[name]:
            raise ValueError(f"{name}={merged[name]!r} is not supported")
    return merged


@dataclass(frozen=True)
class Prepared:
    """Tables of a dataset version, derived from parsed annotations, image sizes and the split."""

    images: DataFrame
    objects: DataFrame
    boxes: DataFrame
    rejects: DataFrame
    issues: DataFrame
    #: In the layout of ``issues``; they don't keep a version from being published.
    warnings: DataFrame
    fingerprint: DataFrame
    manifest: DataFrame


def prepare(
    spark: SparkSession,
    root: str,
    source_sha: str,
    val_fraction: float = 0.2,
    seed: int = 42,
    membership: DataFrame | None = None,
    official: bool = True,
    verify_dimensions: bool = True,
    options: dict[str, object] | None = None,
) -> Prepared:
    """Read one dataset root and build its tables.

    ``membership`` (``image_id, split``) replays a stored split; otherwise the official lists, or
    the fallback shares with ``official=False``, decide. ``options`` replace entries of ``OPTIONS``;
    what they say is what is done, and a value that isn't supported is an error. Repeated and
    overlapping entries of the official lists are ``warnings``.
    """
    options = checked_options(options, verify_dimensions)
    warnings = None
    annotations = read_voc(spark, f"{root}/Annotations")
    files = read_images(spark, f"{root}/JPEGImages")
    if membership is not None:
        members = membership.select("image_id", "split")
    elif official:
        lists = f"{root}/ImageSets/Main"
        trainval, test = (read_split_list(spark, f"{lists}/{n}.txt") for n in ("trainval", "test"))
        members = assign_splits(trainval, test, val_fraction, seed)
        warnings = split_warnings(trainval, test).withColumnRenamed("list", "split")
    else:
        members = assign_fallback_splits(annotations.select("image_id"), seed)
    # Every file is read and parsed once; the tables below start from these results.
    members = cut_lineage(members)
    annotations = cut_lineage(annotations)
    measured = cut_lineage(image_meta(files.select("path", "content")))
    paths = measured.select("path")
    noted = annotations.join(members, "image_id")
    resolved = resolve_images(
        noted.select("image_id", "split", "filename", "width", "height", "reject_reason"), paths
    )
    sized = resolved.withColumnsRenamed({"width": "xml_width", "height": "xml_height"}).join(
        measured.withColumnRenamed("path", "image_path"), "image_path", "left"
    )
    # One row per image, which most tables below start from.
    images = cut_lineage(check_dimensions(sized, verify=verify_dimensions).drop("filename"))
    objects = voc_objects(noted).drop("width", "height")
    placed = objects.join(images.select("image_id", "split", "width", "height"), "image_id")
    normalized = normalize_boxes(placed, bool(options["clip_boxes"]))
    boxes = remap_classes(normalized.filter("reject_reason is null"))
    rejects = normalized.filter("reject_reason is not null").select(
        "split", "image_id", "obj_idx", "class_name", "reject_reason"
    )
    issues = (
        issue_rows(split_integrity(members, annotations, image_index(paths)), "error")
        .unionByName(
            issue_rows(
                images.filter("reject_reason is not null").withColumnRenamed("reject_reason", "rule"),
                "error",
            )
        )
        .unionByName(issue_rows(images.filter("n_found <> 1"), "error", "image_not_found"))
        .unionByName(issue_rows(images.filter("error is not null"), "error", "unreadable_image"))
    )
    hashes = cut_lineage(split_hash(members))
    fingerprint = dataset_fingerprint(hashes, source_sha, options)
    if membership is not None:
        strategy = "replayed"
    else:
        strategy = STRATEGY_OFFICIAL if official else STRATEGY_FALLBACK
    manifest = dataset_manifest(hashes, fingerprint, source_sha, options, strategy, seed)
    return Prepared(
        images.drop("n_found", "error", "reject_reason"),
        normalized,
        boxes,
        rejects,
        issues,
        issues.limit(0) if warnings is None else issue_rows(warnings, "warning"),
        fingerprint,
        manifest,
    )


def dataset_manifest(
    hashes: DataFrame,
    fingerprint: DataFrame,
    source_sha: str,
    options: dict[str, object],
    strategy: str,
    seed: int,
) -> DataFrame:
    """One row ``(manifest)``: canonical JSON on a dataset version.

    Split members are a table of the version, so the manifest holds their counts and digests only.
    """

    def per_split(value: Column) -> Column:
        parts = [F.max(F.when(F.col("split") == s, value)).alias(s) for s in sorted(SPLITS)]
        return F.struct(*parts)

    one = hashes.agg(
        per_split(F.col("n")).alias("counts"),
        per_split(F.struct(F.col("n").alias("count"), F.col("digest").alias("sha256"))).alias("files"),
    )
    fields = {
        "conversion": F.struct(*[F.lit(options[k]).alias(k) for k in sorted(options)]),
        "counts": F.col("counts"),
        "dataset_fingerprint": fingerprint.scalar(),
        "digest_rule": F.struct(F.lit(LEAF_DIGITS).alias("leaf_digits"), F.lit(DIGEST_RULE).alias("name")),
        "schema_version": F.lit("1.0"),
        "source_archive_sha256": F.lit(source_sha),
        "split_configuration": F.struct(F.lit(seed).alias("seed")),
        "split_files": F.col("files"),
        "split_strategy": F.lit(strategy),
    }
    return one.select(manifest_json(fields).alias("manifest"))


def statistics(prepared: Prepared) -> dict[str, DataFrame]:
    """The profile tables of a prepared dataset."""
    boxes = prepared.boxes.withColumn("area", F.col("box_width") * F.col("box_height"))
    return {
        "splits": split_stats(prepared.images, prepared.boxes),
        "original_categories": category_counts(prepared.objects),
        "repairs": repair_counts(prepared.images, prepared.objects),
        "area_buckets": area_buckets(prepared.boxes),
        "box_area": distribution(boxes, ["area"]),
        "image_size": distribution(prepared.images, ["width", "height"]),
    }


def publish_prepared(prepared: Prepared, root: str, force: bool = False) -> tuple[str, dict[str, str]]:
    """Check once, then publish under the fingerprint; a version already there is reused."""
    assert_valid(prepared.issues)
    fingerprint = prepared.fingerprint.head()[0]
    labels = label_text(prepared.images, prepared.boxes).join(
        prepared.images.select("image_id", "split"), "image_id"
    )
    tables = {
        "images": prepared.images,
        "boxes": prepared.boxes,
        "rejects": prepared.rejects,
        "labels": labels,
        "splits": prepared.images.select("split", "image_id"),
        "manifest": prepared.manifest,
    }
    return fingerprint, publish(tables, root, fingerprint, force)
