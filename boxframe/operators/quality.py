"""Dataset checks. Every check returns rows; only ``assert_valid`` raises."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.operators.checkpoints import cut_lineage
from boxframe.schemas import SPLITS
from boxframe.sources.listing import duplicate_stems


class DatasetProblems(ValueError):
    """A strict check found errors; ``issues`` is the complete report."""

    def __init__(self, n_errors: int, issues: DataFrame) -> None:
        super().__init__(f"dataset check failed with {n_errors} error(s)")
        self.issues = issues


def pairing(images: DataFrame, labels: DataFrame, keys: Sequence[str] = ("split", "image_id")) -> DataFrame:
    """Images without a label and labels without an image, from one outer join."""
    left = images.select(*keys).distinct().withColumn("_image", F.lit(True))
    right = labels.select(*keys).distinct().withColumn("_label", F.lit(True))
    rule = F.when(F.col("_label").isNull(), "missing_label").when(
        F.col("_image").isNull(), "orphan_label"
    )
    joined = left.join(right, list(keys), "full_outer").select(rule.alias("rule"), *keys)
    return joined.filter("rule is not null")


def content_leak(items: DataFrame, hash_col: str = "digest") -> DataFrame:
    """``(split, image_id, kept_split, kept_id)`` of content held by an earlier split.

    Splits count in the order train, val, test. The first split that holds a digest keeps it, with
    its last image ID. A row of another split, or of none, is an error. Built from two aggregates, so many copies of one content never meet in a
    window: per digest and split first, then per digest. The digests are written down first, so that
    the contents behind them are read and hashed once.
    """
    items = cut_lineage(items.select("split", "image_id", hash_col))
    place = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("split")).cast("int")
    unknown = F.raise_error(F.concat(F.lit("no such split: "), F.coalesce("split", F.lit("null")))).cast("int")
    ranked = items.withColumn("_order", F.when(place > 0, place).otherwise(unknown))
    kept = ranked.groupBy(hash_col, "_order", "split").agg(F.max("image_id").alias("last_id"))
    first = kept.groupBy(hash_col).agg(
        F.min(F.struct("_order", "split", "last_id")).alias("k"), F.count("*").alias("n_splits")
    )
    # Only digests in several splits go on to the join.
    several = first.filter("n_splits > 1").select(
        hash_col,
        F.col("k._order").alias("_first"),
        F.col("k.split").alias("kept_split"),
        F.col("k.last_id").alias("kept_id"),
    )
    return (
        ranked.join(several, hash_col)
        .filter(F.col("_order") > F.col("_first"))
        .select("split", "image_id", "kept_split", "kept_id")
    )


def id_collisions(items: DataFrame) -> DataFrame:
    """``(key, source, split, image_id)`` of every item whose ID, ignoring case, is not unique."""
    key = F.lower(F.col("image_id").cast("string"))
    keyed = items.withColumn("key", key)
    repeated = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    return keyed.join(repeated, "key", "left_semi").select("key", "source", "split", "image_id")


def manifest_reconcile(
    observed: DataFrame, manifest_ids: DataFrame, manifest_counts: DataFrame
) -> DataFrame:
    """Per split: IDs only observed, IDs only listed, whether the sets and the counts agree.

    ``observed`` and ``manifest_ids`` are ``(split, image_id)``; ``manifest_counts`` is
    ``(split, listed_count)``.
    """
    seen = observed.select("split", "image_id").distinct().withColumn("_seen", F.lit(1))
    listed = manifest_ids.select("split", "image_id").distinct().withColumn("_listed", F.lit(1))
    totals = (
        seen.join(listed, ["split", "image_id"], "full_outer")
        .groupBy("split")
        .agg(
            F.count_if(F.col("_listed").isNull()).alias("unlisted"),
            F.count_if(F.col("_seen").isNull()).alias("unseen"),
            F.count("_seen").alias("observed_count"),
        )
    )
    return totals.join(manifest_counts, "split", "left").select(
        "split",
        "unlisted",
        "unseen",
        "observed_count",
        "listed_count",
        ((F.col("unlisted") == 0) & (F.col("unseen") == 0)).alias("ids_match"),
        F.coalesce(F.col("observed_count") == F.col("listed_count"), F.lit(False)).alias(
            "count_matches"
        ),
    )


def observed_classes(boxes: DataFrame, allowed: Sequence[int] = (0,)) -> DataFrame:
    """``(class_id, n_boxes, allowed)`` of every class in use."""
    return (
        boxes.groupBy("class_id")
        .agg(F.count("*").alias("n_boxes"))
        .withColumn("allowed", F.col("class_id").isin(*allowed))
    )


def issue_rows(df: DataFrame, severity: str, rule: str | None = None) -> DataFrame:
    """Bring any check result to ``(severity, rule, split, image_id, line_number)``."""
    have = set(df.columns)

    def column(name: str, kind: str):
        value = F.col(name) if name in have else F.lit(None)
        return value.cast(kind).alias(name)

    named = F.lit(rule).alias("rule") if rule else F.col("rule")
    return df.select(
        F.lit(severity).alias("severity"),
        named,
        column("split", "string"),
        column("image_id", "string"),
        column("line_number", "int"),
    )


def keyed_issues(images: DataFrame, labels: DataFrame, image_errors: DataFrame | None = None) -> DataFrame:
    """``(rule, split, image_id)``: missing and orphan labels, IDs in two splits, unreadable images.

    All rules come from one union of the inputs and two aggregates, so each input is read once and no table is
    joined. An ID's entry is as long as there are splits.
    """
    nothing = F.lit(None).cast("string")

    def tagged(df: DataFrame, image: int, label: int, error: Column) -> DataFrame:
        return df.select("split", "image_id", F.lit(image).alias("image"), F.lit(label).alias("label"), error.alias("error"))

    rows = tagged(images, 1, 0, nothing).unionByName(tagged(labels, 0, 1, nothing))
    if image_errors is not None:
        rows = rows.unionByName(tagged(image_errors.filter("error is not null"), 0, 0, F.col("error").cast("string")))
    each = rows.groupBy("image_id", "split").agg(F.max("image").alias("image"), F.max("label").alias("label"), F.max("error").alias("error"))
    held = each.groupBy("image_id").agg(F.collect_list(F.struct("split", "image", "label", "error")).alias("held"))

    def rule(name: str, condition: Callable[[Column], Column]) -> Column:
        return F.transform(F.filter("held", condition), lambda h: F.struct(F.lit(name).alias("rule"), h["split"].alias("split")))

    # A row for each pair of splits, under the later name.
    splits = F.array_distinct(F.transform(F.filter("held", lambda h: h["image"] == 1), lambda h: h["split"]))
    later = F.flatten(F.transform(splits, lambda b: F.transform(F.filter(splits, lambda a: a < b), lambda _: F.struct(F.lit("split_overlap").alias("rule"), b.alias("split")))))
    rules = F.concat(
        rule("missing_label", lambda h: (h["image"] == 1) & (h["label"] == 0)),
        rule("orphan_label", lambda h: (h["image"] == 0) & (h["label"] == 1)),
        rule("unreadable_image", lambda h: h["error"].isNotNull()),
        later,
    )
    return held.select(F.inline(rules), "image_id")


def validation_issues(
    images: DataFrame,
    labels: DataFrame,
    line_issues: DataFrame,
    image_errors: DataFrame | None = None,
    contents: DataFrame | None = None,
    manifest: DataFrame | None = None,
    fingerprint: DataFrame | None = None,
    files: DataFrame | None = None,
    unlabelled: bool = False,
) -> DataFrame:
    """All checks of a prepared dataset as one table of issues.

    ``images`` and ``labels`` are ``(split, image_id)``; ``line_issues`` comes from the label
    parser; ``image_errors`` from the header reader (``split, image_id, error``); ``contents`` is
    ``(split, image_id, digest)`` for the optional leak check, in which images without a label count only if ``unlabelled``;
    ``files`` is ``(split, path)`` for the check of stems that occur twice; ``manifest`` is the result of
    ``manifest_reconcile``; ``fingerprint`` one row ``(dataset_fingerprint)``.
    """
    found = [issue_rows(keyed_issues(images, labels, image_errors), "error"), issue_rows(line_issues, "error")]
    if contents is not None:
        if not unlabelled:
            contents = contents.join(labels.select("split", "image_id").distinct(), ["split", "image_id"], "left_semi")
        found.append(issue_rows(content_leak(contents), "error", "content_in_two_splits"))
    if files is not None:
        repeated = duplicate_stems(files).select("split", F.col("stem_key").alias("image_id"))
        found.append(issue_rows(repeated, "error", "repeated_stem"))
    if manifest is not None:
        found.append(issue_rows(manifest.filter("not ids_match"), "error", "manifest_ids"))
        found.append(issue_rows(manifest.filter("not count_matches"), "error", "manifest_count"))
    if fingerprint is not None:
        missing = fingerprint.filter("dataset_fingerprint is null")
        found.append(issue_rows(missing, "warning", "missing_fingerprint"))
    issues = found[0]
    for more in found[1:]:
        issues = issues.unionByName(more)
    return issues


def validation_status(issues: DataFrame) -> DataFrame:
    """One row: ``status, n_errors, n_warnings``."""
    counted = issues.agg(
        F.count_if(F.col("severity") == "error").alias("n_errors"),
        F.count_if(F.col("severity") == "warning").alias("n_warnings"),
    )
    status = F.when(F.col("n_errors") == 0, "pass").otherwise("fail")
    return counted.select(status.alias("status"), "n_errors", "n_warnings")


def assert_valid(issues: DataFrame) -> None:
    """Raise with the full report when there is any error."""
    n_errors = issues.filter("severity = 'error'").count()
    if n_errors:
        raise DatasetProblems(n_errors, issues)


def first_missing(expected: DataFrame, present: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` missing IDs, for a short message."""
    return expected.join(present, "image_id", "left_anti").orderBy("image_id").limit(n)


def top_per_image(pred: DataFrame, n: int) -> DataFrame:
    """At most ``n`` detections per image, best first. The rank filter prunes before the shuffle."""
    best = Window.partitionBy("image_id").orderBy(F.desc("confidence"), F.asc("pred_idx"))
    return pred.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
