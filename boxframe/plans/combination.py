"""Combining prepared sources into one dataset version."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.operators.checkpoints import cut_lineage
from boxframe.operators.combine import combine_sources, source_issues
from boxframe.operators.fingerprint import combined_fingerprint, content_digest, split_hash
from boxframe.operators.profile import dataset_counts
from boxframe.operators.quality import assert_valid, id_collisions, issue_rows
from boxframe.schemas import SPLITS
from boxframe.sinks.files import publish
from boxframe.sources.labels import parse_labels


@dataclass(frozen=True)
class Combined:
    """Items of all sources, their counts, issues and the fingerprint of the combination."""

    items: DataFrame
    counts: DataFrame
    issues: DataFrame
    fingerprint: DataFrame


def _named(sources: dict[str, DataFrame], *columns: str) -> DataFrame:
    """Those columns of all sources, with their ``source``."""
    parts = [df.select(F.lit(name).alias("source"), *columns) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts)


def check_sources(sources: dict[str, DataFrame], labels: dict[str, DataFrame]) -> DataFrame:
    """Issues of all sources: pairing, label lines, repeated IDs, splits that are empty or unknown.

    ``labels`` holds ``(split, image_id, text)``, the label files of each source.
    """
    if set(labels) != set(sources):
        raise ValueError("label files are needed for each source")
    files = _named(labels, "split", "image_id", "text")
    _, line_issues = parse_labels(files)
    return source_issues(_named(sources, "split", "image_id"), files, line_issues, list(sources))


def combine_datasets(
    sources: dict[str, DataFrame],
    prefixes: dict[str, str],
    trusted: dict[str, str] | None = None,
    seed: int = 42,
    labels: dict[str, DataFrame] | None = None,
) -> Combined:
    """Combine ``(split, image_id, object_count)`` items, keeping each source's splits.

    A source with a trusted fingerprint (64 hexadecimal digits) is not hashed again; the others need
    ``image_sha`` and ``label_sha`` columns and are hashed together. With ``labels``, the label files
    ``(split, image_id, text)`` of each source, :func:`check_sources` checks them before.
    """
    trusted = dict(trusted or {})
    for name, digest in trusted.items():
        if name not in sources:
            raise ValueError(f"a trusted fingerprint of no source: {name}")
        if re.fullmatch("[0-9a-f]{64}", digest) is None:
            raise ValueError(f"not a fingerprint of 64 hexadecimal digits: {digest!r} of {name}")
    prints = dict(trusted)
    rest = {n: df for n, df in sources.items() if n not in trusted}
    if rest:
        # A row for each source.
        hashed = content_digest(_named(rest, "split", "image_id", "image_sha", "label_sha"))
        prints |= {r.source: r.digest for r in hashed.select("source", "digest").collect()}
        # A source without items has the digest of nothing; it fails by its empty splits.
        prints |= {n: sha256().hexdigest() for n in rest if n not in prints}
    plain = {n: df.select("split", "image_id", "object_count") for n, df in sources.items()}
    items = cut_lineage(combine_sources(plain, prefixes))
    collisions = issue_rows(id_collisions(items), "error", "id_collision")
    if labels is None:
        wanted = items.sparkSession.createDataFrame([(n, s) for n in sources for s in SPLITS], "source string, split string")
        empty = wanted.join(items.select("source", "split").distinct(), ["source", "split"], "left_anti")
        issues = collisions.unionByName(issue_rows(empty, "error", "empty_split"))
    else:
        issues = collisions.unionByName(issue_rows(cut_lineage(check_sources(sources, labels)), "error"))
    fingerprint = combined_fingerprint(split_hash(items), prints, seed)
    return Combined(items, dataset_counts(items), issues, fingerprint)


def publish_combined(combined: Combined, root: str, force: bool = False) -> tuple[str, dict[str, str]]:
    """Check, then publish under the combined fingerprint; a version already there is reused."""
    assert_valid(combined.issues)
    fingerprint = combined.fingerprint.head()[0]
    tables = {"items": combined.items, "counts": combined.counts}
    return fingerprint, publish(tables, root, fingerprint, force)
