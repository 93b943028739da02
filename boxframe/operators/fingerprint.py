"""Digests of ID lists, file contents and whole datasets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from boxframe.functions.text import digest_matches, is_digest
from boxframe.operators.checkpoints import cut_lineage

# Hexadecimal digits of the ID's hash that name its leaf in a list digest, and version of that rule.
LEAF_DIGITS = 4
DIGEST_RULE = "sha256-tree-1"
# Texts of a sorted list that go on as one piece.
PIECE = 64


def canonical_json(value: Column) -> Column:
    """Compact JSON that keeps nulls; the caller names struct fields in alphabetical order."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_digest(value: Column) -> Column:
    return F.sha2(canonical_json(value), 256)


def _ordered_text(sort: Column, text: Column) -> Column:
    entries = F.array_sort(F.collect_list(F.struct(sort.alias("k"), text.alias("t"))))
    return F.array_join(F.transform(entries, lambda e: e["t"]), "")


def _pieces(batches: Iterator[pa.RecordBatch], shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted texts, joined in pieces that are numbered within the task; a null text counts and adds nothing."""
    part, piece = TaskContext.get().partitionId(), 0
    for batch in batches:
        columns, out = [c.to_pylist() for c in batch.columns], []
        for keys, rows in groupby(zip(*columns, strict=True), lambda x: x[:-1]):
            texts = [x[-1] for x in rows]
            for i in range(0, len(texts), PIECE):
                some = texts[i : i + PIECE]
                out.append((*keys, part, piece, len(some), "".join(t for t in some if t is not None)))
                piece += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), shape, strict=True)], schema=shape)


def _running(batches: Iterator[pa.RecordBatch], shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Digests of pieces in order: no more than a batch and one running digest are held."""
    now, n, digest = None, 0, hashlib.sha256()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*now, n, digest.hexdigest()), shape, strict=True)], schema=shape)

    for batch in batches:
        for *keys, _, _, count, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if keys != now:
                if now is not None:
                    yield out()
                now, n, digest = keys, 0, hashlib.sha256()
            n += count
            digest.update(text.encode())
    if now is not None:
        yield out()


def _streamed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, n, digest)`` over ``_text`` in ``_sort`` order, for groups of any size.

    Ranges are sorted and written in pieces by all tasks. A digest runs over the pieces of its group in
    order, in one task, as a digest of a single text must; it holds one batch.
    """
    named = [rows.schema[k] for k in keys]
    kinds = T.StructType([*named, *T._parse_datatype_string("_part int, _piece bigint, _n bigint, _joined string").fields])
    last = T.StructType([*named, *T._parse_datatype_string("n bigint, digest string").fields])
    piece_shape, last_shape = to_arrow_schema(kinds), to_arrow_schema(last)
    ranged = rows.repartitionByRange(*keys, "_sort").sortWithinPartitions(*keys, "_sort").select(*keys, "_text")
    pieces = cut_lineage(ranged.mapInArrow(lambda b: _pieces(b, piece_shape), kinds))
    ordered = pieces.repartition(*keys).sortWithinPartitions(*keys, "_part", "_piece")
    return ordered.mapInArrow(lambda b: _running(b, last_shape), last)


def ordered_digest(
    rows: DataFrame,
    keys: Sequence[str],
    sort: Column,
    text: Column,
    leaf_key: Column,
    leaf_digits: int = LEAF_DIGITS,
) -> DataFrame:
    """``(keys, n, digest)``: root of a hash tree over the rows of a group, one rule at every size.

    A row's leaf is named by the first ``leaf_digits`` digits of the SHA-256 of ``leaf_key``. A leaf's
    hash is that of its texts in ``sort`` order; a branch joins the leaves whose names differ in the
    second half of their digits, and the root joins the branches. Branches and root hash the names
    and hashes of their children in name order. No task holds more than a leaf, a branch or the root;
    raise ``leaf_digits`` for lists beyond some billions. The value depends on it, so a manifest
    records it with :data:`DIGEST_RULE`. With fewer digits than :data:`LEAF_DIGITS` leaves grow with
    the list and are streamed in order instead of gathered.
    """
    if leaf_digits < 1:
        raise ValueError("a leaf needs at least one digit")
    keys = list(keys)
    leaf = F.substring(F.sha2(leaf_key.cast("string"), 256), 1, leaf_digits)
    branch = F.substring("_leaf", 1, leaf_digits - leaf_digits // 2)

    def joined(name: str, value: str) -> Column:
        return F.sha2(_ordered_text(F.col(name), F.concat(F.col(name), F.col(value))), 256)

    placed = rows.select(*keys, sort.alias("_sort"), text.alias("_text"), leaf.alias("_leaf"))
    if leaf_digits < LEAF_DIGITS:
        leaves = _streamed(placed, [*keys, "_leaf"]).withColumnsRenamed({"digest": "_d", "n": "_c"})
    else:
        leaves = placed.groupBy(*keys, "_leaf").agg(
            F.sha2(_ordered_text(F.col("_sort"), F.col("_text")), 256).alias("_d"), F.count("*").alias("_c")
        )
    branches = leaves.groupBy(*keys, branch.alias("_branch")).agg(
        joined("_leaf", "_d").alias("_b"), F.sum("_c").alias("_c")
    )
    return branches.groupBy(*keys).agg(F.sum("_c").alias("n"), joined("_branch", "_b").alias("digest"))


def split_hash(members: DataFrame, leaf_digits: int = LEAF_DIGITS) -> DataFrame:
    """``(split, n, digest)`` of the ID list of every split, one ID per line."""
    name = F.col("image_id").cast("string")
    return ordered_digest(members, ["split"], name, F.concat(name, F.lit("\n")), name, leaf_digits)


def file_digest(members: DataFrame, most: int | None = None) -> DataFrame:
    """``(split, n, digest)`` where the digest is that of the sorted list written as one file.

    A file's digest is one sequence, so each split ends in one task, which streams its sorted parts. With
    ``most``, a split of more IDs is an error, never another digest.
    """
    name = F.col("image_id").cast("string")
    if most is not None:
        sizes = members.groupBy("split").agg(F.count("*").alias("n"))
        text = F.concat(F.lit("a file digest is for at most "), F.lit(most), F.lit(" IDs, not "), F.col("n"))
        # The size is looked at before any ID is sorted.
        sizes.select(F.when(F.col("n") > most, F.raise_error(text)).alias("ok")).collect()
    return _streamed(members.select("split", name.alias("_sort"), F.concat(name, F.lit("\n")).alias("_text")), ["split"])


def content_digest(items: DataFrame, leaf_digits: int = LEAF_DIGITS) -> DataFrame:
    """``(source, n, digest)`` over split, ID and the two content hashes, NUL-terminated.

    Within a leaf items count in the order train, val, test and then by ID.
    """
    order = F.array_position(F.array(F.lit("train"), F.lit("val"), F.lit("test")), F.col("split"))
    name = F.col("image_id").cast("string")
    nul = F.chr(F.lit(0))
    text = F.concat(
        F.col("split"), nul, name, nul, F.col("image_sha"), nul, F.col("label_sha"), nul
    )
    return ordered_digest(
        items, ["source"], F.struct(order.alias("o"), name.alias("i")), text, name, leaf_digits
    )


def content_sha(df: DataFrame, content_col: str, out: str = "sha256") -> DataFrame:
    return df.withColumn(out, F.sha2(F.col(content_col).cast("binary"), 256))


def verify_digests(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Add ``well_formed`` and ``matches`` (null when the expected text is no digest)."""
    return df.withColumns(
        {
            "well_formed": is_digest(F.lower(F.trim(F.col(expected)))),
            "matches": digest_matches(F.col(actual), F.col(expected)),
        }
    )


def split_hash_struct(hashes: DataFrame) -> DataFrame:
    """One row with the digests of the three splits as a struct in alphabetical order."""
    picked = [
        F.max(F.when(F.col("split") == s, F.col("digest"))).alias(s)
        for s in ("test", "train", "val")
    ]
    return hashes.agg(*picked).select(F.struct("test", "train", "val").alias("split_hashes"))


def dataset_fingerprint(hashes: DataFrame, source_sha: str, options: dict[str, object]) -> DataFrame:
    """One row: the fingerprint of conversion options, source archive and split lists."""
    conversion = F.struct(*[F.lit(options[k]).alias(k) for k in sorted(options)])
    return split_hash_struct(hashes).select(
        json_digest(
            F.struct(
                conversion.alias("conversion"),
                F.lit(source_sha).alias("source_archive_sha256"),
                "split_hashes",
            )
        ).alias("dataset_fingerprint")
    )


def combined_fingerprint(hashes: DataFrame, source_prints: dict[str, str], seed: int) -> DataFrame:
    """One row: the fingerprint of a combination of sources."""
    sources = F.struct(*[F.lit(source_prints[k]).alias(k) for k in sorted(source_prints)])
    return split_hash_struct(hashes).select(
        json_digest(
            F.struct(F.lit(seed).alias("seed"), sources.alias("source_fingerprints"), "split_hashes")
        ).alias("dataset_fingerprint")
    )
