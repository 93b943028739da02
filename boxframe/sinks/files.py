"""Writers: label files, split lists, sweeps, frame tables, and published dataset versions."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.operators.fingerprint import canonical_json
from boxframe.schemas import FRAME_COLUMNS
from boxframe.sinks.file_sink import write_csv_buckets, write_named_texts


def write_labels(labels: DataFrame, folder: str) -> None:
    """Label parts ``(split, image_id, part, text)``, one folder per split."""
    labels.write.mode("errorifexists").partitionBy("split").parquet(folder)


def write_split_lists(members: DataFrame, folder: str) -> None:
    """One folder per split with the sorted IDs, one per line."""
    ordered = members.select("split", F.col("image_id").cast("string").alias("value"))
    (
        ordered.repartitionByRange("split", "value")
        .sortWithinPartitions("split", "value")
        .write.mode("errorifexists")
        .partitionBy("split")
        .text(folder)
    )


def write_sweep(rows: DataFrame, folder: str) -> None:
    """The sweep as CSV and as JSON. One row per threshold, so one file each."""
    ordered = rows.coalesce(1).sortWithinPartitions("threshold")
    ordered.write.mode("errorifexists").option("header", True).csv(f"{folder}/threshold_sweep_csv")
    ordered.write.mode("errorifexists").json(f"{folder}/threshold_sweep_json")


def write_label_texts(labels: DataFrame, folder: str) -> None:
    """Label text as files: ``<split>/<image_id>.txt``, an empty one for an image without objects.

    Input ``(split, image_id, part, text)``; the parts of an image, one file in the end, are put together in one row.
    """
    parts = F.sort_array(F.collect_list(F.struct("part", "text")))
    whole = labels.groupBy("split", "image_id").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    name = F.concat_ws("/", "split", F.concat(F.col("image_id").cast("string"), F.lit(".txt")))
    write_named_texts(whole.select(name.alias("name"), "text"), folder)


def write_frame_tables(detections: DataFrame, frames: DataFrame, folder: str, files: int = 16) -> None:
    """Detection and frame rows as CSV, each in at most ``files`` files in order of video and frame."""
    keys = ("video_name", "frame_index")
    write_csv_buckets(detections, f"{folder}/detections", keys, files)
    write_csv_buckets(frames.select("video_name", *FRAME_COLUMNS), f"{folder}/frame_metrics", keys, files)


def manifest_json(fields: dict[str, Column]) -> Column:
    """Canonical JSON text of named columns: keys sorted, nulls kept."""
    return canonical_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text unless there is one; whoever comes second gets False."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = name.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(name.getParent())
    if store.getUri().getScheme() == "file":
        # Hadoop's local store looks first and writes then; the system call does both at once.
        try:
            with open(name.toUri().getPath(), "x", encoding="utf-8") as file:
                file.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = store.create(name, False)
    except Py4JJavaError as problem:
        if "AlreadyExists" in problem.java_exception.getClass().getSimpleName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _lists(spark: SparkSession, root: str, fingerprint: str) -> list[tuple[int, str]]:
    """Number and path of every list of a version, the latest first. A few: one for each forced rewrite."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{fingerprint}/_published")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    found = [f.getPath() for f in store.listStatus(folder)]
    return sorted(((int(p.getName()[:-5]), p.toString()) for p in found if p.getName().endswith(".json")), reverse=True)


def _listed(spark: SparkSession, root: str, fingerprint: str) -> tuple[int, dict[str, dict] | None]:
    """The highest number taken, and the tables of the latest whole list. One cut short by a crash doesn't count."""
    lists = _lists(spark, root, fingerprint)
    for _, path in lists:
        text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
        try:
            tables = json.loads(text)["tables"]
        except (ValueError, KeyError, TypeError):
            continue
        return lists[0][0], tables
    return (lists[0][0] if lists else 0), None


def table_digest(df: DataFrame) -> dict[str, object]:
    """Row count and a sum of row hashes: the same for the same rows, whatever their order and files."""
    hashed = F.xxhash64(*[F.struct(c).cast("string") if kind.startswith("map") else F.col(c) for c, kind in sorted(df.dtypes)])
    row = df.agg(F.count("*").alias("rows"), F.sum(hashed.cast("decimal(38,0)")).alias("digest")).first()
    return {"rows": row["rows"], "digest": str(row["digest"] or 0)}


def published_paths(spark: SparkSession, root: str, fingerprint: str) -> dict[str, str] | None:
    """Table paths of a published version, or None when it was never completed."""
    tables = _listed(spark, root, fingerprint)[1]
    return None if tables is None else {name: entry["path"] for name, entry in tables.items()}


def verify_published(spark: SparkSession, root: str, fingerprint: str) -> list[str]:
    """Names of the tables whose rows are not those that were listed; reads each once."""
    tables = _listed(spark, root, fingerprint)[1] or {}
    return sorted(name for name, entry in tables.items() if not _unchanged(spark, entry))


def _unchanged(spark: SparkSession, entry: dict) -> bool:
    try:
        return table_digest(spark.read.parquet(entry["path"])) == {k: entry[k] for k in ("rows", "digest")}
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    except Exception as problem:  # noqa: BLE001 - a file that is gone or cut short fails when it is read
        if "FAILED_READ_FILE" in str(problem) or "FileNotFound" in str(problem):
            return False
        raise


def publish(
    tables: dict[str, DataFrame], root: str, fingerprint: str, force: bool = False, verify: bool = True
) -> dict[str, str]:
    """Write a dataset version once and return its table paths.

    Tables go to a fresh attempt folder. What readers follow is a numbered list, made only if there is none of its
    number; they take the highest whole one. So a version is there as a whole or not at all, the last one stays
    until the next is complete, and of two publishers at once one wins: the other takes over what the winner listed
    (with ``force`` it tries the next number). A listed version is reused only if its rows still have the listed
    digests (``verify``); else it is written anew under the next number.
    """
    spark = next(iter(tables.values())).sparkSession
    number, known = _listed(spark, root, fingerprint)
    if known is not None and not force and set(known) == set(tables) and not (verify and verify_published(spark, root, fingerprint)):
        return {name: entry["path"] for name, entry in known.items()}
    attempt = f"{root}/{fingerprint}/attempt-{uuid.uuid4().hex}"
    entries = {}
    for name, df in tables.items():
        writer = df.write.mode("errorifexists")
        if "split" in df.columns and len(df.columns) > 1:
            writer = writer.partitionBy("split")
        writer.parquet(f"{attempt}/{name}")
        entries[name] = {"path": f"{attempt}/{name}"} | table_digest(spark.read.parquet(f"{attempt}/{name}"))
    text = json.dumps({"tables": entries}, sort_keys=True)
    while not _create(spark, f"{root}/{fingerprint}/_published/{number + 1:06d}.json", text):
        number, other = _listed(spark, root, fingerprint)
        if other is not None and not force and set(other) == set(tables):
            path = spark._jvm.org.apache.hadoop.fs.Path(attempt)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            return {name: entry["path"] for name, entry in other.items()}
    return {name: entry["path"] for name, entry in entries.items()}


def read_published(spark: SparkSession, root: str, fingerprint: str, name: str) -> DataFrame:
    paths = published_paths(spark, root, fingerprint)
    if paths is None:
        raise ValueError(f"no published version {fingerprint}")
    return spark.read.parquet(paths[name])
