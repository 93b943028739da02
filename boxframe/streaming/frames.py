"""Frame predictions as a stream."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxframe.operators.checkpoints import checkpoint_folder
from boxframe.operators.frames import frame_rows, select_frames
from boxframe.streaming.state import describe_runs, open_runs, stream_runs


def stream_frame_metrics(
    frames: DataFrame,
    stride: int = 1,
    start_seconds: float | None = None,
    end_seconds: float | None = None,
) -> DataFrame:
    """Frame rows of a stream: a filter and a projection, no state."""
    return frame_rows(select_frames(frames, stride, start_seconds, end_seconds))


def stream_completion(
    frames: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes", idle: str | None = None
) -> DataFrame:
    """Close a video run after ``gap`` without frames and say how it ended; see :func:`stream_runs`."""
    return describe_runs(stream_runs(frames, gap, delay, idle), gap)


def stream_dedup(results: DataFrame, key: str = "image_id", delay: str = "1 hour") -> DataFrame:
    """Pass each result of a key once; repeats within the delay are dropped."""
    return results.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def stream_repeats(results: DataFrame, key: str = "image_id") -> DataFrame:
    """Results per key so far, for a totals stream; a repeat, however late, is a ``duplicate`` problem."""
    counted = results.groupBy(key).agg(F.count("*").alias("n_results"))
    return counted.withColumn("problem", F.when(F.col("n_results") > 1, "duplicate"))


def write_in_order(rows: DataFrame, ts: str, parts: int, folder: str) -> None:
    """Write rows once as ``parts`` files, each a stretch of time, rows without a time first.

    A file source takes files in the order of their times of writing, so those are set to follow the stretches. The
    store has to keep them, as HDFS and mounted folders do.
    """
    spark = rows.sparkSession
    rows.repartitionByRange(parts, F.asc_nulls_first(ts)).write.mode("append").parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f for f in fs.listStatus(path) if f.getPath().getName().startswith("part-")), key=lambda f: f.getPath().getName())
    first = min((f.getModificationTime() for f in files), default=0)
    for i, file in enumerate(files):
        fs.setTimes(file.getPath(), first + 1000 * i, -1)


def work_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"


#: Work through what is there, then stop. A live stream takes ``{"processingTime": "10 seconds"}``.
ONCE = {"availableNow": True}


def start_rows(stream: DataFrame, target: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Append a stream to Parquet files; they are visible after every batch, so the trigger is the flush interval."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()


def write_rows(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append a stream to Parquet files until its present input is used up."""
    start_rows(stream, target, checkpoint).awaitTermination()


def start_totals(stream: DataFrame, target: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Write the totals that a batch has changed, with the batch's number: as many rows as keys it touched.

    A repeated batch replaces its own folder. Readers take each key's latest row (:func:`latest_totals`).
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch-{number}")

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.outputMode("update").trigger(**trigger).start()


def latest_totals(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The latest row of each key."""
    rows = spark.read.parquet(f"{target}/*")
    rest = [c for c in rows.columns if c not in (*keys, "_batch")]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_row"))
    return latest.select(*keys, "_row.*")


def compact_totals(spark: SparkSession, target: str, keys: Sequence[str], buckets: int = 8) -> None:
    """Fold the batches written so far into one folder of at most ``buckets`` files and remove them.

    The latest row of a key decides wherever it lies, so readers see the same before, meanwhile and after, also if this
    stops half way. Run it between batches, or while the stream goes on: later batches are left alone.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath().toString() for f in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    if len(done) < 2:
        return
    rows = spark.read.parquet(*done)
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), "_batch").alias("_row"))
    latest.select(*keys, "_row.*").repartition(buckets, *keys).write.parquet(f"{target}/folded-{uuid.uuid4().hex}")
    for folder in done:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)


def run_append(stream: DataFrame) -> DataFrame:
    """Run an append stream over its present input and read the result back."""
    spark = stream.sparkSession
    folder = work_folder(spark)
    write_rows(stream, f"{folder}/rows", f"{folder}/state")
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def run_totals(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Run an update stream over its present input and read the latest totals back."""
    spark = stream.sparkSession
    folder = work_folder(spark)
    start_totals(stream, f"{folder}/totals", f"{folder}/state").awaitTermination()
    return latest_totals(spark, f"{folder}/totals", keys)


def run_runs(frames: DataFrame, gap: str, delay: str) -> DataFrame:
    """All runs of a finished input: those that the stream has closed, and those still open in its state."""
    spark = frames.sparkSession
    folder = work_folder(spark)
    stream = stream_runs(frames, gap, delay)
    write_rows(stream, f"{folder}/rows", f"{folder}/state")
    kind = stream.schema["video_name"].dataType.simpleString()
    closed = spark.read.schema(stream.schema).parquet(f"{folder}/rows")
    return describe_runs(closed.unionByName(open_runs(spark, f"{folder}/state", kind)), gap)
