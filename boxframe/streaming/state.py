"""Stateful operators of frame streams: running totals with a state for each video, runs that end with one for a share of them.

The state lives in Spark's state store (RocksDB) and comes back after a restart. Timers of the store close runs, so
no marker has to follow the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from boxframe.functions.rank_sketch import RankSketch

# Fixed value: the error text of an interrupted run.
INTERRUPTED = "Interrupted by user"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

TOTALS = (
    "frames_processed bigint, frames_with_detections bigint, total_detections bigint, "
    "inference_ms_sum double, inference_ms_max double"
)
RUN = "start bigint, last bigint, frames bigint, ended boolean, error_at bigint, error string"


def use_state_store(spark: SparkSession) -> None:
    """Stateful processors need the RocksDB store; a query takes the setting over when it starts."""
    spark.conf.set(_PROVIDER, PROVIDER)


def _and_more(spent: float | None, top: float | None, ms: list[float]) -> tuple[float, float]:
    return (spent or 0.0) + sum(ms), max(ms) if top is None else max(top, *ms)


_TOTALS_ROW = Row("video_name", "share", *[c.split()[0] for c in TOTALS.split(", ")], "sketch")


class _Totals(StatefulProcessor):
    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", f"{TOTALS}, sketch binary")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.totals.get()
        if known is None:
            frames, hits, found, spent, top, sketch = 0, 0, 0, None, None, RankSketch(self.width)
        else:
            frames, hits, found, spent, top, data = known
            sketch = RankSketch.from_bytes(bytes(data))
        ms = []
        for row in rows:
            count = row["detections"] or 0
            frames, hits, found = frames + 1, hits + (count > 0), found + count
            if row["inference_ms"] is not None:
                ms.append(row["inference_ms"])
            if len(ms) >= self.width:
                spent, top = _and_more(spent, top, ms)
                sketch.add(ms)
                ms = []
        if ms:
            spent, top = _and_more(spent, top, ms)
            sketch.add(ms)
        now = (frames, hits, found, spent, top, sketch.to_bytes())
        self.totals.update(now)
        yield _TOTALS_ROW(*key, *now)

    def close(self) -> None:
        pass


def stream_totals(frames: DataFrame, shares: int = 1, width: int = 2048) -> DataFrame:
    """Running totals per video and share, for update mode: a batch gives rows for the videos it touched only.

    Input ``(video_name, frame_index, detections, inference_ms)``. A video's frames are spread over ``shares`` states,
    so that one with a third of all frames isn't kept by one task; :func:`merged_totals` puts shares together.
    ``sketch`` is a mergeable summary of the inference times, exact up to ``width`` frames of a share.
    """
    use_state_store(frames.sparkSession)
    share = F.pmod(F.coalesce("frame_index", F.lit(0)), F.lit(shares)).cast("int")
    slim = frames.select("video_name", share.alias("share"), "detections", "inference_ms")
    kind = slim.schema["video_name"].dataType.simpleString()
    return slim.groupBy("video_name", "share").transformWithState(
        statefulProcessor=_Totals(width),
        outputStructType=f"video_name {kind}, share int, {TOTALS}, sketch binary",
        outputMode="Update",
        timeMode="None",
    )


def merged_totals(totals: DataFrame, q: float = 0.95, name: str = "p95_inference_ms") -> DataFrame:
    """One row per video of the latest rows of all its shares, with a quantile from the merged sketches."""

    @F.pandas_udf("double")
    def quantile(sketches: pd.Series) -> float:
        merged = RankSketch()
        for data in sketches:
            merged.merge(RankSketch.from_bytes(bytes(data)))
        return merged.quantile(q)

    sums = ["frames_processed", "frames_with_detections", "total_detections", "inference_ms_sum"]
    numbers = totals.groupBy("video_name").agg(*[F.sum(c).alias(c) for c in sums], F.max("inference_ms_max").alias("inference_ms_max"))
    sketched = totals.groupBy(F.col("video_name").alias("_video")).agg(quantile("sketch").alias(name))
    return numbers.join(sketched, F.col("video_name").eqNullSafe(F.col("_video"))).drop("_video")


#: Stands for "no error" where times of errors are compared.
_NEVER = np.iinfo(np.int64).max
#: Frames that are gathered before they are put to the runs of their share.
_FRAMES = 100_000
_HELD = ["video_name", *[c.split()[0] for c in RUN.split(", ")], "seen"]


_PACKED = pa.schema(
    [("video_name", pa.string()), ("start", pa.int64()), ("last", pa.int64()), ("frames", pa.int64()), ("ended", pa.bool_())]
    + [("error_at", pa.int64()), ("error", pa.string()), ("seen", pa.int64())]
)


def _packed(held: pd.DataFrame) -> bytes:
    """Runs as one value of the state; a value for each run costs more than all the rest."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _PACKED) as stream:
        stream.write_batch(pa.RecordBatch.from_pandas(held, _PACKED, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _held(rows: list[tuple]) -> pd.DataFrame:
    """Runs in the order of ``_HELD`` as a frame of plain arrays."""
    video, start, last, frames, ended, error_at, error, seen = zip(*rows) if rows else [()] * len(_HELD)
    times = [_NEVER if t is None else t for t in error_at]
    numbers = {"start": start, "last": last, "frames": frames, "error_at": times, "seen": seen}
    held = {n: np.array(v, np.int64) for n, v in numbers.items()} | {"ended": np.array(ended, bool)}
    return pd.DataFrame(held | {"video_name": np.array(video, object), "error": np.array(error, object)})[_HELD]


def _rows(held: pd.DataFrame) -> list[tuple]:
    """The runs of a frame in the order of ``_HELD``."""
    columns = {n: held[n].tolist() for n in _HELD}
    columns["error_at"] = [None if t == _NEVER else t for t in columns["error_at"]]
    return list(zip(*columns.values()))


def _points(part: pd.DataFrame, seen: int) -> pd.DataFrame:
    """Each frame as a run of its own."""
    at = part["at"].to_numpy(np.int64)
    errors = part["error"].to_numpy(object)
    bad = part["error"].notna().to_numpy()
    return pd.DataFrame(
        {
            "video_name": part["video_name"].to_numpy(object),
            "start": at,
            "last": at,
            "frames": np.ones(len(at), np.int64),
            "ended": part["is_end"].eq(True).fillna(False).to_numpy(bool),
            "error_at": np.where(bad, at, _NEVER),
            "error": np.where(bad, errors, None),
            "seen": np.full(len(at), seen, np.int64),
        }
    )


def _merged(held: pd.DataFrame, gap: int) -> pd.DataFrame:
    """Runs of a video with less than ``gap`` between them become one, for many videos at once."""
    if held.empty:
        return held
    video = pd.factorize(held["video_name"], use_na_sentinel=False)[0]
    order = np.lexsort((held["last"].to_numpy(), held["start"].to_numpy(), video))
    held, video = held.iloc[order], video[order]
    values = {n: held[n].to_numpy() for n in _HELD}
    latest = held["last"].groupby(video).cummax().to_numpy()
    first = np.ones(len(held), bool)
    first[1:] = (video[1:] != video[:-1]) | (values["start"][1:] - latest[:-1] >= gap)
    at = np.flatnonzero(first)
    error_at = np.minimum.reduceat(values["error_at"], at)
    # Of the errors at a run's first time of one, the least text.
    run = np.cumsum(first) - 1
    bad = np.flatnonzero((values["error_at"] < _NEVER) & (values["error_at"] == error_at[run]))
    error = np.full(len(at), None, object)
    texts = pd.Series(values["error"][bad], dtype=object).groupby(run[bad]).min()
    error[texts.index.to_numpy(int)] = texts.to_numpy(object)
    return pd.DataFrame(
        {
            "video_name": values["video_name"][at],
            "start": values["start"][at],
            "last": np.maximum.reduceat(values["last"], at),
            "frames": np.add.reduceat(values["frames"], at),
            "ended": np.logical_or.reduceat(values["ended"], at),
            "error_at": error_at,
            "error": error,
            "seen": np.maximum.reduceat(values["seen"], at),
        }
    )


def merge_runs(runs: list[tuple], gap: int) -> list[tuple]:
    """Runs (in the order of ``RUN``) of one video with less than ``gap`` between them become one."""
    return [run[1:-1] for run in _rows(_merged(_held([(None, *run, 0) for run in runs]), gap))]


class _Runs(StatefulProcessor):
    """Open runs of a share of the videos. A timer of event time closes runs their gap after the last frame; one of
    processing time closes all of a video once nothing of it has come for ``idle``. A share has one timer, for its
    first run to close, and is gone through at once, so that calls are as many as shares and not as runs."""

    def __init__(self, gap: int, idle: int | None):
        self.gap, self.idle = gap, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "packed binary")

    def _known(self) -> pd.DataFrame:
        held = self.runs.get()
        return _held([]) if held is None else _unpacked(bytes(held[0])).to_pandas()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, waiting, n = self._known(), [], 0
        now = 0 if self.idle is None else timerValues.getCurrentProcessingTimeInMs()
        for part in rows:
            waiting.append(_points(part, now))
            n += len(part)
            if n >= max(_FRAMES, len(known)):
                known, waiting, n = _merged(pd.concat([known, *waiting]), self.gap), [], 0
        known = _merged(pd.concat([known, *waiting]), self.gap)
        if self.idle is not None:
            known["seen"] = known.groupby("video_name", dropna=False)["seen"].transform("max")
        self.runs.update((_packed(known),))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(int(self._over_at(known).min()))
        yield _closed(known[:0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self._known()
        now = timerValues.getCurrentWatermarkInMs() if self.idle is None else timerValues.getCurrentProcessingTimeInMs()
        over_at = self._over_at(known)
        left = known[over_at > now]
        if len(left):
            self.runs.update((_packed(left),))
            self.handle.registerTimer(int(over_at[over_at > now].min()))
        else:
            self.runs.clear()
        yield _closed(known[over_at <= now])

    def _over_at(self, known: pd.DataFrame) -> np.ndarray:
        """The first whole millisecond at or after the end of each run."""
        if self.idle is not None:
            return known["seen"].to_numpy() + self.idle
        return -(-(known["last"].to_numpy() + self.gap) // 1000)

    def close(self) -> None:
        pass


def _closed(held: pd.DataFrame) -> pd.DataFrame:
    out = held.drop(columns="seen")
    return out.assign(error_at=out["error_at"].astype("Int64").mask(out["error_at"] == _NEVER))


def stream_runs(frames: DataFrame, gap: str, delay: str = "10 minutes", idle: str | None = None, shares: int = 256) -> DataFrame:
    """Runs of a video that have ended, for append mode.

    Input ``(video_name, ts, is_end, error)``; rows without a time are not part of a run and go. A run ends ``gap``
    after its last frame in event time, when the watermark (``delay`` behind the latest frame) has passed that. With
    ``idle`` it ends when no frame of the video has come for so long on the clock. :func:`describe_runs` says how.
    The open runs of the videos of one of ``shares`` are held together; a checkpoint keeps to its number of shares.
    """
    spark = frames.sparkSession
    use_state_store(spark)
    micros = _micros(spark, gap)
    timed = frames.filter("ts is not null")
    timed = timed.withWatermark("ts", delay) if idle is None else timed
    kind = frames.schema["video_name"].dataType.simpleString()
    slim = timed.select(
        F.pmod(F.xxhash64("video_name"), F.lit(shares)).cast("int").alias("share"),
        F.col("video_name").cast("string").alias("video_name"),
        "ts",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        "is_end",
        "error",
    )
    runs = slim.groupBy("share").transformWithStateInPandas(
        statefulProcessor=_Runs(micros, None if idle is None else _micros(spark, idle) // 1000),
        outputStructType=f"video_name string, {RUN}",
        outputMode="Append",
        timeMode="EventTime" if idle is None else "ProcessingTime",
    )
    return runs.withColumn("video_name", F.col("video_name").cast(kind))


def _micros(spark: SparkSession, length: str) -> int:
    start = "timestamp_micros(0)"
    return spark.sql(f"SELECT unix_micros({start} + interval {length}) - unix_micros({start})").first()[0]


def describe_runs(runs: DataFrame, gap: str) -> DataFrame:
    """``started_at``, ``closed_at``, ``frames``, ``status`` and ``error`` of runs.

    A run with an error is ``failed``, one with an end ``complete``, any other ``incomplete``. Frames that came
    before the end are counted either way. The first error decides, as the run stops there.
    """
    status = F.when(F.col("error_at").isNotNull(), "failed").when(F.col("ended"), "complete").otherwise("incomplete")
    error = F.when(status == "failed", F.col("error")).when(status == "incomplete", INTERRUPTED)
    return runs.select(
        "video_name",
        F.timestamp_micros("start").alias("started_at"),
        (F.timestamp_micros("last") + F.expr(f"interval {gap}")).alias("closed_at"),
        "frames",
        status.alias("status"),
        error.alias("error"),
    )


def open_runs(spark: SparkSession, checkpoint: str, kind: str = "string") -> DataFrame:
    """Runs that a stopped stream has not closed yet, read from its state.

    After a finished input these are the last runs of the videos; a live stream goes on with them when it is started
    again.
    """
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "runs").load()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                yield from _unpacked(data).to_batches()

    runs = held.select(F.col("value.packed")).mapInArrow(unpack, f"video_name string, {RUN}, seen bigint").drop("seen")
    error_at = F.nullif(F.col("error_at"), F.lit(int(_NEVER)))
    return runs.withColumns({"video_name": F.col("video_name").cast(kind), "error_at": error_at})
