"""Streams with state: totals, runs, restarts and timers."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from boxframe.functions.rank_sketch import RankSketch
from boxframe.streaming import frames as streams
from boxframe.streaming import state

FRAMES = "video_name string, frame_index int, detections int, inference_ms double"


@pytest.mark.parametrize("n", [1, 7, 64, 65, 1000, 50_000])
def test_rank_sketch(n):
    values = np.random.default_rng(n).pareto(1.0, n)
    whole, halves = RankSketch(64).add(values), [RankSketch(64).add(v) for v in np.array_split(values, 5)]
    merged = RankSketch(64)
    for half in halves:
        merged.merge(RankSketch.from_bytes(half.to_bytes()))
    for sketch in (whole, merged):
        assert sketch.count == n
        for q in (0.0, 0.5, 0.95, 1.0):
            rank = (values <= sketch.quantile(q)).sum()
            assert abs(rank - max(1, np.ceil(q * n))) <= (0 if n <= 64 else 0.05 * n)
    assert RankSketch().add(np.array([np.nan])).quantile(0.5) is None


def write(spark, rows, folder, schema=FRAMES):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def plain_totals(rows):
    out = {}
    for video in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == video]
        ms = sorted(r[3] for r in own if r[3] is not None)
        p95 = ms[max(1, int(np.ceil(0.95 * len(ms)))) - 1] if ms else None
        out[video] = (len(own), sum((r[2] or 0) > 0 for r in own), sum(r[2] or 0 for r in own), sum(ms) if ms else None, max(ms, default=None), p95)
    return out


def test_totals_go_on_after_a_restart(spark, tmp_path):
    first = [("a", i, i % 3, float(i)) for i in range(40)] + [("b", 0, None, None), (None, 0, 1, 2.0)]
    second = [("a", 40, 5, 0.5), ("c", 0, 1, 9.0)]
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(FRAMES).parquet(f"{tmp_path}/in")
    place = (f"{tmp_path}/totals", f"{tmp_path}/state")
    for number, rows in enumerate((first, second)):
        write(spark, rows, f"{tmp_path}/in")
        streams.start_totals(state.stream_totals(source, shares=3), *place).awaitTermination()
        changed = spark.read.parquet(f"{place[0]}/batch-{number}")
        assert {r.video_name for r in changed.collect()} == {r[0] for r in rows}
    assert changed.count() == 2
    for _ in range(2):
        rows = state.merged_totals(streams.latest_totals(spark, place[0], ["video_name", "share"])).collect()
        assert {r.video_name: tuple(r)[1:] for r in rows} == plain_totals(first + second)
        streams.compact_totals(spark, place[0], ["video_name", "share"])
    assert len(list((tmp_path / "totals").iterdir())) == 1


MARKS = "video_name string, ts timestamp, is_end boolean, error string"


def marks(spark, rows):
    return spark.createDataFrame(rows, "video_name string, ts string, is_end boolean, error string").withColumn("ts", F.to_timestamp("ts"))


def test_runs_over_batches_out_of_order_and_without_a_time(spark, tmp_path):
    batches = [
        [("a", "2024-01-01 00:00:00", False, None), ("b", "2024-01-01 00:00:00", False, "E: late"), ("d", None, True, None)],
        [("a", "2024-01-01 00:16:00", True, None), ("b", "2024-01-01 00:00:30", False, None)],
        # Joins the two parts of a's run; b's first error is an earlier one.
        [("a", "2024-01-01 00:08:00", None, None), ("b", "2023-12-31 23:59:00", False, "E: first")],
        [("c", "2024-01-02 00:00:00", True, None)],
        [("c", "2024-01-02 00:05:00", False, None)],
    ]
    for i, rows in enumerate(batches):
        marks(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    streams_in = spark.readStream.schema(MARKS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    rows = streams.run_runs(streams_in, "10 minutes", "1 hour").collect()
    assert {r.video_name: (str(r.started_at), r.frames, r.status, r.error) for r in rows} == {
        "a": ("2024-01-01 00:00:00", 3, "complete", None),
        "b": ("2023-12-31 23:59:00", 3, "failed", "E: first"),
        "c": ("2024-01-02 00:00:00", 2, "complete", None),
    }


def test_idle_run_is_closed_by_the_clock(spark, tmp_path):
    marks(spark, [("a", "2024-01-01 00:00:00", False, None), ("b", "2024-01-01 00:00:00", True, None)]).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(MARKS).parquet(f"{tmp_path}/in")
    stream = streams.stream_completion(source, "10 minutes", idle="1 second")
    query = streams.start_rows(stream, f"{tmp_path}/out", f"{tmp_path}/state", {"processingTime": "200 milliseconds"})
    try:
        until = time.time() + 90
        while time.time() < until:
            done = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out") if (tmp_path / "out" / "_spark_metadata").exists() else None
            if done is not None and done.count() == 2:
                break
            time.sleep(0.5)
        assert {r.video_name: (r.status, r.error) for r in done.collect()} == {"a": ("incomplete", state.INTERRUPTED), "b": ("complete", None)}
    finally:
        query.stop()


def test_files_follow_their_times(spark, tmp_path):
    rows = [("a", f"2024-01-01 00:{i:02}:00", False, None) for i in range(40)] + [("n", None, False, None)]
    streams.write_in_order(marks(spark, rows), "ts", 4, f"{tmp_path}/in")
    assert spark.read.parquet(f"{tmp_path}/in").count() == 41
    files = sorted((tmp_path / "in").glob("part-*.parquet"), key=lambda f: f.stat().st_mtime)
    firsts = [spark.read.parquet(str(f)).agg(F.min("ts"), F.max("ts"), F.count_if(F.col("ts").isNull())).first() for f in files]
    assert firsts[0][2] == 1 and all(a[1] < b[0] for a, b in zip(firsts, firsts[1:]))


def test_merge_runs():
    runs = [(0, 5, 2, False, None, None), (12, 12, 1, True, 12, "x"), (7, 8, 1, False, 7, "y"), (30, 30, 1, False, None, None)]
    assert state.merge_runs(runs, 5) == [(0, 12, 4, True, 7, "y"), (30, 30, 1, False, None, None)]


def test_many_runs_need_calls_by_shares_only():
    class Timers(list):
        listTimers = property(lambda self: lambda: list(self))
        registerTimer, deleteTimer = list.append, list.remove

    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Clock:
        def getCurrentWatermarkInMs(self):
            return 100

    processor = state._Runs(5_000, None)
    processor.handle, processor.runs = Timers(), Held()
    rng = np.random.default_rng(3)
    rows = [(f"v{rng.integers(40)}" if i % 50 else None, int(rng.integers(200_000)), bool(rng.integers(9) == 0), f"E{rng.integers(3)}" if rng.integers(8) == 0 else None) for i in range(900)]
    parts = [pd.DataFrame(rows[i : i + 300], columns=["video_name", "at", "is_end", "error"]) for i in (0, 300, 600)]
    for part in parts:
        list(processor.handleInputRows((0,), iter([part[:100], part[100:]]), Clock()))
        assert len(processor.handle) == 1

    want = []
    for video in {r[0] for r in rows}:
        own, runs = sorted((r for r in rows if r[0] == video), key=lambda r: r[1]), []
        for row in own:
            if runs and row[1] - runs[-1][-1][1] < 5_000:
                runs[-1].append(row)
            else:
                runs.append([row])
        for run in runs:
            bad = min(((r[1], r[3]) for r in run if r[3]), default=(None, None))
            want.append((video, run[0][1], run[-1][1], len(run), any(r[2] for r in run), *bad))
    held = state._rows(processor._known())
    assert sorted(r[:-1] for r in held if r[0]) == sorted(w for w in want if w[0])
    assert sorted(r[1:-1] for r in held if r[0] is None) == sorted(w[1:] for w in want if w[0] is None)
    (closed,) = processor.handleExpiredTimer((0,), Clock(), None)
    assert len(closed) == sum(w[2] + 5_000 <= 100_000 for w in want) > 0
    assert len(processor._known()) == len(want) - len(closed) and processor.handle[-1] > 100
