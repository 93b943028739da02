"""Frames, latency, quantiles, ranks, runs, text and streams."""

import datetime
import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from boxframe.functions import sql as sql_functions
from boxframe.functions import text as tx
from boxframe.operators import frames, quantiles, ranking, reports, runs, scoring, sweep
from boxframe import schemas
from boxframe.plans import evaluation, video
from boxframe.schemas import DETECTION_COLUMNS, FRAME_COLUMNS, FRAME_PREDICTION
from boxframe.sinks import files as sinks
from boxframe.sources import manifests, predictions
from boxframe.streaming import frames as streams
from boxframe.streaming import state


def one(spark, column):
    return spark.range(1).select(column.alias("v")).head().v


def interpolated(values, q):
    ordered = sorted(values)
    at = (len(ordered) - 1) * q
    low = int(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] * (1 - (at - low)) + ordered[high] * (at - low)


@pytest.mark.parametrize("hot_rows", [10**6, 5])
def test_quantiles(spark, hot_rows):
    rng = random.Random(3)
    groups = {
        "heavy": [rng.paretovariate(0.3) for _ in range(700)],
        "copies": [2.0] * 400 + [3.0] * 3,
        "few": [1.0, 2.0, 3.0, 4.0],
        "one": [-7.5],
        "signed": [rng.uniform(-5, 5) for _ in range(333)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("few", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = quantiles.exact_quantiles(df, F.col("v"), {"m": 0.5, "p": 0.95}, ["g"], hot_rows)
    for r in got.collect():
        assert r.m == pytest.approx(statistics.median(groups[r.g]))
        assert r.p == pytest.approx(interpolated(groups[r.g], 0.95))
    all_values = [v for vs in groups.values() for v in vs]
    whole = quantiles.exact_quantiles(df, F.col("v"), {"p": 0.95}, (), hot_rows).head()
    assert whole.p == pytest.approx(interpolated(all_values, 0.95))


def test_distribution_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    row = quantiles.distribution(empty, ["v"]).head()
    assert row.n == 0 and row.p95 is None


@pytest.mark.parametrize("hot_rows", [10**6, 10])
def test_ranks_and_totals(spark, hot_rows):
    rng = random.Random(5)
    rows = [(k, i, rng.randint(0, 3)) for k in "ab" for i in range(200 if k == "a" else 6)]
    df = spark.createDataFrame(rows, "k string, i int, n int").repartition(3)
    levels = [F.floor(F.col("i") / 50), F.floor(F.col("i") / 7)]
    ranked = ranking.grouped_row_number(df, ["k"], [F.asc("i")], levels, "r", hot_rows)
    assert all(r.r == r.i + 1 for r in ranked.collect())
    summed = ranking.grouped_running_sums(df, ["k"], [F.asc("i")], levels, {"s": "n"}, hot_rows)
    for r in summed.collect():
        assert r.s == sum(n for k, i, n in rows if k == r.k and i <= r.i)


def test_latency(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 1.0), (None, 2.0, 2.0)], "preprocess_ms double, inference_ms double, postprocess_ms double")
    row = frames.latency_summary(rows).head()
    assert (row.mean_end_to_end_ms, row.fps) == (4.0, 250.0)
    bad = rows.withColumn("inference_ms", F.lit(-1.0))
    assert frames.bad_latency_samples(bad).count() == 2
    with pytest.raises(Exception, match="finite and non-negative"):
        frames.latency_summary(bad).collect()
    with pytest.raises(Exception, match="at least one sample"):
        frames.latency_summary(rows.limit(0)).collect()


def scored_frames(spark):
    box = dict(class_id=0, class_name="object", confidence=0.75, x1=10.0, y1=10.0, x2=30.0, y2=30.0)
    rows = [("clip.mp4", i, [box] if i != 1 else [], 1.0, 2.0 + i, 1.0) for i in range(3)]
    return spark.createDataFrame(rows, f"video_name string, frame_index int, {FRAME_PREDICTION}")


def videos(spark):
    return spark.createDataFrame(
        [("clip.mp4", 64, 48, 30.0, 3, 828601953, 0.5, "incomplete"), ("bad.mp4", 0, 48, 30.0, 3, 0, 0.0, "failed")],
        "video_name string, width int, height int, fps double, frame_count long, fourcc int, elapsed_seconds double, status string",
    )


def test_video_tables(spark, tmp_path):
    found, rows, summary = video.video_tables(scored_frames(spark), videos(spark), stride=2, as_text=True)
    assert [r.frame_index for r in rows.orderBy("frame_index").collect()] == [0, 2]
    assert tuple(found.columns) == DETECTION_COLUMNS
    assert found.head().box_area_ratio == f"{400 / (64 * 48):.6f}"
    row = summary.head()
    assert (row.video_name, row.frames_processed, row.total_detections, row.status) == ("clip.mp4", 2, 2, "incomplete")
    assert (row.p95_inference_ms, row.processing_fps) == (pytest.approx(3.9), 4.0)
    sinks.write_frame_tables(found, rows, f"{tmp_path}/out")
    back = spark.read.option("header", True).csv(f"{tmp_path}/out/frame_metrics")
    assert set(FRAME_COLUMNS) <= set(back.columns) and back.count() == 2


def test_metadata(spark):
    rows = {r.video_name: r for r in frames.video_metadata(videos(spark)).collect()}
    assert (rows["clip.mp4"].codec, rows["clip.mp4"].duration_seconds) == ("avc1", 0.1)
    assert rows["bad.mp4"].problem == "invalid_metadata" and rows["bad.mp4"].codec is None


def test_score_frames(spark):
    def factory():
        def detect(batch, label):
            box = dict(class_id=0, class_name=label, confidence=0.5, x1=0.0, y1=0.0, x2=1.0, y2=1.0)
            return pd.DataFrame({"detections": [[box]] * len(batch), "preprocess_ms": 0.0, "inference_ms": 1.0, "postprocess_ms": 0.0})

        return detect

    rows = scoring.score_frames(spark.range(5), factory, ["id"], label="x").collect()
    assert sorted(r.id for r in rows) == list(range(5)) and rows[0].detections[0].class_name == "x"


def test_raw_results(spark):
    rows = [
        ("a", [[0.0, 0.0, 0.5, 0.5]], [0.9], [0.0], {"inference": 2.0}),
        ("b", None, None, None, {}),
        ("c", [[0.0, 0.0, 0.5]], [0.9], [0.0], {}),
        ("d", [], [0.1], [], {}),
        ("e", [], [], [], {"inference": -1.0}),
        ("f", [], [], [], None),
    ]
    df = spark.createDataFrame(rows, "image_id string, xyxyn array<array<double>>, conf array<double>, cls array<double>, speed map<string,double>")
    found = {r.image_id: r.problem for r in predictions.check_results(df).collect()}
    assert found == {"a": None, "b": None, "c": "box_arity", "d": "uneven_arrays", "e": "invalid_timing", "f": "missing_timing"}
    assert [r.image_id for r in predictions.explode_predictions(df).collect()] == ["a"]
    timing = predictions.stage_timings(df).filter("image_id = 'a'").head()
    assert (timing.preprocess_ms, timing.inference_ms) == (0.0, 2.0)


def test_text(spark):
    lit = F.lit
    assert one(spark, tx.fixed6(lit(0.0078125))) == "0.007812"
    assert one(spark, tx.fixed6(lit(0.0015625))) == "0.001563"
    assert one(spark, tx.redact(lit("a GH_TOKEN = xyz, kaggle_key=1;b hidden2 hidden"), values=["hidden", "hidden2"])) == (
        "a GH_TOKEN=[REDACTED], kaggle_key=[REDACTED];b [REDACTED] [REDACTED]"
    )
    assert one(spark, tx.normalize_id(lit(" a\\b/c.tar.gz\t"))) == "c.tar"
    assert one(spark, tx.normalize_id(lit(".."))) is None
    assert one(spark, tx.bounded_count(lit(10), 0.25)) == 2
    stamp = F.lit("2024-01-02 03:04:05").cast("timestamp")
    assert one(spark, tx.video_run_id(lit("__my clip!__"), stamp, lit("0123456789"))) == "my_clip_20240102T030405Z_01234567"
    assert one(spark, tx.training_run_id(lit(".a b"), stamp, lit(None).cast("string"))) == "a_b_20240102T030405Z_nogit"
    assert one(spark, tx.utc_seconds(stamp)) == "2024-01-02T03:04:05Z"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # The second instant has no wall clock of its own in New York.
        for seconds, text in ((0, "1970-01-01T00:00:00Z"), (1710055800, "2024-03-10T07:30:00Z"), (1710037800, "2024-03-10T02:30:00Z")):
            assert one(spark, tx.utc_seconds(F.timestamp_seconds(lit(seconds)))) == text
        assert one(spark, tx.utc_compact(F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))) == "20240102T030405Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(spark, tx.failure_advice(lit("CUDA OUT OF MEMORY"))) == tx.OUT_OF_MEMORY_ADVICE


def test_sql_functions(spark):
    assert sql_functions.register_sql_functions(spark) == ["box_ratio", "box_overlap", "box_iou"]
    value = spark.sql("SELECT box_iou(0D, 0D, .5D, .5D, .25D, .25D, .75D, .75D) AS v, box_ratio(1D, 0D) AS z").head()
    assert value.v == pytest.approx(1 / 7) and value.z == 0.0


def test_json(spark):
    docs = spark.createDataFrame([(1, '{"k": 1}'), (2, "[1]"), (3, '{"k"'), (4, "{}"), (5, None)], "i int, j string")
    rows = manifests.parse_json(docs, "j", "k bigint, _corrupt_record string").collect()
    assert [r.problem for r in rows] == [None, "not_an_object", "unreadable", None, "unreadable"]


def loop_champion(rows, tolerance):
    best = None
    for row in sorted(rows, key=lambda r: (r["finished_at"], r["run_id"])):
        if best is None:
            best = row
            continue
        for name, direction in reports.RANKING:
            gain = (row[name] - best[name]) * direction
            if abs(gain) > tolerance:
                if gain > 0:
                    best = row
                break
    return best["run_id"]


def test_champion(spark):
    rng = random.Random(9)
    rows = [
        dict(run_id=i, finished_at=i, dataset_fingerprint=f"d{i % 3}", status="success", split="val", model_sha256="x",
             **{n: rng.randint(0, 6) / 1000 for n, _ in reports.RANKING})
        for i in range(90)
    ]
    df = spark.createDataFrame(pd.DataFrame(rows))
    got = {r.dataset_fingerprint: r.run_id for r in reports.champion(df).collect()}
    assert got == {f"d{k}": loop_champion([r for r in rows if r["run_id"] % 3 == k], 0.002) for k in range(3)}


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_champion_in_chunks(spark, chunk):
    rng = random.Random(chunk)
    rows = [
        dict(run_id=i, finished_at=i // 3, dataset_fingerprint=f"d{i % 2}", status="success", split="val", model_sha256="x",
             **{n: rng.randint(0, 4) / 1000 for n, _ in reports.RANKING})
        for i in range(60)
    ]
    got = {r.dataset_fingerprint: r.run_id for r in reports.champion(spark.createDataFrame(pd.DataFrame(rows)), chunk=chunk).collect()}
    assert got == {f"d{k}": loop_champion([r for r in rows if r["run_id"] % 2 == k], 0.002) for k in range(2)}


def test_champion_that_changes_ten_thousand_times(spark, monkeypatch):
    rows = [
        dict(run_id=i, finished_at=i, dataset_fingerprint="d", status="success", split="val", model_sha256="x",
             **{n: direction * i * 0.01 for n, direction in reports.RANKING})
        for i in range(10_000)
    ]
    written, tables = reports.cut_lineage, []
    monkeypatch.setattr(reports, "cut_lineage", lambda df: tables.append(1) or written(df))
    assert reports.champion(spark.createDataFrame(pd.DataFrame(rows)), chunk=2048).head().run_id == 9999
    # A table for the chunks, one to start, two for each of at most five chunks, one that finds no more.
    assert len(tables) <= 13


def test_run_gate(spark):
    rows = [("a", "a", "failed", "d", "f"), ("b", "c", "failed", "d", "f"), ("e", "e", "success", "d", "f"), ("g", "g", "failed", "d", None), ("h", "h", "failed", "d", "old")]
    df = spark.createDataFrame(rows, "run_id string, directory string, status string, dataset string, dataset_fingerprint string")
    now = spark.createDataFrame([("d", "f")], "dataset string, current_fingerprint string")
    assert {r.run_id: r.refusal for r in runs.resume_gate(df, now).collect()} == {
        "a": None, "b": "run_id_mismatch", "e": "already_successful", "g": "no_fingerprint", "h": "fingerprint_changed",
    }
    assert {r.run_id: r.refusal for r in runs.resume_gate(df, now, True).collect()}["h"] is None
    assert one(spark, runs.allowed_next(F.lit("running"), F.lit("success")))
    assert not one(spark, runs.allowed_next(F.lit("success"), F.lit("running")))


def test_resume_records(spark):
    shape = "run_id string, ts timestamp, event_id long, checkpoint string, checkpoint_sha256 string, allow_dataset_change boolean"
    at = [datetime.datetime(2024, 5, 1, 10, k, tzinfo=datetime.timezone.utc) for k in range(8)]
    rows = [
        ("a", at[3], 1, "x/a/weights/last.pt", "s1", False), ("a", at[1], 2, "a/weights/last.pt", "s2", None), ("a", at[2], 3, "x/a/weights/best.pt", "s3", False),
        ("a", at[4], 4, "x/b/weights/last.pt", "s4", False), ("b", at[0], 5, "x/b/weights/last.pt", "s5", False), ("b", at[1], 6, "x/b/weights/last.pt", "s6", True),
        ("c", at[0], 7, "x/c/weights/last.pt", "s7", True), ("d", at[0], 8, "x/d/weights/last.pt", "s8", True), ("e", at[0], 9, "x/e/weights/last.pt", "s9", True),
        ("a", at[5], 10, None, None, None),
    ]
    ledger = spark.createDataFrame(
        [("a", "failed", 1, "f"), ("b", "failed", 1, "old"), ("c", "success", 1, "f"), ("d", "running", 1, "")], "run_id string, status string, dataset int, dataset_fingerprint string"
    )
    now = spark.createDataFrame([(1, "f")], "dataset int, current_fingerprint string")
    attempts = spark.createDataFrame(rows, shape)
    for hot_rows in (1, 1000):
        got = {r.event_id: r for r in runs.resume_records(attempts, ledger, now, hot_rows).collect()}
        assert {k: (r.refusal, r.seq) for k, r in got.items()} == {
            1: (None, 2), 2: (None, 1), 3: ("checkpoint_layout", None), 4: ("run_id_mismatch", None), 5: ("fingerprint_changed", None), 6: (None, 1),
            7: ("already_successful", None), 8: ("no_fingerprint", None), 9: ("unknown_run", None), 10: ("checkpoint_layout", None),
        }
        assert got[6].dataset_changed and (got[6].original_fingerprint, got[6].current_fingerprint) == ("old", "f") and not got[1].dataset_changed
        assert got[1].resumed_at_utc == "2024-05-01T10:03:00Z" and got[1].checkpoint_sha256 == "s1"


def test_metrics_document(spark, tmp_path):
    gt = spark.createDataFrame([("a", 0, 0.1, 0.1, 0.3, 0.3, 0)], "image_id string, gt_idx int, x1 double, y1 double, x2 double, y2 double, class_id int")
    pred = gt.withColumnRenamed("gt_idx", "pred_idx").withColumn("confidence", F.lit(0.8))
    pictures = spark.createDataFrame([("a", "val"), ("b", "val")], "image_id string, split string")
    result = evaluation.evaluate(gt, pred, pictures, "val")
    assert result.problems.count() == 0 and result.selected.head().recall == 1.0
    assert result.references.head().best_f1_threshold == 0.8
    with pytest.raises(Exception, match="no single row"):
        sweep.select_row(result.rows, 0.123).collect()
    nan = pred.union(pred.withColumns({"pred_idx": F.lit(1), "confidence": F.lit(float("nan"))}))
    spoiled = evaluation.evaluate(gt, nan, pictures, "val", results=pictures.select("image_id").limit(1))
    assert {r.predictions for r in spoiled.rows.filter("threshold < 0.8").collect()} == {1}
    assert {r.problem for r in spoiled.problems.collect()} == {"missing", "prediction_confidence_outside_unit_interval"}
    with pytest.raises(ValueError, match="missing"):
        evaluation.assert_evaluable(spoiled)
    assert [r.problem for r in evaluation.evaluation_problems(gt, pred, pictures.limit(0), "val").collect()] == ["empty_split"]
    timing = spark.createDataFrame([(4.0,)], "fps double")
    precision = spark.createDataFrame([(0.5, 0.25)], "map50 double, map50_95 double")
    row = evaluation.metrics_document(result.rows, timing, "r", "val", 0.25, True, precision=precision).head()
    assert (row.metrics.map50, row.metrics.recall, row.latency.fps, row.counts.images) == (0.5, 1.0, 4.0, 2)
    sinks.write_sweep(result.rows, f"{tmp_path}/sweep")
    back = spark.read.option("header", True).csv(f"{tmp_path}/sweep/threshold_sweep_csv")
    assert tuple(back.columns) == sweep.METRIC_COLUMNS and back.count() == 19


def frame_files(spark, folder):
    rows = [
        ("a", 0, "2024-01-01 00:00:00", False, None), ("a", 1, "2024-01-01 00:01:00", True, None),
        ("b", 0, "2024-01-01 00:00:00", False, None), ("b", 1, "2024-01-01 00:02:00", False, "ValueError: x"),
        ("c", 0, "2024-01-01 00:00:00", False, None), ("z", 0, "2024-01-02 00:00:00", False, None),
    ]
    df = spark.createDataFrame(rows, "video_name string, frame_index int, ts string, is_end boolean, error string")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(f"{folder}/in")
    return spark.readStream.schema(df.schema).parquet(f"{folder}/in")


def test_stream_completion(spark, tmp_path):
    done = streams.run_append(streams.stream_completion(frame_files(spark, tmp_path), "10 minutes", "1 minute"))
    assert {r.video_name: (r.frames, r.status, r.error) for r in done.collect()} == {
        "a": (2, "complete", None), "b": (2, "failed", "ValueError: x"), "c": (1, "incomplete", state.INTERRUPTED),
    }


def test_stream_dedup(spark, tmp_path):
    stream = frame_files(spark, tmp_path).select(F.col("video_name").alias("image_id"), "ts")
    assert sorted(r.image_id for r in streams.run_append(streams.stream_dedup(stream)).collect()) == ["a", "b", "c", "z"]


def test_read_json(spark, tmp_path):
    (tmp_path / "registry.json").write_text('{"active_model": null, "history": [{"name": "m"}], "schema_version": "1.0"}')
    (tmp_path / "broken.json").write_text("[]")
    rows = {r.path.rsplit("/", 1)[-1]: r for r in manifests.read_json(spark, str(tmp_path), schemas.REGISTRY).collect()}
    assert rows["broken.json"].problem == "not_an_object"
    good = rows["registry.json"]
    assert good.problem is None and good.doc.active_model is None and good.doc.history[0].name == "m"
