"""File readers, file writers with a commit, and published versions."""

import json
import struct
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from boxframe.sinks import file_sink
from boxframe.sinks import files as sinks
from boxframe.sources import file_source, labels
from boxframe.sources.stores import listed

ROOT = Path(__file__).resolve().parents[1]


def test_label_files_keep_empty_ones_and_are_dealt_by_bytes(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i}.txt").write_text("" if i % 3 == 0 else f"0 0.5 0.5 0.1 0.{i + 10}\n" * i)
    (tmp_path / "other.csv").write_text("x")
    (tmp_path / "_hidden.txt").write_text("x")
    files = labels.read_label_files(spark, f"file://{tmp_path}", opencost=1000, partitionbytes=10_000)
    assert files.rdd.getNumPartitions() >= 4 if hasattr(files, "rdd") else True
    rows = {r.image_id: r.text for r in files.collect()}
    assert len(rows) == 30 and rows["0"] == "" and rows["7"].count("\n") == 7
    assert labels.parse_labels(files)[0].count() == sum(i for i in range(30) if i % 3)
    sizes = file_source.read_text_files(spark, str(tmp_path), ".txt", "size bigint")
    assert sizes.columns == ["size"] and sizes.count() == 30
    assert file_source.read_text_files(spark, str(tmp_path), ".none").count() == 0


def big_jpeg(width, height, padding):
    """A size that stands behind long application segments, and pixels behind it."""
    segment = b"\xff\xe1" + struct.pack(">H", 65535) + b"\0" * 65533
    frame = b"\xff\xc0" + struct.pack(">HBHH", 17, 8, height, width) + b"\3" + b"\0" * 9
    return b"\xff\xd8" + segment * padding + frame + b"\0" * 5_000_000


def test_image_sizes_read_little(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep/a.JPG").write_bytes(big_jpeg(640, 480, 5))
    tiff = b"II*\0" + struct.pack("<I", 3_000_000) + b"\0" * 2_999_992 + struct.pack("<H", 2) + struct.pack("<HHIHH", 256, 3, 1, 7, 0) + struct.pack("<HHII", 257, 4, 1, 9)
    (tmp_path / "b.tif").write_bytes(tiff)
    (tmp_path / "c.png").write_bytes(b"no image")
    (tmp_path / "d.ppm").write_bytes(b"P3\n0 5\n255\n")
    (tmp_path / "e.bmp").write_bytes(b"")
    (tmp_path / "f.txt").write_text("x")
    rows = {Path(r.path).name: r for r in file_source.read_image_sizes(spark, str(tmp_path)).collect()}
    assert {n: (r.width, r.height, r.error) for n, r in rows.items()} == {
        "a.JPG": (640, 480, None), "b.tif": (7, 9, None), "c.png": (None, None, "unreadable"),
        "d.ppm": (None, None, "non_positive_dimension"), "e.bmp": (None, None, "unreadable"),
    }
    assert max(r.bytes_read for r in rows.values()) <= 65536 and rows["a.JPG"].size > 5_000_000
    assert file_source.read_image_sizes(spark, str(tmp_path), "path string, bytes_read bigint").agg(F.sum("bytes_read")).first()[0] > 0


ROWS = "video_name string, frame_index int, ms double"


def test_csv_buckets(spark, tmp_path):
    frames = spark.createDataFrame([("hot", i, i / 4) for i in range(300)] + [(f"v{i}", 0, None) for i in range(100)], ROWS)
    for _ in range(2):
        file_sink.write_csv_buckets(frames, f"file://{tmp_path}/t", ["video_name", "frame_index"], 5)
    parts = list((tmp_path / "t").glob("part-*.csv"))
    assert len(parts) <= 10 and all(p.read_text().startswith('"video_name"') for p in parts)
    back = file_sink.read_csv_buckets(spark, f"file://{tmp_path}/t", ROWS)
    assert sorted(map(str, back.collect())) == sorted(map(str, frames.union(frames).collect()))
    assert file_sink.read_csv_buckets(spark, f"{tmp_path}/none", ROWS).count() == 0
    file_sink.write_csv_buckets(frames.limit(0), f"{tmp_path}/empty", ["video_name"], 3)
    assert file_sink.read_csv_buckets(spark, f"{tmp_path}/empty", ROWS).count() == 0


FAILING = """
import sys
from pathlib import Path
from pyspark.sql import SparkSession, functions as F
from boxframe.sinks import file_sink
folder = sys.argv[1]
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
@F.udf("bigint")
def once(i):
    mark = Path(folder) / "failed"
    if i == 90 and not mark.exists():
        mark.touch()
        raise ValueError("a task that fails once, after it has written rows")
    return i
rows = spark.range(100, numPartitions=2).select(F.lit("v").alias("video_name"), once("id").alias("frame_index"))
spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
spark.dataSource.register(file_sink.ListedFiles)
rows.write.format("boxframe_listed").mode("append").option("path", folder + "/t").save()
back = file_sink.read_csv_buckets(spark, folder + "/t", "video_name string, frame_index bigint")
print("READ", back.count(), back.agg(F.countDistinct("frame_index")).first()[0])
"""


def test_a_task_that_fails_once(tmp_path):
    done = subprocess.run([sys.executable, "-c", FAILING, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert "READ 100 100" in done.stdout, done.stderr[-2000:]
    listed_names = [n for f in (tmp_path / "t/_lists").glob("*.json") for n in json.loads(f.read_text())["files"]]
    there = {p.name for p in (tmp_path / "t").glob("part-*.csv")}
    assert (tmp_path / "failed").exists() and set(listed_names) <= there


def test_stream_of_csv_buckets_ignores_a_repeated_batch(spark, tmp_path):
    spark.createDataFrame([("a", i, 1.0) for i in range(20)], ROWS).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ROWS).parquet(f"{tmp_path}/in")
    file_sink.stream_csv_buckets(stream, f"{tmp_path}/out", f"{tmp_path}/state", ["video_name"], {"availableNow": True}, 2).awaitTermination()
    back = file_sink.read_csv_buckets(spark, f"{tmp_path}/out", ROWS)
    assert back.count() == 20 and len(listed(f"{tmp_path}/out", (".csv",))) <= 2
    writer = file_sink._StreamWriter({"path": f"{tmp_path}/out"})
    again = writer.write(iter(back.toArrow().to_batches()))
    assert len(again.files) == 1
    writer.commit([again, None], 0)
    assert file_sink.read_csv_buckets(spark, f"{tmp_path}/out", ROWS).count() == 20
    assert len(listed(f"{tmp_path}/out", (".csv",))) <= 2


def test_label_texts(spark, tmp_path):
    rows = [("train", "a", 1, "two\n"), ("train", "a", 0, "one\n"), ("val", "b", 0, "")]
    sinks.write_label_texts(spark.createDataFrame(rows, "split string, image_id string, part int, text string"), str(tmp_path))
    assert (tmp_path / "train/a.txt").read_text() == "one\ntwo\n" and (tmp_path / "val/b.txt").read_text() == ""


def tables(spark, n=4):
    return {"rows": spark.range(n).withColumn("split", F.lit("train")), "notes": spark.createDataFrame([("x",)], "text string")}


def test_two_publishers_at_once(spark, tmp_path):
    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(lambda _: sinks.publish(tables(spark), str(tmp_path), "v"), range(4)))
    assert all(p == paths[0] for p in paths)
    assert len(list((tmp_path / "v/_published").glob("*.json"))) == 1 and len(list((tmp_path / "v").glob("attempt-*"))) == 1
    assert sinks.read_published(spark, str(tmp_path), "v", "rows").count() == 4


def test_a_crash_leaves_the_last_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    first = sinks.publish(tables(spark), root, "v")
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_create", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            sinks.publish(tables(spark, 9), root, "v", force=True)
    assert sinks.published_paths(spark, root, "v") == first
    # A list that was begun and not written.
    (tmp_path / "v/_published/000002.json").write_text('{"tables": {"ro')
    assert sinks.published_paths(spark, root, "v") == first
    second = sinks.publish(tables(spark, 9), root, "v", force=True)
    assert second != first and sinks.read_published(spark, root, "v", "rows").count() == 9
    assert (tmp_path / "v/_published/000003.json").exists()


def test_a_changed_version_is_not_reused(spark, tmp_path):
    root = str(tmp_path)
    first = sinks.publish(tables(spark), root, "v")
    assert sinks.publish(tables(spark), root, "v") == first and sinks.verify_published(spark, root, "v") == []
    spark.range(1).withColumn("split", F.lit("train")).write.mode("append").partitionBy("split").parquet(first["rows"])
    assert sinks.verify_published(spark, root, "v") == ["rows"]
    second = sinks.publish(tables(spark), root, "v")
    assert second != first and sinks.verify_published(spark, root, "v") == []
    for file in Path(second["notes"]).glob("*.parquet"):
        file.unlink()
    assert sinks.verify_published(spark, root, "v") == ["notes"]


def test_folders_are_listed_and_read_once_by_tasks(spark, tmp_path):
    rows = [(f"{i % 3}/{i}.txt", "" if i % 4 == 0 else "0 0.5 0.5 0.1 0.1\n1 0.5 0.5 0.1") for i in range(30)] + [("0/note.md", "x")]
    file_sink.write_named_texts(spark.createDataFrame(rows, "name string, text string").coalesce(1), str(tmp_path))
    # A task for each folder.
    files = labels.read_label_folders(spark, f"file://{tmp_path}")
    assert files.rdd.getNumPartitions() == 3 and {r.image_id for r in files.collect()} == {str(i) for i in range(30)}
    reads = tmp_path / "0" / "0.txt"
    reports = labels.file_reports(files)
    reads.unlink()
    # Read by then: later passes go over the written texts.
    assert {r.image_id: (r.n_lines, r.rules) for r in reports.collect()} == {str(i): (0, None) if i % 4 == 0 else (2, "field_count") for i in range(30)}
