"""Splits, checks, profile, fingerprints and the way from files to a published version."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from boxframe.operators import combine, fingerprint, profile, quality, splits
from boxframe.plans import combination, prepare
from boxframe.sinks import files as sinks
from boxframe.sources import images, labels, listing, split_lists, voc

OBJECT = (
    "<object><name>{0}</name><truncated>{5}</truncated><difficult>{6}</difficult><bndbox>"
    "<xmin>{1}</xmin><ymin>{2}</ymin><xmax>{3}</xmax><ymax>{4}</ymax></bndbox></object>"
)


def document(name, size, *objects):
    inner = "".join(OBJECT.format(*o) for o in objects)
    return (
        f"<annotation><filename>{name}.ppm</filename><size><width>{size}</width>"
        f"<height>{size}</height><depth>3</depth></size>{inner}</annotation>"
    )


TINY = {
    "image001": document("image001", 10, ("bolt", 1, 2, 5, 8, 0, 0)),
    "image002": document("image002", 10, ("wire", 8, 8, 12, 12, 1, 0)),
    "image003": document("image003", 10),
    "image004": document("image004", 20, ("stone", 2, 2, 8, 8, 0, 0), ("metal", 0, 0, 2, 2, 0, 1)),
    "image005": document("image005", 10, ("invalid", 5, 2, 5, 8, 0, 0)),
}


@pytest.fixture
def tiny(tmp_path):
    for folder in ("Annotations", "JPEGImages", "ImageSets/Main"):
        (tmp_path / "root" / folder).mkdir(parents=True)
    for name, xml in TINY.items():
        (tmp_path / "root/Annotations" / f"{name}.xml").write_text(xml)
        suffix = ".PPM" if name == "image002" else ".ppm"
        (tmp_path / "root/JPEGImages" / (name + suffix)).write_text("P3\n10 10\n255\n" + "0 " * 300)
    lists = tmp_path / "root/ImageSets/Main"
    (lists / "trainval.txt").write_text("﻿image001\nimage002\n\nimage003\nimage004\nimage001\n")
    (lists / "test.txt").write_text("image005\n")
    return tmp_path


def test_prepare_and_publish(spark, tiny):
    root = f"{tiny}/root"
    ready = prepare.prepare(spark, root, "a" * 64, 0.25)
    assert ready.issues.count() == 0
    stats = prepare.statistics(ready)
    assert {r.split: (r.images) for r in stats["splits"].collect()} == {"train": 3, "val": 1, "test": 1}
    assert stats["repairs"].head().asDict() == {"dimension_mismatches": 1, "rejected_objects": 1}
    assert stats["area_buckets"].head().asDict() == {"small": 0, "medium": 2, "large": 2}
    area = stats["box_area"].head()
    assert (area.mean, area.median, area.p95) == pytest.approx((0.17, 0.14, 0.342))
    names = {r.class_name: r.objects for r in stats["original_categories"].collect()}
    assert names == dict(bolt=1, invalid=1, metal=1, stone=1, wire=1)
    assert ready.rejects.head().reject_reason == "Bounding box is degenerate after clipping"
    key, paths = prepare.publish_prepared(ready, f"{tiny}/out")
    assert len(key) == 64
    manifest = json.loads(spark.read.parquet(paths["manifest"]).head()[0])
    assert manifest["dataset_fingerprint"] == key
    assert manifest["counts"] == {"test": 1, "train": 3, "val": 1}
    text = {r.image_id: r.text for r in spark.read.parquet(paths["labels"]).collect()}
    assert text == {
        "image001": "0 0.300000 0.500000 0.400000 0.600000\n",
        "image002": "0 0.900000 0.900000 0.200000 0.200000\n",
        "image003": "",
        "image004": "0 0.500000 0.500000 0.600000 0.600000\n0 0.100000 0.100000 0.200000 0.200000\n",
        "image005": "",
    }
    again = prepare.publish_prepared(ready, f"{tiny}/out")
    assert again == (key, paths)
    assert prepare.publish_prepared(ready, f"{tiny}/out", force=True)[1] != paths
    assert sinks.read_published(spark, f"{tiny}/out", key, "boxes").count() == 4
    assert sinks.published_paths(spark, f"{tiny}/out", "none") is None


def test_prepare_reports_missing_image(spark, tiny):
    (tiny / "root/JPEGImages/image003.ppm").unlink()
    (tiny / "root/Annotations/image001.xml").write_text("<annotation>")
    ready = prepare.prepare(spark, f"{tiny}/root", "a" * 64, 0.25)
    rules = {(r.rule, r.image_id) for r in ready.issues.collect()}
    assert {("missing_image", "image003"), ("image_not_found", "image003"), ("invalid_xml", "image001")} <= rules
    with pytest.raises(quality.DatasetProblems):
        quality.assert_valid(ready.issues)


def test_fallback_and_replay(spark, tiny):
    ready = prepare.prepare(spark, f"{tiny}/root", "a" * 64, official=False)
    assert {r[0]: r[1] for r in ready.images.groupBy("split").count().collect()} == {
        "train": 3, "val": 1, "test": 1,
    }
    stored = spark.createDataFrame([(n, "train") for n in TINY], "image_id string, split string")
    replayed = prepare.prepare(spark, f"{tiny}/root", "a" * 64, membership=stored)
    assert {r.split for r in replayed.images.collect()} == {"train"}


@pytest.mark.parametrize("n", [2, 3, 37, 1000])
def test_split_counts(spark, n):
    ids = spark.range(n).select(F.concat(F.lit("i"), "id").alias("image_id"))
    test = spark.createDataFrame([("i0",), ("t",)], "image_id string") if n > 3 else ids.limit(0)
    rows = splits.assign_splits(ids, test, 0.2, 7)
    got = {r.image_id: r.split for r in rows.collect()}
    shuffled = splits.assign_splits(ids.orderBy(F.rand(1)).repartition(3), test, 0.2, 7)
    assert got == {r.image_id: r.split for r in shuffled.collect()}
    free = n - 1 if n > 3 else n
    assert sum(v == "val" for v in got.values()) == min(free - 1, max(1, round(free * 0.2)))
    order = sorted(
        (k for k, v in got.items() if v != "test"),
        key=lambda k: hashlib.sha256(f"7:{k}".encode()).hexdigest(),
    )
    n_val = sum(v == "val" for v in got.values())
    assert all(got[k] == "val" for k in order[:n_val])


def test_split_needs_two_ids(spark):
    one = spark.createDataFrame([("a",)], "image_id string")
    with pytest.raises(Exception, match="at least 2"):
        splits.assign_splits(one, one.limit(0)).collect()
    with pytest.raises(ValueError):
        splits.assign_splits(one, one, 1.0)


def tree_digest(ids, digits):
    leaves = {}
    for i in sorted(ids):
        name = hashlib.sha256(i.encode()).hexdigest()[:digits]
        leaves[name] = leaves.get(name, "") + f"{i}\n"
    branches = {}
    for name in sorted(leaves):
        branch = name[: digits - digits // 2]
        branches[branch] = branches.get(branch, "") + name + hashlib.sha256(leaves[name].encode()).hexdigest()
    text = "".join(b + hashlib.sha256(branches[b].encode()).hexdigest() for b in sorted(branches))
    return hashlib.sha256(text.encode()).hexdigest()


def test_list_digest_has_one_rule(spark):
    ids = [f"i{k:03d}" for k in range(200)]
    members = spark.createDataFrame([("train", i) for i in reversed(ids)], "split string, image_id string")
    for digits in (1, 2, 4):
        row = fingerprint.split_hash(members, digits).head()
        assert row.n == 200 and row.digest == tree_digest(ids, digits)
        assert fingerprint.split_hash(members.repartition(5), digits).head() == row
    other = members.withColumn("image_id", F.regexp_replace("image_id", "i199", "i999"))
    assert fingerprint.split_hash(other).head().digest != fingerprint.split_hash(members).head().digest


def test_list_digest_of_many_ids(spark):
    ids = spark.range(70_000).select(F.lit("train").alias("split"), F.col("id").cast("string").alias("image_id"))
    assert fingerprint.split_hash(ids).head().digest == tree_digest([str(i) for i in range(70_000)], 4)


def test_file_digest(spark):
    ids = [f"i{k:03d}" for k in range(200)]
    members = spark.createDataFrame([("train", i) for i in reversed(ids)], "split string, image_id string")
    assert fingerprint.file_digest(members).head().digest == hashlib.sha256("".join(f"{i}\n" for i in ids).encode()).hexdigest()
    with pytest.raises(Exception, match="at most 100"):
        fingerprint.file_digest(members, most=100).collect()


def test_annotation_size_limit(spark, tmp_path):
    text = document("a", 10, ("x", 1, 1, 5, 5, 0, 0))
    (tmp_path / "a.xml").write_text(text)
    one = spark.createDataFrame([("a", text)], "image_id string, xml string")
    for limit, reason, n in ((len(text), None, 1), (len(text) - 1, "too_large", None)):
        for found in (voc.parse_voc(one, max_bytes=limit), voc.read_voc(spark, str(tmp_path), max_bytes=limit)):
            row = found.head()
            assert row.reject_reason == reason and (row.objects and len(row.objects)) == n
    # The default is the reference's: just below and just above it.
    for extra, reason in ((0, None), (1, "too_large")):
        padded = text + " " * (10 * 1024 * 1024 - len(text) + extra)
        (tmp_path / "a.xml").write_text(padded)
        one = spark.createDataFrame([("a", padded)], "image_id string, xml string")
        assert {x.head().reject_reason for x in (voc.parse_voc(one), voc.read_voc(spark, str(tmp_path)))} == {reason}


def test_file_digest_of_many_ids(spark):
    n = (1 << 20) + 1
    ids = spark.range(n + 3).select(F.expr("if(id < 3, 'val', 'train')").alias("split"), F.format_string("i%08d", "id").alias("image_id"))
    wanted = {
        s: (len(r), hashlib.sha256("".join(f"i{i:08d}\n" for i in r).encode()).hexdigest())
        for s, r in (("val", range(3)), ("train", range(3, n + 3)))
    }
    assert {r.split: (r.n, r.digest) for r in fingerprint.file_digest(ids).collect()} == wanted


def test_few_leaves_are_streamed(spark, monkeypatch):
    ids = spark.range(70_000).select(F.lit("train").alias("split"), F.col("id").cast("string").alias("image_id"))
    # Only branches and the root are gathered, of names and hashes.
    gathered = []
    whole = fingerprint._ordered_text
    monkeypatch.setattr(fingerprint, "_ordered_text", lambda sort, text: gathered.append(str(sort)) or whole(sort, text))
    found = fingerprint.split_hash(ids, leaf_digits=1).head()
    assert found.n == 70_000 and found.digest == tree_digest([str(i) for i in range(70_000)], 1)
    assert len(gathered) == 2 and not any("_sort" in g for g in gathered)


def test_fingerprint_is_canonical_json(spark):
    hashes = spark.createDataFrame([("train", "1"), ("val", "2"), ("test", "3")], "split string, digest string")
    value = {
        "conversion": {"a": None, "é": "ü", "z": True},
        "source_archive_sha256": "s",
        "split_hashes": {"train": "1", "val": "2", "test": "3"},
    }
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    got = fingerprint.dataset_fingerprint(hashes, "s", {"z": True, "é": "ü", "a": None}).head()[0]
    # Options are sorted by code point, as in the canonical text.
    assert got == hashlib.sha256(text.encode()).hexdigest()


def test_combine_doubles_counts(spark):
    items = spark.createDataFrame(
        [("a", "train", 2), ("b", "train", 2), ("c", "val", 0), ("d", "test", 0)],
        "image_id string, split string, object_count int",
    )
    both = combine.combine_sources({"one": items, "two": items}, {"one": "real", "two": "synthetic"})
    totals = both.groupBy("split").agg(F.count("*").alias("n"), F.sum("object_count").alias("o"))
    assert {r.split: (r.n, r.o) for r in totals.collect()} == {"train": (4, 8), "val": (2, 0), "test": (2, 0)}
    assert quality.id_collisions(both).count() == 0
    with pytest.raises(ValueError):
        combine.combine_sources({"one": items, "two": items}, {"one": "A", "two": "a"})
    with pytest.raises(ValueError):
        combine.check_prefixes(["-bad"])


def test_content_leak_keeps_last_id_of_first_split(spark):
    rows = [("val", "v1", "h"), ("train", "a", "h"), ("train", "b", "h"), ("test", "t", "h"), ("test", "u", "k")]
    items = spark.createDataFrame(rows, "split string, image_id string, digest string")
    found = {tuple(r) for r in quality.content_leak(items).collect()}
    assert found == {("val", "v1", "train", "b"), ("test", "t", "train", "b")}


def test_label_rules(spark):
    text = "0 0.5 0.5 0.2 0.2\r\n\n1 0.5 0.5 0.2 0.2\n0 0.5\n0 x 0.5 0.1 0.1\n0 inf 0.5 0.1 0.1\n0 1.5 0.5 0.1 0.1"
    files = spark.createDataFrame([("a", text)], "image_id string, text string")
    boxes, issues = labels.parse_labels(files)
    assert [r.line_number for r in boxes.orderBy("line_number").collect()] == [1, 3, 7]
    assert {(r.line_number, r.rule) for r in issues.collect()} == {
        (3, "class_not_zero"), (4, "field_count"), (5, "not_numeric"), (6, "not_finite"),
        (7, "center_outside"), (7, "box_outside_image"),
    }


def test_read_label_files_and_report(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0 0.5 0.5 0.2 0.2\n")
    (tmp_path / "b.txt").write_text("")
    files = labels.read_label_files(spark, str(tmp_path))
    assert {r.image_id for r in files.collect()} == {"a", "b"}
    pictures = spark.createDataFrame([("train", "a"), ("train", "c")], "split string, image_id string")
    have = files.select(F.lit("train").alias("split"), "image_id")
    _, issues = labels.parse_labels(files)
    found = quality.validation_issues(pictures, have, issues)
    assert {(r.rule, r.image_id) for r in found.collect()} == {("missing_label", "c"), ("orphan_label", "b")}
    assert quality.validation_status(found).head().status == "fail"


def test_declarations_and_sizes(spark):
    xml = [
        ("a", "<!doctype x><annotation/>"), ("b", TINY["image001"]), ("c", None),
        ("d", TINY["image001"].replace("<width>10<", "<width>x<")),
    ]
    rows = voc.parse_voc(spark.createDataFrame(xml, "image_id string, xml string")).collect()
    assert {r.image_id: r.reject_reason for r in rows} == {
        "a": "declaration_not_allowed", "b": None, "c": "invalid_xml", "d": "invalid_dimension",
    }


def test_header_sizes():
    import struct

    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 7, 9)
    tiff = b"II*\0" + struct.pack("<IH", 8, 2) + struct.pack("<HHIHH", 256, 3, 1, 7, 0) + struct.pack("<HHII", 257, 4, 1, 9)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xc2\x00\x11\x08" + struct.pack(">HH", 9, 7) + b"\3"
    bmp = b"BM" + b"\0" * 16 + struct.pack("<ii", 7, -9)
    for data in (png, tiff, jpeg, bmp, b"P6 # c\n7 9\n255\n"):
        assert tuple(images.header_size(data)) == (7, 9)
    assert images.header_size(b"nothing") is None


def test_unclipped_boxes(spark):
    rows = spark.createDataFrame(
        [(10.0, 20.0, 30.0, 60.0, 100, 100), (80.0, 80.0, 120.0, 120.0, 100, 100),
         (95.0, 5.0, 104.0, 15.0, 100, 100), (float("nan"), 0.0, 1.0, 1.0, 10, 10), (0.0, 0.0, 1.0, 1.0, 0, 10)],
        "xmin double, ymin double, xmax double, ymax double, width int, height int",
    )
    kept = profile.normalize_boxes(rows).collect()
    assert (kept[0].x_center, kept[0].y_center, kept[0].box_width, kept[0].box_height) == (0.2, 0.4, 0.2, 0.4)
    assert (kept[1].x_center, kept[1].box_width) == (0.9, 0.2)
    reasons = [r.reject_reason for r in profile.normalize_boxes(rows, clip=False).collect()]
    assert reasons == [
        None,
        "Normalized bounding box extends outside the image",
        "Normalized bounding box extends outside the image",
        "Bounding box contains NaN or infinite coordinates",
        "Image dimensions must be positive",
    ]


def test_labels_in_parts(spark):
    n = 3000
    boxes = spark.range(n).select(
        F.lit("a").alias("image_id"), F.col("id").cast("int").alias("obj_idx"), F.lit(0).alias("class_id"),
        *[F.lit(0.5).alias(c) for c in ("x_center", "y_center", "box_width", "box_height")],
    )
    parts = profile.label_text(spark.createDataFrame([("a",), ("b",)], "image_id string"), boxes)
    rows = {(r.image_id, r.part): r.text for r in parts.collect()}
    assert sorted(rows) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    assert sum(t.count("\n") for t in rows.values()) == n and rows[("b", 0)] == ""


def test_split_lists_on_disk(spark, tmp_path):
    members = spark.createDataFrame([("train", "b"), ("train", "a"), ("val", "c")], "split string, image_id string")
    sinks.write_split_lists(members, f"{tmp_path}/lists")
    lines = split_lists.read_split_list(spark, f"{tmp_path}/lists/split=train")
    assert sorted(r.image_id for r in lines.collect()) == ["a", "b"]


def test_roots(spark):
    def paths(root, *inner):
        return [(f"{root}/{i}",) for i in inner]

    base = ("Annotations/a.xml", "JPEGImages/a.jpg", "ImageSets/Main/train.txt")
    one = spark.createDataFrame(paths("x/y", *base) + paths("z", base[0]), "path string")
    assert [tuple(r) for r in listing.discover_roots(one).collect()] == [("x/y", False, True)]
    lists = ("ImageSets/Main/trainval.txt", "ImageSets/Main/test.txt")
    two = spark.createDataFrame(paths("x/y", *base, *lists) + paths("z", *base), "path string")
    assert {tuple(r) for r in listing.discover_roots(two).collect()} == {("x/y", True, True), ("z", False, False)}


def test_combined_version(spark, tmp_path):
    rows = [("train", "a", 2), ("val", "b", 0), ("test", "c", 1)]
    items = spark.createDataFrame(rows, "split string, image_id string, object_count int")
    hashed = items.withColumns({"image_sha": F.sha2("image_id", 256), "label_sha": F.sha2("split", 256)})
    both = combination.combine_datasets(
        {"one": items, "two": hashed}, {"one": "real", "two": "synthetic"}, {"one": "a" * 64}
    )
    key, paths = combination.publish_combined(both, f"{tmp_path}/out")
    assert len(key) == 64 and spark.read.parquet(paths["items"]).count() == 6
    assert combination.publish_combined(both, f"{tmp_path}/out") == (key, paths)
    lacking = combination.combine_datasets(
        {"one": items.filter("split <> 'val'")}, {"one": "x"}, {"one": "b" * 64}
    )
    assert [(r.rule, r.split) for r in lacking.issues.collect()] == [("empty_split", "val")]
    with pytest.raises(quality.DatasetProblems):
        quality.assert_valid(lacking.issues)


def test_sources_are_checked_before_combining(spark, tmp_path):
    shape = "split string, image_id string, object_count int, image_sha string, label_sha string"
    good = [("train", "a", 1, "1" * 64, "2" * 64), ("val", "b", 0, "3" * 64, "4" * 64), ("test", "c", 1, "5" * 64, "6" * 64)]
    line = "0 0.5 0.5 0.1 0.1"
    files = [("train", "a", line), ("val", "b", ""), ("test", "c", line)]
    kinds = "split string, image_id string, text string"

    def issues(items, texts):
        one, two = spark.createDataFrame(items, shape), spark.createDataFrame(good, shape)
        given = {"one": spark.createDataFrame(texts, kinds), "two": spark.createDataFrame(files, kinds)}
        both = combination.combine_datasets({"one": one, "two": two}, {"one": "x", "two": "y"}, labels=given)
        return both, sorted((r.rule, r.split, r.image_id, r.line_number) for r in both.issues.collect())

    clean, found = issues(good, files)
    assert found == [] and combination.publish_combined(clean, f"{tmp_path}/out")[0] == clean.fingerprint.head()[0]
    wrong = [good[0], ("val", "A", 0, "7" * 64, "8" * 64), ("val", "d", 0, "9" * 64, "0" * 64), ("train", "e", 0, "b" * 64, "c" * 64), ("train", "e", 0, "b" * 64, "c" * 64)]
    texts = [("train", "a", f"{line}\n\n1 0.5 0.5 0.1 0.1"), ("val", "A", ""), ("train", "e", "0 1"), ("train", "z", "")]
    checked, found = issues(wrong, texts)
    # Both items named e have one prefixed ID.
    rules = [x for x in found if x[0] != "id_collision"]
    assert rules == [
        ("class_not_zero", "train", "a", 3), ("empty_split", "test", None, None), ("field_count", "train", "e", 1), ("missing_label", "val", "d", None),
        ("orphan_label", "train", "z", None), ("repeated_id", "train", "e", None), ("repeated_id", "val", "A", None),
    ]
    with pytest.raises(quality.DatasetProblems):
        combination.publish_combined(checked, f"{tmp_path}/out")
    one = spark.createDataFrame(good, shape)
    for trusted in ({"one": "a" * 63}, {"one": "A" * 64}, {"other": "a" * 64}):
        with pytest.raises(ValueError):
            combination.combine_datasets({"one": one}, {"one": "x"}, trusted)
    with pytest.raises(ValueError, match="label files"):
        combination.combine_datasets({"one": one}, {"one": "x"}, labels={})


def test_prints_of_sources_hashed_together_and_alone(spark):
    rows = [("train", "a", 1, "1" * 64, "2" * 64), ("val", "b", 0, "3" * 64, "4" * 64), ("test", "c", 1, "5" * 64, "6" * 64)]
    items = spark.createDataFrame(rows, "split string, image_id string, object_count int, image_sha string, label_sha string")
    other = items.withColumn("label_sha", F.sha2("image_id", 256))
    own = {n: fingerprint.content_digest(df.withColumn("source", F.lit(n))).head()["digest"] for n, df in (("one", items), ("two", other))}
    names = {"one": "x", "two": "y"}
    prints = [combination.combine_datasets({"one": items, "two": other}, names, trusted).fingerprint.head()[0] for trusted in (None, own, {"two": own["two"]})]
    assert len(set(prints)) == 1


def test_options_are_applied_or_refused():
    assert prepare.checked_options({"clip_boxes": False}, False)["clip_boxes"] is False
    for wrong in ({"target_class_id": 1}, {"keep_empty_images": False}, {"colour": 1}):
        with pytest.raises(ValueError):
            prepare.checked_options(wrong, True)


def test_keyed_issues_and_leaks_of_labelled_images(spark):
    images = spark.createDataFrame([("train", "a"), ("train", "b"), ("val", "a"), ("test", "a"), ("val", "c")], "split string, image_id string")
    have = spark.createDataFrame([("train", "a"), ("val", "a"), ("test", "a"), ("train", "b"), ("val", "x")], "split string, image_id string")
    errors = spark.createDataFrame([("train", "b", "unreadable"), ("val", "a", None)], "split string, image_id string, error string")
    found = sorted((r.rule, r.split, r.image_id) for r in quality.keyed_issues(images, have, errors).collect())
    assert found == [
        ("missing_label", "val", "c"), ("orphan_label", "val", "x"), ("split_overlap", "train", "a"), ("split_overlap", "val", "a"),
        ("split_overlap", "val", "a"), ("unreadable_image", "train", "b"),
    ]
    contents = spark.createDataFrame([("train", "a", "1"), ("val", "c", "1"), ("test", "a", "1")], "split string, image_id string, digest string")
    lines = spark.createDataFrame([], "split string, image_id string, line_number int, rule string")
    files = spark.createDataFrame([("train", "x/A.jpg"), ("train", "y/a.png"), ("val", "a.jpg")], "split string, path string")
    issues = quality.validation_issues(images, have, lines, errors, contents, files=files)
    assert {(r.rule, r.split, r.image_id) for r in issues.collect()} - set(found) == {("content_in_two_splits", "test", "a"), ("repeated_stem", "train", "a")}
    with pytest.raises(Exception, match="no such split"):
        quality.content_leak(contents.withColumn("split", F.lit("other"))).collect()


def test_every_kind_of_white_space_is_stripped(spark):
    from boxframe.functions.text import strip

    blanks = [c for c in map(chr, range(0x3001)) if c.isspace()]
    rows = spark.createDataFrame([(f"{c}x{c}",) for c in blanks], "t string")
    assert {r[0] for r in rows.select(strip(F.col("t"))).collect()} == {"x"}


def test_leaks_of_unlabelled_images_are_found(spark):
    images = spark.createDataFrame([("train", "a"), ("val", "c")], "split string, image_id string")
    contents = spark.createDataFrame([("train", "a", "1"), ("val", "c", "1")], "split string, image_id string, digest string")
    lines = spark.createDataFrame([], "split string, image_id string, line_number int, rule string")
    issues = quality.validation_issues(images, images.filter("image_id = 'a'"), lines, contents=contents, unlabelled=True)
    assert [(r.split, r.image_id) for r in issues.filter("rule = 'content_in_two_splits'").collect()] == [("val", "c")]
    from boxframe.plans.catalog import ORACLES

    # The query's check counts them, too.
    assert "EXISTS" not in ORACLES["validation_report"]


def test_large_groups_are_found_by_hashes_first(spark):
    from boxframe.operators import ranking

    rows = spark.range(3000).select((F.col("id") % 300).alias("k"), F.lit(5).alias("size"))
    assert ranking.hot_keys(rows, ["k"], 50) is None
    more = rows.unionByName(rows.filter("k = 7"))
    assert [r.k for r in ranking.hot_keys(more, ["k"], 15).collect()] == [7]
    assert ranking.split_hot(rows, ["k"], 9, more.withColumn("_rows", F.lit(0)))[1] is None
    assert ranking.hot_keys(rows, ["k"], 49, F.col("size")).count() == 300


def test_ground_truth_in_one_join(spark):
    images = spark.createDataFrame([("a", "val"), ("a", "val"), ("b", "val"), ("b", "val"), ("c", "val"), ("d", "test"), ("e", "val")], "image_id string, split string")
    line = "0 0.5 0.5 0.1 0.1"
    texts = spark.createDataFrame([("a", f"{line}\r\n\r{line}"), ("a", line), ("c", ""), ("d", line), ("e", None), ("x", line)], "image_id string, text string")
    for hot_rows in (2, 1_000_000):
        found = labels.ground_truth(images, texts, "val", hot_rows=hot_rows)
        assert sorted((r.image_id, -1 if r.gt_idx is None else r.gt_idx, r.problem) for r in found.collect()) == [
            ("a", 0, None), ("a", 1, None), ("a", 2, None), ("b", -1, "missing_label"), ("b", -1, "missing_label"),
        ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 2


def test_annotations_are_checked_once(spark):
    plain = "<object><name> a </name>{}<bndbox><xmin> 1</xmin><ymin>2</ymin><xmax>3\n</xmax><ymax>4</ymax></bndbox></object>"
    document = "<annotation><filename>a b.jpg </filename><size><width>7</width><height>\t8</height></size>{}</annotation>"
    xml = [
        ("plain", document.format(plain.format("<difficult>1\n</difficult>"))),
        ("flag", document.format(plain.format("") + plain.format("<truncated>x</truncated>"))),
        ("blank flag", document.format(plain.format("<truncated> </truncated>"))),
        ("comment", document.format("<!-- <!nothing> -->")),
        ("declared", "<!dOCTYPE a>" + document.format("")),
        ("dotless", document.format("<!-- <!ENTıTY -->")),
        ("none", None),
    ]
    parsed = voc.parse_voc(spark.createDataFrame(xml, "image_id string, xml string"))
    rows = {r.image_id: r for r in parsed.collect()}
    assert {k: r.reject_reason for k, r in rows.items()} == {
        "plain": None, "flag": "invalid_truncated", "blank flag": None, "comment": None,
        "declared": "declaration_not_allowed", "dotless": "declaration_not_allowed", "none": "invalid_xml",
    }
    assert rows["plain"].filename == "a b.jpg" and (rows["plain"].width, rows["plain"].height) == (7, 8)
    objects = voc.voc_objects(parsed)
    assert sorted(tuple(r) for r in objects.collect()) == [
        ("blank flag", 0, 7, 8, "a", 1.0, 2.0, 3.0, 4.0, False, False),
        ("plain", 0, 7, 8, "a", 1.0, 2.0, 3.0, 4.0, True, False),
    ]
    # Filters take the checked rows and do not check them themselves.
    plan = objects._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("missing_bndbox") == 1
