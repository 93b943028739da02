"""Queries on file formats: annotations, labels, images, listings, results and JSON."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.operators.checkpoints import checkpoint_folder
from boxframe.plans.fixtures import Inputs
from boxframe.plans.registry import query
from boxframe.sinks import file_sink
from boxframe.sources import images, labels, listing, manifests, predictions, voc

# How document kind 0 to 11 departs from a plain annotation with one object.
_XML = """CASE WHEN kind = 1 THEN '<!DOCTYPE annotation [<!entity a "b">]>' ELSE '' END || '<annotation>' ||
CASE WHEN kind = 8 THEN '<filename> </filename>' ELSE '<filename> ' || image_id || '.jpg </filename>' END ||
CASE WHEN kind = 2 THEN '' ELSE '<size><width>' ||
  CASE WHEN kind = 3 THEN 'wide' WHEN kind = 4 THEN '0' ELSE CAST(w AS STRING) END ||
  '</width><height>' || CAST(h AS STRING) || '</height>' ||
  CASE WHEN kind = 11 THEN '' ELSE '<depth>3</depth>' END || '</size>' END ||
CASE WHEN kind = 0 THEN '' ELSE '<object><name>' || name || '</name><difficult>' ||
  CAST(n % 2 AS STRING) || '</difficult>' ||
  CASE WHEN kind = 5 THEN '' ELSE '<bndbox><xmin>' || CASE WHEN kind = 6 THEN 'NaN' ELSE CAST(x AS STRING) END ||
  '.5</xmin><ymin>' || CAST(y AS STRING) || '</ymin><xmax>' || CAST(x + q AS STRING) || '</xmax><ymax>' ||
  CAST(y + n AS STRING) || '</ymax></bndbox>' END || '</object>' END ||
CASE WHEN kind = 9 THEN '<object><name>wire</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object>' ELSE '' END ||
CASE WHEN kind = 7 THEN '<object>' ELSE '</annotation>' END"""

_XML_REASON = """CASE kind WHEN 1 THEN 'declaration_not_allowed' WHEN 2 THEN 'missing_size'
  WHEN 3 THEN 'invalid_dimension' WHEN 4 THEN 'non_positive_dimension' WHEN 5 THEN 'missing_bndbox'
  WHEN 6 THEN 'invalid_coordinate' WHEN 7 THEN 'invalid_xml' WHEN 8 THEN 'missing_filename' END"""


def _annotations(inputs: Inputs) -> DataFrame:
    documents = inputs.view("fx_documents").select("image_id", F.expr(_XML).alias("xml"))
    return voc.parse_voc(documents)


@query(
    "voc_parse",
    f"""SELECT image_id, CASE WHEN r IS NULL THEN image_id || '.jpg' END AS filename,
  CASE WHEN r IS NULL THEN CAST(w AS INTEGER) END AS width,
  CASE WHEN r IS NULL THEN CAST(h AS INTEGER) END AS height,
  CASE WHEN r IS NULL AND kind <> 11 THEN 3 END AS depth,
  CASE WHEN r IS NULL THEN CASE kind WHEN 0 THEN 0 WHEN 9 THEN 2 ELSE 1 END END AS n_objects,
  r AS reject_reason FROM (SELECT *, {_XML_REASON} AS r FROM fx_documents) AS d""",
)
def voc_parse(inputs: Inputs) -> DataFrame:
    return _annotations(inputs).select(
        "image_id",
        "filename",
        "width",
        "height",
        "depth",
        F.size("objects").alias("n_objects"),
        "reject_reason",
    ).withColumn("n_objects", F.when(F.col("reject_reason").isNull(), F.col("n_objects")))


@query(
    "voc_objects",
    f"""WITH d AS (SELECT *, {_XML_REASON} AS r FROM fx_documents)
SELECT image_id, 0 AS obj_idx, name AS class_name, x + 0.5::DOUBLE AS xmin, y::DOUBLE AS ymin,
  (x + q)::DOUBLE AS xmax, (y + n)::DOUBLE AS ymax, n % 2 = 1 AS difficult, false AS truncated
FROM d WHERE r IS NULL AND kind <> 0
UNION ALL SELECT image_id, 1, 'wire', 1, 2, 3, 4, false, false FROM d WHERE r IS NULL AND kind = 9""",
)
def voc_objects(inputs: Inputs) -> DataFrame:
    return voc.voc_objects(_annotations(inputs)).drop("width", "height")


_HEX = "'89504E470D0A1A0A0000000D49484452'"
_BYTES = f"""CASE WHEN image_id % 5 = 0 THEN encode('P3\\n# made\\n' || CAST(width AS STRING) || ' ' || CAST(height AS STRING) || '\\n255\\n', 'UTF-8')
WHEN image_id % 5 = 1 THEN unhex({_HEX} || lpad(hex(width), 8, '0') || lpad(hex(height), 8, '0') || '0802000000')
WHEN image_id % 5 = 2 THEN unhex('FFD8FFE000104A46494600010100000100010000FFC0001108' || lpad(hex(height), 4, '0') || lpad(hex(width), 4, '0') || '03012200')
WHEN image_id % 5 = 3 THEN unhex('4D4D002A000000080002010000040000' || '0001' || lpad(hex(width), 8, '0') || '0101000300000001' || lpad(hex(height), 4, '0') || '000000000000')
WHEN image_id % 10 = 4 THEN encode('no image', 'UTF-8')
ELSE unhex('424D' || repeat('00', 16) || substr(lpad(hex(width), 4, '0'), 3, 2) || substr(lpad(hex(width), 4, '0'), 1, 2) || '0000' || substr(lpad(hex(height), 4, '0'), 3, 2) || substr(lpad(hex(height), 4, '0'), 1, 2) || '0000') END"""


@query(
    "image_meta",
    """SELECT image_id, CASE WHEN image_id % 10 <> 4 THEN width END AS width,
  CASE WHEN image_id % 10 <> 4 THEN height END AS height,
  CASE WHEN image_id % 10 = 4 THEN 'unreadable' END AS error FROM fx_images""",
)
def image_meta(inputs: Inputs) -> DataFrame:
    files = inputs.view("fx_images").select("image_id", F.expr(_BYTES).alias("content"))
    return images.image_meta(files, "image_id")


# One file a part: an empty one, broken and plain lines, windows line ends.
_PART_TEXT = """CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '0 abc 0.5 0.1 0.1' || chr(10)
  WHEN 2 THEN '0 0.5 0.5 0.25 0.125' || chr(13) || chr(10) || '1 0.5 0.5 0.1 0.1'
  WHEN 3 THEN chr(10) || '0 0.5 1.5 0.1 0.1' ELSE '0 0.5 0.5 0.0 0.' || CAST(p_partkey AS STRING) END"""


@query(
    "label_files",
    """SELECT CAST(p_partkey AS STRING) AS image_id, CASE p_partkey % 5 WHEN 0 THEN 0 WHEN 2 THEN 2 ELSE 1 END AS n_lines,
  CASE p_partkey % 5 WHEN 1 THEN 'not_numeric' WHEN 2 THEN 'class_not_zero' WHEN 3 THEN 'center_outside,box_outside_image'
    WHEN 4 THEN 'size_outside' END AS rules FROM part""",
)
def label_files(inputs: Inputs) -> DataFrame:
    """Label texts written as files by all tasks, then read, cut and checked; an empty file keeps its row."""
    folder = f"{checkpoint_folder(inputs.spark).rstrip('/')}/labels-{uuid.uuid4().hex}"
    key = F.col("p_partkey").cast("string")
    # 256 folders, so that listing them is spread as well.
    name = F.concat(F.substring(F.sha2(key, 256), 1, 2), F.lit("/"), key, F.lit(".txt"))
    file_sink.write_named_texts(inputs.table("part").select(name.alias("name"), F.expr(_PART_TEXT).alias("text")), folder)
    return labels.file_reports(labels.read_label_folders(inputs.spark, folder))


_STEM = """lower(regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]+$', ''))"""
_IS_IMAGE = "lower(path) SIMILAR TO '.*\\.(jpg|jpeg|png|bmp|tif|tiff|ppm)'"


@query(
    "image_index",
    f"""SELECT {_STEM} AS stem_key, count(*) AS n_paths, min(path) AS first_path, max(path) AS last_path
FROM fx_paths WHERE {_IS_IMAGE} GROUP BY 1""",
)
def image_index(inputs: Inputs) -> DataFrame:
    return listing.image_index(inputs.view("fx_paths"))


@query(
    "duplicate_stems",
    f"""WITH s AS (SELECT split, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]+$', '') AS stem,
  count(*) AS n FROM fx_paths GROUP BY 1, 2)
SELECT split, lower(stem) AS stem_key, CAST(sum(n) AS BIGINT) AS n_files, bool_or(n > 1) AS exact_duplicate
FROM s GROUP BY 1, 2 HAVING sum(n) > 1""",
)
def duplicate_stems(inputs: Inputs) -> DataFrame:
    return listing.duplicate_stems(inputs.view("fx_paths"))


_NOTED = """SELECT 'd' || CAST(doc_id AS STRING) AS image_id,
  CASE WHEN doc_id % 6 = 0 THEN 'd' || CAST(doc_id + 2 AS STRING) || '.gone'
    WHEN doc_id % 6 = 1 THEN '' WHEN doc_id % 6 = 2 THEN 'd' || CAST(doc_id AS STRING) || '.png'
    WHEN doc_id % 6 = 3 THEN 'none.jpg'
    ELSE 'D' || CAST(doc_id AS STRING) || '.x' END AS filename
FROM """


@query(
    "resolve_images",
    f"""WITH a AS ({_NOTED} documents),
x AS (SELECT {_STEM} AS k, path, regexp_extract(path, '([^/]*)$', 1) AS name FROM fx_paths WHERE {_IS_IMAGE}),
exact AS (SELECT regexp_extract(path, '([^/]*)$', 1) AS name, min(path) AS path FROM fx_paths GROUP BY 1),
found AS (SELECT a.image_id, a.filename, x.path FROM a JOIN x ON x.k = lower(a.image_id)
  OR (a.filename <> '' AND x.k = lower(regexp_replace(a.filename, '\\.[^.]+$', '')))),
n AS (SELECT image_id, count(path) AS n, min(path) AS path FROM found GROUP BY 1)
SELECT a.image_id, a.filename, CASE WHEN e.path IS NOT NULL THEN e.path WHEN n.n = 1 THEN n.path END
  AS image_path, CASE WHEN e.path IS NOT NULL THEN 1 ELSE coalesce(n.n, 0) END AS n_found
FROM a LEFT JOIN exact e ON a.filename <> '' AND e.name = a.filename LEFT JOIN n ON n.image_id = a.image_id""",
)
def resolve_images(inputs: Inputs) -> DataFrame:
    return listing.resolve_images(inputs.sql(_NOTED + "{documents}"), inputs.view("fx_paths"))


@query(
    "discover_roots",
    """WITH p AS (SELECT regexp_extract(path, '^(data/[^/]+)/', 1) AS root,
  substr(path, length(regexp_extract(path, '^(data/[^/]+)/', 1)) + 2) AS i FROM fx_root_paths),
c AS (SELECT root, bool_or(i = 'ImageSets/Main/trainval.txt') AND bool_or(i = 'ImageSets/Main/test.txt')
  AS has_split_files FROM p GROUP BY 1 HAVING bool_or(i LIKE 'Annotations/%') AND
  bool_or(i LIKE 'JPEGImages/%') AND bool_or(i LIKE 'ImageSets/Main/%'))
SELECT root, has_split_files, (SELECT count(*) FROM c) = 1 OR
  (has_split_files AND (SELECT count(*) FROM c WHERE has_split_files) = 1) AS chosen FROM c""",
)
def discover_roots(inputs: Inputs) -> DataFrame:
    return listing.discover_roots(inputs.view("fx_root_paths"))


_LINES = """WITH raw AS (SELECT image_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1)::INTEGER AS line_number FROM fx_label_files),
f AS (SELECT image_id, line_number, regexp_split_to_array(trim(line), '\\s+') AS f FROM raw
  WHERE trim(line) <> ''),
n AS (SELECT image_id, line_number, len(f) AS k, TRY_CAST(f[1] AS INTEGER) AS class_id,
  TRY_CAST(f[2] AS DOUBLE) AS x_center, TRY_CAST(f[3] AS DOUBLE) AS y_center,
  TRY_CAST(f[4] AS DOUBLE) AS box_width, TRY_CAST(f[5] AS DOUBLE) AS box_height FROM f),
t AS (SELECT *, class_id IS NOT NULL AND x_center IS NOT NULL AND y_center IS NOT NULL AND
    box_width IS NOT NULL AND box_height IS NOT NULL AS numeric FROM n),
c AS (SELECT *, k = 5 AND numeric AND isfinite(x_center) AND isfinite(y_center) AND
    isfinite(box_width) AND isfinite(box_height) AS counted FROM t)
"""


@query(
    "label_parse",
    _LINES + """SELECT image_id, line_number, 'field_count' AS rule FROM c WHERE k <> 5
UNION ALL SELECT image_id, line_number, 'not_numeric' FROM c WHERE k = 5 AND NOT numeric
UNION ALL SELECT image_id, line_number, 'not_finite' FROM c WHERE k = 5 AND numeric AND NOT counted
UNION ALL SELECT image_id, line_number, 'class_not_zero' FROM c WHERE counted AND class_id <> 0
UNION ALL SELECT image_id, line_number, 'center_outside' FROM c WHERE counted AND
  NOT (x_center BETWEEN 0 AND 1 AND y_center BETWEEN 0 AND 1)
UNION ALL SELECT image_id, line_number, 'size_outside' FROM c WHERE counted AND
  NOT (box_width > 0 AND box_width <= 1 AND box_height > 0 AND box_height <= 1)
UNION ALL SELECT image_id, line_number, 'box_outside_image' FROM c WHERE counted AND (
  x_center - box_width / 2 < -1e-6 OR x_center + box_width / 2 > 1 + 1e-6 OR
  y_center - box_height / 2 < -1e-6 OR y_center + box_height / 2 > 1 + 1e-6)""",
)
def label_parse(inputs: Inputs) -> DataFrame:
    return labels.parse_labels(inputs.view("fx_label_files"))[1]


@query(
    "label_boxes",
    _LINES + """SELECT image_id, line_number, class_id, x_center, y_center, box_width, box_height
FROM c WHERE counted""",
)
def label_boxes(inputs: Inputs) -> DataFrame:
    return labels.parse_labels(inputs.view("fx_label_files"))[0]


@query(
    "label_strict",
    _LINES + """, b AS (SELECT *, x_center - box_width / 2 AS x1, y_center - box_height / 2 AS y1,
  x_center + box_width / 2 AS x2, y_center + box_height / 2 AS y2 FROM c)
SELECT CASE WHEN k <> 5 THEN 'field_count' WHEN NOT numeric THEN 'not_numeric'
  WHEN NOT counted THEN 'not_finite' WHEN x1 < 0 OR y1 < 0 OR x2 > 1 OR y2 > 1 THEN 'outside_unit_square'
  WHEN x2 <= x1 OR y2 <= y1 THEN 'not_positive_size' WHEN class_id <> 0 THEN 'class_not_zero' END
  AS problem, count(*) AS n FROM b GROUP BY 1""",
)
def label_strict(inputs: Inputs) -> DataFrame:
    lines = labels.label_lines(inputs.view("fx_label_files"))
    return labels.strict_boxes(lines).groupBy("problem").agg(F.count("*").alias("n"))


# Images with a label file, empty or not, and images without one.
_LABELLED_IMAGES = """SELECT DISTINCT image_id, 'val' AS split FROM {fx_label_files}
UNION ALL SELECT CAST(o_orderkey AS STRING) AS image_id, 'val' AS split FROM {orders}"""


@query(
    "eval_ground_truth",
    _LINES + f""", v AS ({_LABELLED_IMAGES.replace("{", "").replace("}", "")}),
o AS (SELECT *, x_center - box_width / 2 AS x1, y_center - box_height / 2 AS y1,
  x_center + box_width / 2 AS x2, y_center + box_height / 2 AS y2 FROM c),
b AS (SELECT *, CASE WHEN k <> 5 THEN 'field_count' WHEN NOT numeric THEN 'not_numeric'
  WHEN NOT counted THEN 'not_finite' WHEN x1 < 0 OR y1 < 0 OR x2 > 1 OR y2 > 1 THEN 'outside_unit_square'
  WHEN x2 <= x1 OR y2 <= y1 THEN 'not_positive_size' WHEN class_id <> 0 THEN 'class_not_zero' END AS problem FROM o),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY image_id ORDER BY line_number NULLS FIRST, x1 NULLS FIRST,
  y1 NULLS FIRST, x2 NULLS FIRST, y2 NULLS FIRST, class_id NULLS FIRST, problem NULLS FIRST) - 1 AS INTEGER) AS gt_idx
  FROM b)
SELECT image_id, gt_idx, round(x1, 9) AS x1, round(y1, 9) AS y1, round(x2, 9) AS x2, round(y2, 9) AS y2,
  class_id, problem FROM r WHERE image_id IN (SELECT image_id FROM v)
UNION ALL SELECT image_id, NULL, NULL, NULL, NULL, NULL, NULL, 'missing_label' FROM v
WHERE image_id NOT IN (SELECT image_id FROM fx_label_files)""",
)
def eval_ground_truth(inputs: Inputs) -> DataFrame:
    files = inputs.view("fx_label_files")
    images = inputs.spark.sql(_LABELLED_IMAGES, fx_label_files=files, orders=inputs.table("orders"))
    rows = labels.ground_truth(images, files, "val")
    return rows.withColumns({c: F.round(c, 9) for c in ("x1", "y1", "x2", "y2")})


@query(
    "eval_images",
    """WITH b AS (SELECT image_id, count(*) AS n FROM fx_gt GROUP BY 1)
SELECT i.image_id, coalesce(n, 0) AS n_boxes FROM fx_images i LEFT JOIN b ON i.image_id = b.image_id
WHERE split = 'val'""",
)
def eval_images(inputs: Inputs) -> DataFrame:
    return labels.evaluation_images(inputs.view("fx_images"), inputs.view("fx_gt"), "val")


_PROPS = """CASE WHEN event_id % 7 = 0 THEN '[' || props || ']' WHEN event_id % 11 = 0 THEN
  substr(props, 1, 4) WHEN event_id % 13 = 0 THEN '{"other": "é"}' ELSE props END"""


@query(
    "manifest_scan",
    """SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL
  ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS k,
  CASE WHEN event_id % 7 = 0 THEN 'not_an_object' WHEN event_id % 11 = 0 THEN 'unreadable' END AS problem,
  CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 = 0 THEN 'k' END AS missing_key
FROM events""",
)
def manifest_scan(inputs: Inputs) -> DataFrame:
    documents = inputs.table("events").select("event_id", F.expr(_PROPS).alias("json"))
    parsed = manifests.parse_json(documents, "json", "k bigint, _corrupt_record string")
    fine = F.col("problem").isNull()
    return parsed.select(
        "event_id",
        F.when(fine, F.col("doc.k")).alias("k"),
        "problem",
        F.when(fine, manifests.required(F.col("doc"), "k")).alias("missing_key"),
    )


def _raw_results(inputs: Inputs) -> DataFrame:
    """Two boxes per result; kind 0 has none, kinds 1 to 4 are broken in one way each."""
    rows = inputs.view("fx_results")
    a, b, conf, kind = (F.col(c) for c in ("a", "b", "conf", "kind"))
    first = F.array(a, b, a + 0.25, b + 0.25)
    second = F.when(kind == 1, F.array(a, b, a + 0.125)).otherwise(F.array(b, a, b + 0.125, a + 0.125))
    speed = F.create_map(F.lit("preprocess"), a * 8, F.lit("inference"), b * 16 + 1)
    partial = F.create_map(F.lit("inference"), b * 16 + 1)
    return rows.select(
        F.concat_ws("_", "image_id", "n", "p", "s").alias("image_id"),
        F.when(kind != 0, F.array(first, second)).alias("xyxyn"),
        F.when(kind == 2, F.array(conf))
        .when(kind == 4, F.array(conf, F.lit(float("nan"))))
        .when(kind != 0, F.array(conf, conf / 2))
        .alias("conf"),
        F.when(kind != 0, F.array(F.lit(0.0), F.lit(1.0))).alias("cls"),
        F.when(kind == 5, partial).when(kind != 3, speed).alias("speed"),
    )


_RESULT_ID = "image_id || '_' || n || '_' || p || '_' || s AS image_id"
_RESULT_PROBLEM = """CASE kind WHEN 1 THEN 'box_arity' WHEN 2 THEN 'uneven_arrays'
  WHEN 3 THEN 'missing_timing' WHEN 4 THEN 'not_numeric' END"""


@query(
    "explode_predictions",
    f"""SELECT {_RESULT_ID}, 0 AS pred_idx, a AS x1, b AS y1, a + 0.25 AS x2, b + 0.25 AS y2,
  0 AS class_id, conf AS confidence FROM fx_results WHERE kind > 4
UNION ALL SELECT {_RESULT_ID}, 1, b, a, b + 0.125, a + 0.125, 1, conf / 2 FROM fx_results WHERE kind > 4""",
)
def explode_predictions(inputs: Inputs) -> DataFrame:
    return predictions.explode_predictions(_raw_results(inputs))


@query(
    "result_checks",
    f"SELECT {_RESULT_ID}, {_RESULT_PROBLEM} AS problem FROM fx_results",
)
def result_checks(inputs: Inputs) -> DataFrame:
    return predictions.check_results(_raw_results(inputs)).select("image_id", "problem")


@query(
    "stage_timings",
    f"""SELECT {_RESULT_ID}, CASE WHEN kind = 5 THEN 0 ELSE a * 8 END AS preprocess_ms,
  b * 16 + 1 AS inference_ms, 0.0::DOUBLE AS postprocess_ms FROM fx_results WHERE kind <> 3""",
)
def stage_timings(inputs: Inputs) -> DataFrame:
    return predictions.stage_timings(_raw_results(inputs))


_INVENTORY = """SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'x, ' ELSE CAST(s_suppkey AS STRING) || ', ' END ||
  s_name || ', ' || CAST(s_nationkey * 1024 AS STRING) ||
  CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE ', 550.' || CAST(s_nationkey AS STRING) END AS line FROM """


@query(
    "inventory_lines",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey AS INTEGER) END AS device_index,
  s_name AS device_name, CAST(s_nationkey * 1024 AS INTEGER) AS memory_mib,
  CASE WHEN s_suppkey % 7 <> 0 THEN '550.' || s_nationkey END AS driver_version,
  CASE WHEN s_suppkey % 7 = 0 THEN 'field_count' WHEN s_suppkey % 5 = 0 THEN 'not_numeric' END AS problem
FROM supplier""",
)
def inventory_lines(inputs: Inputs) -> DataFrame:
    return labels.inventory_lines(inputs.sql(_INVENTORY + "{supplier}")).drop("line")
