"""Queries on boxes, text functions, profile and file contents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions import boxes as bx
from boxframe.functions import text as tx
from boxframe.operators import fingerprint, profile, quantiles
from boxframe.plans.fixtures import Inputs
from boxframe.plans.registry import query

# Pixel objects with the real image size, clipped and normalised, and the reason of a refusal.
_NORM = """WITH sized AS (
  SELECT o.*, i.width, i.height FROM fx_objects o JOIN fx_images i ON o.image_id = i.image_id),
clipped AS (
  SELECT *, least(greatest(xmin, 0), width) AS l, least(greatest(xmax, 0), width) AS r,
    least(greatest(ymin, 0), height) AS t, least(greatest(ymax, 0), height) AS b FROM sized),
norm AS (
  SELECT image_id, obj_idx, class_name, width, height,
    CASE WHEN r <= l OR b <= t THEN 'Bounding box is degenerate after clipping' END AS reject_reason,
    CASE WHEN r > l AND b > t THEN (l + r) / 2 / width END AS x_center,
    CASE WHEN r > l AND b > t THEN (t + b) / 2 / height END AS y_center,
    CASE WHEN r > l AND b > t THEN (r - l) / width END AS box_width,
    CASE WHEN r > l AND b > t THEN (b - t) / height END AS box_height
  FROM clipped)
"""


def sized_objects(inputs: Inputs) -> DataFrame:
    size = inputs.view("fx_images").select("image_id", "width", "height")
    return inputs.view("fx_objects").join(size, "image_id")


def normalized(inputs: Inputs) -> DataFrame:
    return profile.normalize_boxes(sized_objects(inputs))


def accepted(inputs: Inputs) -> DataFrame:
    good = normalized(inputs).filter("reject_reason is null")
    return profile.remap_classes(good)


_BOX = ("x_center", "y_center", "box_width", "box_height")
_BOX_SQL = ", ".join(f"round({c}, 9) AS {c}" for c in _BOX)


def _round(df: DataFrame, *names: str, digits: int = 9) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    "box_normalize",
    _NORM + f"SELECT image_id, obj_idx, {_BOX_SQL} FROM norm WHERE reject_reason IS NULL",
)
def box_normalize(inputs: Inputs) -> DataFrame:
    return _round(accepted(inputs).select("image_id", "obj_idx", *_BOX), *_BOX)


@query(
    "box_rejects",
    _NORM + "SELECT image_id, obj_idx, class_name, reject_reason FROM norm WHERE reject_reason IS NOT NULL",
)
def box_rejects(inputs: Inputs) -> DataFrame:
    bad = normalized(inputs).filter("reject_reason is not null")
    return bad.select("image_id", "obj_idx", "class_name", "reject_reason")


@query(
    "class_remap",
    """WITH mapping AS (SELECT DISTINCT class_name,
  CASE WHEN class_name LIKE 'A%' THEN 0 WHEN class_name LIKE 'N%' THEN 1 END AS class_id
  FROM fx_objects)
SELECT image_id, obj_idx, o.class_name, 0 AS single_id, class_id AS mapped_id
FROM fx_objects o JOIN mapping m ON o.class_name = m.class_name""",
)
def class_remap(inputs: Inputs) -> DataFrame:
    objects = inputs.view("fx_objects")
    name = F.col("class_name")
    # The classes in use, one row each.
    mapping = objects.select("class_name").distinct().withColumn(
        "class_id", F.when(name.like("A%"), 0).when(name.like("N%"), 1)
    )
    single = profile.remap_classes(objects).withColumnRenamed("class_id", "single_id")
    return profile.remap_classes(single, mapping).select(
        "image_id", "obj_idx", "class_name", "single_id", F.col("class_id").alias("mapped_id")
    )


_LINE = """'0 ' || printf('%.6f', x_center) || ' ' || printf('%.6f', y_center) || ' ' ||
  printf('%.6f', box_width) || ' ' || printf('%.6f', box_height)"""


@query(
    "label_line",
    _NORM + f"SELECT image_id, obj_idx, {_LINE} AS line FROM norm WHERE reject_reason IS NULL",
)
def label_line(inputs: Inputs) -> DataFrame:
    columns = [F.col(c) for c in ("class_id", *_BOX)]
    return accepted(inputs).select("image_id", "obj_idx", tx.label_line(*columns).alias("line"))


@query(
    "label_text",
    _NORM + f""", lines AS (
  SELECT image_id, obj_idx, {_LINE} || chr(10) AS line FROM norm WHERE reject_reason IS NULL)
SELECT i.image_id, 0::BIGINT AS part, coalesce(string_agg(line, '' ORDER BY obj_idx), '') AS text
FROM fx_images i LEFT JOIN lines l ON i.image_id = l.image_id GROUP BY 1""",
)
def label_text(inputs: Inputs) -> DataFrame:
    return profile.label_text(inputs.view("fx_images"), accepted(inputs))


@query(
    "dimension_check",
    """SELECT image_id, xml_width, xml_height, width, height,
  width <> xml_width OR height <> xml_height AS dimension_mismatch FROM fx_images""",
)
def dimension_check(inputs: Inputs) -> DataFrame:
    images = inputs.view("fx_images")
    return profile.check_dimensions(
        images.select("image_id", "xml_width", "xml_height"),
        images.select("image_id", "width", "height"),
    )


@query(
    "xywh_to_xyxy",
    _NORM + """SELECT image_id, obj_idx, round(x_center - box_width / 2, 9) AS x1,
  round(y_center - box_height / 2, 9) AS y1, round(x_center + box_width / 2, 9) AS x2,
  round(y_center + box_height / 2, 9) AS y2 FROM norm WHERE reject_reason IS NULL""",
)
def xywh_to_xyxy(inputs: Inputs) -> DataFrame:
    corners = bx.center_to_corners(*[F.col(c) for c in _BOX])
    named = [F.round(c, 9).alias(n) for n, c in zip(("x1", "y1", "x2", "y2"), corners)]
    return accepted(inputs).select("image_id", "obj_idx", *named)


# Valid boxes and boxes broken in each way, by a modulus of the part.
_SPOILT = """SELECT image_id, pred_idx,
  CASE WHEN pred_idx % 7 = 1 THEN CAST('NaN' AS DOUBLE) WHEN pred_idx % 7 = 2 THEN -x1 - 0.125
    ELSE x1 END AS x1, y1,
  CASE WHEN pred_idx % 7 = 3 THEN x1 WHEN pred_idx % 7 = 6 THEN CAST('Infinity' AS DOUBLE)
    ELSE x2 END AS x2, y2,
  CASE WHEN pred_idx % 7 = 4 THEN 1 ELSE 0 END AS class_id,
  CASE WHEN pred_idx % 7 = 5 THEN confidence + 1 ELSE confidence END AS confidence
FROM fx_pred"""


@query(
    "box_validity",
    f"""SELECT image_id, pred_idx,
  CASE WHEN isnan(x1) OR isinf(x2) THEN 'not_finite'
    WHEN x1 < 0 OR y1 < 0 OR x2 > 1 OR y2 > 1 THEN 'outside_unit_square'
    WHEN x2 <= x1 OR y2 <= y1 THEN 'not_positive_size'
    WHEN class_id <> 0 THEN 'class_not_zero'
    WHEN confidence < 0 OR confidence > 1 THEN 'confidence_outside_unit_interval' END AS problem,
  CASE WHEN isnan(x1) OR isinf(x2) THEN 'not_finite'
    WHEN confidence < 0 OR confidence > 1 THEN 'confidence_outside_unit_interval'
    WHEN x2 <= x1 OR y2 <= y1 THEN 'degenerate' END AS detection_problem
FROM ({_SPOILT}) AS s""",
)
def box_validity(inputs: Inputs) -> DataFrame:
    spoilt = _SPOILT.replace("FROM fx_pred", "FROM {pred}")
    rows = inputs.spark.sql(spoilt, pred=inputs.view("fx_pred"))
    corners = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    return rows.select(
        "image_id",
        "pred_idx",
        bx.box_problem(*corners, F.col("class_id"), F.col("confidence")).alias("problem"),
        bx.detection_problem(*corners, F.col("confidence")).alias("detection_problem"),
    )


@query(
    "pixel_clip",
    """WITH placed AS (
  SELECT o.*, i.width::DOUBLE AS w, i.height::DOUBLE AS h
  FROM fx_objects o JOIN fx_images i ON o.image_id = i.image_id),
low AS (SELECT *, least(greatest(xmin, 0), w - 1) AS x1, least(greatest(ymin, 0), h - 1) AS y1
  FROM placed)
SELECT image_id, obj_idx, x1, y1, least(greatest(xmax, x1 + 1), w) AS x2,
  least(greatest(ymax, y1 + 1), h) AS y2 FROM low""",
)
def pixel_clip(inputs: Inputs) -> DataFrame:
    columns = [F.col(c) for c in ("xmin", "ymin", "xmax", "ymax", "width", "height")]
    clipped = bx.clip_to_pixels(*columns)
    named = [c.alias(n) for n, c in zip(("x1", "y1", "x2", "y2"), clipped)]
    return sized_objects(inputs).select("image_id", "obj_idx", *named)


# Awkward list entries: back slashes, suffixes, blanks, folders and invalid names.
_ENTRIES = """SELECT page_id, CASE WHEN page_id % 9 = 0 THEN '..' WHEN page_id % 9 = 1 THEN url || '/'
  WHEN page_id % 9 = 2 THEN '  a\\b\\' || CAST(page_id AS STRING) || '.tar.gz '
  WHEN page_id % 9 = 3 THEN '.hidden' WHEN page_id % 9 = 4 THEN '/'
  WHEN page_id % 9 = 5 THEN 'x/' || CAST(page_id AS STRING) || '.JPG/./' ELSE url END AS entry
FROM """


@query(
    "normalize_id",
    f"""WITH entries AS ({_ENTRIES} pages),
names AS (SELECT page_id, list_extract(string_split(regexp_replace(
  replace(trim(entry), '\\', '/'), '(/\\.?)+$', ''), '/'), -1) AS name FROM entries),
stems AS (SELECT page_id, CASE WHEN length(name) > 1
  THEN substr(name, 1, 1) || regexp_replace(substr(name, 2), '\\.[^.]+$', '') ELSE name END AS stem
  FROM names)
SELECT page_id, CASE WHEN stem NOT IN ('', '.', '..') THEN stem END AS image_id FROM stems""",
)
def normalize_id(inputs: Inputs) -> DataFrame:
    entries = inputs.sql(_ENTRIES.replace("\\", "\\\\") + "{pages}")
    return entries.select("page_id", tx.normalize_id(F.col("entry")).alias("image_id"))


@query(
    "run_id",
    """SELECT event_id,
  CASE WHEN stem = '' THEN 'video' ELSE stem END || '_' || strftime(ts, '%Y%m%dT%H%M%SZ') || '_' ||
    substr(sha256(CAST(event_id AS VARCHAR)), 1, 8) AS video_run,
  prefix || '_' || strftime(ts, '%Y%m%dT%H%M%SZ') || '_' ||
    CASE WHEN event_id % 5 = 0 THEN 'nogit' ELSE substr(sha256(event_type), 1, 7) END AS train_run
FROM (SELECT *,
  regexp_replace(regexp_replace(regexp_replace(CASE WHEN event_id % 9 = 0 THEN '___' ELSE
    event_type || ' (' || user_id || ').v' END, '[^A-Za-z0-9_-]+', '_', 'g'), '^_+', ''), '_+$', '')
    AS stem,
  regexp_replace(regexp_replace(regexp_replace('.' || event_type || '/' || user_id || '-',
    '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+', ''), '[._-]+$', '') AS prefix
  FROM events) AS e""",
)
def run_id(inputs: Inputs) -> DataFrame:
    events = inputs.table("events")
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    stem = F.when(F.col("event_id") % 9 == 0, "___").otherwise(
        F.concat(kind, F.lit(" ("), user, F.lit(").v"))
    )
    prefix = F.concat(F.lit("."), kind, F.lit("/"), user, F.lit("-"))
    commit = F.when(F.col("event_id") % 5 != 0, F.sha2(kind, 256))
    sha = F.sha2(F.col("event_id").cast("string"), 256)
    return events.select(
        "event_id",
        tx.video_run_id(stem, F.col("ts"), sha).alias("video_run"),
        tx.training_run_id(prefix, F.col("ts"), commit).alias("train_run"),
    )


@query(
    "fourcc",
    """SELECT event_id, CASE WHEN code = 0 THEN NULL ELSE
  chr(CAST(97 + event_id % 26 AS INT)) || chr(CAST(97 + user_id % 26 AS INT)) ||
  CASE WHEN event_id % 4 = 0 THEN '' ELSE 'c1' END END AS codec
FROM (SELECT *, CASE WHEN event_id % 10 = 0 THEN 0 ELSE 1 END AS code FROM events) AS e""",
)
def fourcc(inputs: Inputs) -> DataFrame:
    events = inputs.table("events")
    letters = (97 + F.col("event_id") % 26) + 256 * (97 + F.col("user_id") % 26)
    tail = F.when(F.col("event_id") % 4 == 0, 0).otherwise((ord("c") << 16) + (ord("1") << 24))
    code = F.when(F.col("event_id") % 10 == 0, 0).otherwise(letters + tail)
    return events.select("event_id", tx.fourcc(code.cast("int")).alias("codec"))


@query("utc_format", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at_utc FROM events")
def utc_format(inputs: Inputs) -> DataFrame:
    return inputs.table("events").select("event_id", tx.utc_seconds(F.col("ts")).alias("at_utc"))


_REDACT_SOURCE = """CASE WHEN doc_id % 3 = 0 THEN
  replace(text, 'token =', 'GH_TOKEN =') || ' kaggle_key=abc' || CAST(doc_id AS STRING) || '; secretvalue9 done'
  ELSE text END"""


@query(
    "redact_text",
    f"""SELECT doc_id, regexp_replace(replace(replace({_REDACT_SOURCE}, 'secretvalue9', '[REDACTED]'),
  'secret', '[REDACTED]'), '\\b(KAGGLE_KEY|GH_TOKEN|token)\\s*=\\s*([^\\s,;]+)', '\\1=[REDACTED]', 'gi')
  AS text FROM documents""",
)
def redact_text(inputs: Inputs) -> DataFrame:
    documents = inputs.table("documents").select("doc_id", F.expr(_REDACT_SOURCE).alias("text"))
    clean = tx.redact(F.col("text"), (*tx.SECRET_NAMES, "token"), ["secret", "secretvalue9"])
    return documents.select("doc_id", clean.alias("text"))


@query(
    "class_names",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'object' WHEN 2 THEN event_type
  ELSE CAST(event_id % 4 AS VARCHAR) END AS class_name FROM events""",
)
def class_names(inputs: Inputs) -> DataFrame:
    kind = F.col("event_type")
    names = F.create_map(F.lit("0"), F.lit("object"), F.lit("2"), kind, F.lit("x1"), F.lit("no"))
    class_id = (F.col("event_id") % 4).cast("int")
    return inputs.table("events").select(
        "event_id", tx.class_name(tx.numeric_names(names), class_id).alias("class_name")
    )


_EXPECTED = """CASE WHEN doc_id % 5 = 0 THEN 'short' WHEN doc_id % 5 = 1 THEN upper(sha) || ' '
  WHEN doc_id % 5 = 2 THEN substr(sha, 2, 63) || substr(sha, 1, 1) ELSE sha END"""


@query(
    "digest_verify",
    f"""WITH d AS (SELECT doc_id, sha256(text) AS sha FROM documents),
e AS (SELECT *, {_EXPECTED} AS expected FROM d)
SELECT doc_id, doc_id % 5 <> 0 AS well_formed,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lower(trim(expected)) = sha END AS matches FROM e""",
)
def digest_verify(inputs: Inputs) -> DataFrame:
    docs = fingerprint.content_sha(inputs.table("documents").select("doc_id", "text"), "text", "sha")
    checked = docs.withColumn("expected", F.expr(_EXPECTED))
    return fingerprint.verify_digests(checked, "sha", "expected").select(
        "doc_id", "well_formed", "matches"
    )


@query("content_sha", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_sha(inputs: Inputs) -> DataFrame:
    docs = inputs.table("documents").select("doc_id", "text")
    return fingerprint.content_sha(docs, "text").drop("text")


@query(
    "split_stats",
    _NORM + """, n AS (SELECT image_id, count(*) AS n FROM norm WHERE reject_reason IS NULL GROUP BY 1)
SELECT split, count(*) AS images, CAST(sum(coalesce(n, 0)) AS BIGINT) AS objects,
  count(*) FILTER (WHERE n IS NULL) AS empty_images
FROM fx_images i LEFT JOIN n ON i.image_id = n.image_id GROUP BY 1""",
)
def split_stats(inputs: Inputs) -> DataFrame:
    return profile.split_stats(inputs.view("fx_images"), accepted(inputs))


@query(
    "category_counts",
    "SELECT class_name, count(*) AS objects FROM fx_objects GROUP BY 1",
)
def category_counts(inputs: Inputs) -> DataFrame:
    return profile.category_counts(inputs.view("fx_objects"))


@query(
    "repair_counts",
    _NORM + """SELECT (SELECT count(*) FROM fx_images WHERE width <> xml_width OR height <> xml_height)
  AS dimension_mismatches, (SELECT count(reject_reason) FROM norm) AS rejected_objects""",
)
def repair_counts(inputs: Inputs) -> DataFrame:
    images = inputs.view("fx_images")
    checked = profile.check_dimensions(
        images.select("image_id", "xml_width", "xml_height"),
        images.select("image_id", "width", "height"),
    )
    return profile.repair_counts(checked, normalized(inputs))


@query(
    "area_buckets",
    _NORM + """SELECT count(*) FILTER (WHERE a <= 0.01) AS small,
  count(*) FILTER (WHERE a > 0.01 AND a <= 0.1) AS medium, count(*) FILTER (WHERE a > 0.1) AS large
FROM (SELECT box_width * box_height AS a FROM norm WHERE reject_reason IS NULL)""",
)
def area_buckets(inputs: Inputs) -> DataFrame:
    return profile.area_buckets(accepted(inputs))


_MEASURES = ("area", "box_width", "box_height")
_STATS = ("minimum", "maximum", "mean", "median", "p95")


_DISTRIBUTION = (
    _NORM
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, count(v) AS n, round(min(v), 6) AS minimum,
  round(max(v), 6) AS maximum, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median,
  round(quantile_cont(v, 0.95), 6) AS p95
FROM (SELECT {e} AS v FROM norm WHERE reject_reason IS NULL)"""
        for m, e in (
            ("area", "box_width * box_height"),
            ("box_width", "box_width"),
            ("box_height", "box_height"),
        )
    )
)


@query("distribution", _DISTRIBUTION)
def distribution(inputs: Inputs) -> DataFrame:
    rows = accepted(inputs).withColumn("area", F.col("box_width") * F.col("box_height"))
    return _round(quantiles.distribution(rows, list(_MEASURES)), *_STATS, digits=6)


@query("distribution_bracketed", _DISTRIBUTION)
def distribution_bracketed(inputs: Inputs) -> DataFrame:
    """The same figures with every measure's group taken as a large one."""
    rows = accepted(inputs).withColumn("area", F.col("box_width") * F.col("box_height"))
    return _round(quantiles.distribution(rows, list(_MEASURES), hot_rows=100), *_STATS, digits=6)


@query(
    "distribution_by_split",
    """SELECT split, 'image_width' AS measure, count(*) AS n, min(width)::DOUBLE AS minimum,
  max(width)::DOUBLE AS maximum, round(avg(width), 6) AS mean, quantile_cont(width, 0.5)::DOUBLE AS median,
  round(quantile_cont(width, 0.95)::DOUBLE, 6) AS p95 FROM fx_images GROUP BY 1""",
)
def distribution_by_split(inputs: Inputs) -> DataFrame:
    images = inputs.view("fx_images").withColumnRenamed("width", "image_width")
    rows = quantiles.distribution(images, ["image_width"], ["split"])
    return _round(rows, "mean", "p95", digits=6)
