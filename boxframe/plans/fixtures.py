"""Box, frame and file inputs derived from the star-schema tables.

The tables hold no boxes, so these views make some. Each is one SQL text that Spark and the checking
engine both run; coordinates are multiples of 1/64 or 1/256 and so exact in both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.operators.ranking import HOT_ROWS, grouped_row_number

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@dataclass(frozen=True)
class Numbered:
    """A view whose rows are numbered from 0 within a key.

    ``levels`` never decrease along ``order``; they cut a key that holds very many rows.
    """

    rows: str
    key: str
    order: str
    levels: tuple[str, ...]
    number: str
    columns: str

    def as_sql(self) -> str:
        return (
            f"SELECT {self.columns}, CAST(row_number() OVER (PARTITION BY {self.key} "
            f"ORDER BY {self.order}) - 1 AS INT) AS {self.number} FROM ({self.rows}) AS numbered"
        )


NUMBERED: dict[str, Numbered] = {
    # Ground truth: normalised corners, all multiples of 1/64.
    "fx_gt": Numbered(
        f"""SELECT l_orderkey AS image_id, {_LINE_ORDER},
  CAST(l_partkey % 48 AS DOUBLE) / 64 AS x1,
  CAST(l_suppkey % 48 AS DOUBLE) / 64 AS y1,
  CAST(l_partkey % 48 + 1 + CAST(l_quantity AS BIGINT) % 15 AS DOUBLE) / 64 AS x2,
  CAST(l_suppkey % 48 + 1 + l_linenumber % 15 AS DOUBLE) / 64 AS y2,
  0 AS class_id
FROM lineitem""",
        "image_id",
        _LINE_ORDER,
        ("l_linenumber", "floor(l_partkey / 1024)"),
        "gt_idx",
        "image_id, x1, y1, x2, y2, class_id",
    ),
    # Predictions: most of the truth, shifted a little, plus unrelated boxes.
    "fx_pred": Numbered(
        f"""SELECT 0 AS k, l_orderkey AS image_id, {_LINE_ORDER},
  CAST(4 * (l_partkey % 48) + l_suppkey % 5 AS DOUBLE) / 256 AS x1,
  CAST(4 * (l_suppkey % 48) + l_partkey % 3 AS DOUBLE) / 256 AS y1,
  CAST(4 * (l_partkey % 48 + 1 + CAST(l_quantity AS BIGINT) % 15) + l_suppkey % 5 AS DOUBLE) / 256
    AS x2,
  CAST(4 * (l_suppkey % 48 + 1 + l_linenumber % 15) + l_partkey % 3 AS DOUBLE) / 256 AS y2,
  0 AS class_id,
  CAST(1 + (l_partkey * 7 + l_suppkey * 13 + l_linenumber * 29) % 127 AS DOUBLE) / 128
    AS confidence
FROM lineitem WHERE (l_partkey + l_linenumber) % 10 <> 0
UNION ALL
SELECT 1 AS k, l_orderkey AS image_id, {_LINE_ORDER},
  CAST(l_suppkey % 48 AS DOUBLE) / 64, CAST(l_partkey % 48 AS DOUBLE) / 64,
  CAST(l_suppkey % 48 + 4 AS DOUBLE) / 64, CAST(l_partkey % 48 + 4 AS DOUBLE) / 64, 0,
  CAST(1 + (l_partkey * 5 + l_suppkey * 3) % 63 AS DOUBLE) / 128
FROM lineitem WHERE l_suppkey % 6 = 0""",
        "image_id",
        f"k, {_LINE_ORDER}",
        ("k", "l_linenumber", "floor(l_partkey / 1024)"),
        "pred_idx",
        "image_id, x1, y1, x2, y2, class_id, confidence",
    ),
    # Pixel boxes before clipping, with degenerate and out-of-image cases.
    "fx_objects": Numbered(
        f"""SELECT l_orderkey AS image_id, {_LINE_ORDER},
  l_returnflag || '_' || l_linestatus AS class_name,
  CAST(l_partkey % 1300 - 20 AS DOUBLE) AS xmin,
  CAST(l_suppkey * 7 % 820 - 20 AS DOUBLE) AS ymin,
  CAST(l_partkey % 1300 - 20 + (CAST(l_quantity AS BIGINT) - 1) * 8 AS DOUBLE) AS xmax,
  CAST(l_suppkey * 7 % 820 - 20 + l_linenumber * 24 AS DOUBLE) AS ymax
FROM lineitem""",
        "image_id",
        _LINE_ORDER,
        ("l_linenumber", "floor(l_partkey / 1024)"),
        "obj_idx",
        "image_id, class_name, xmin, ymin, xmax, ymax",
    ),
    # Frames of a video in time order.
    "fx_frames": Numbered(
        """SELECT user_id AS video_id, ts, event_id, CAST(25 AS DOUBLE) AS fps,
  CASE WHEN event_type = 'error' THEN 0 ELSE CAST(event_id % 4 AS INT) END AS detections,
  CAST(event_id % 16 AS DOUBLE) / 8 AS preprocess_ms,
  value AS inference_ms,
  CAST(event_id % 8 AS DOUBLE) / 16 AS postprocess_ms
FROM events""",
        "video_id",
        "ts, event_id",
        ("date_trunc('HOUR', ts)", "date_trunc('SECOND', ts)"),
        "frame_index",
        "video_id, ts, fps, detections, preprocess_ms, inference_ms, postprocess_ms",
    ),
}

VIEWS: dict[str, str] = {
    **{name: view.as_sql() for name, view in NUMBERED.items()},
    "fx_images": """
SELECT o_orderkey AS image_id,
  CASE WHEN o_orderkey % 20 < 3 THEN 'test' WHEN o_orderkey % 20 < 6 THEN 'val' ELSE 'train' END
    AS split,
  CAST(640 + 64 * (o_custkey % 11) AS INT) AS width,
  CAST(480 + 32 * (o_custkey % 11) AS INT) AS height,
  CAST(640 + 64 * (o_custkey % 11) + CASE WHEN o_orderkey % 50 = 0 THEN 64 ELSE 0 END AS INT)
    AS xml_width,
  CAST(480 + 32 * (o_custkey % 11) AS INT) AS xml_height
FROM orders""",
    "fx_split_lists": """
SELECT 'trainval' AS list, CAST(doc_id AS STRING) AS image_id FROM documents WHERE doc_id % 6 <> 0
UNION ALL
SELECT 'trainval', CAST(doc_id AS STRING) FROM documents WHERE doc_id % 97 = 1
UNION ALL
SELECT 'test', CAST(doc_id AS STRING) FROM documents WHERE doc_id % 6 = 0 OR doc_id % 101 = 1""",
    # Documents as dataset items: some content repeats, which the leak check is about.
    "fx_items": """
SELECT CAST(doc_id AS STRING) AS image_id, text,
  CASE WHEN doc_id % 20 < 3 THEN 'test' WHEN doc_id % 20 < 6 THEN 'val' ELSE 'train' END AS split,
  CASE WHEN doc_id % 3 = 0 THEN 'real' ELSE 'synthetic' END AS source,
  CAST(n_chars % 7 AS BIGINT) AS object_count
FROM documents""",
    # One file path per document: mixed case, several types, shared stems.
    "fx_paths": """
SELECT doc_id,
  CASE WHEN doc_id % 20 < 3 THEN 'test' WHEN doc_id % 20 < 6 THEN 'val' ELSE 'train' END AS split,
  'data/' || source || '/JPEGImages/' ||
  CASE WHEN doc_id % 5 = 0 THEN 'D' ELSE 'd' END ||
  CAST(CASE WHEN doc_id % 4 = 1 THEN doc_id - 1 ELSE doc_id END AS STRING) ||
  CASE doc_id % 8 WHEN 0 THEN '.jpg' WHEN 1 THEN '.JPG' WHEN 2 THEN '.png' WHEN 3 THEN '.txt'
    WHEN 4 THEN '.jpeg' WHEN 5 THEN '.Tiff' WHEN 6 THEN '.ppm' ELSE '.gif' END AS path
FROM documents""",
    "fx_root_paths": """
SELECT 'data/' || source ||
  CASE WHEN k = 0 THEN '/Annotations/' || CAST(doc_id AS STRING) || '.xml'
    WHEN k = 1 THEN '/JPEGImages/' || CAST(doc_id AS STRING) || '.jpg'
    WHEN k = 2 AND source <> 'src3' THEN '/ImageSets/Main/train.txt'
    WHEN source = 'src7' AND k = 3 THEN '/ImageSets/Main/trainval.txt'
    WHEN source = 'src7' THEN '/ImageSets/Main/test.txt'
    ELSE '/readme.md' END AS path
FROM (SELECT doc_id, source, (n_chars + doc_id) % 5 AS k FROM documents) AS numbered""",
    # One label file per order line: valid, wrong and blank lines.
    "fx_label_files": """
SELECT CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' ||
    CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS image_id,
  '0 0.' || lpad(CAST(l_partkey % 1000 AS STRING), 3, '0') || ' 0.' ||
    lpad(CAST(l_suppkey * 7 % 1000 AS STRING), 3, '0') || ' 0.' ||
    lpad(CAST(CAST(l_quantity AS BIGINT) * 9 AS STRING), 3, '0') || ' 0.250' || chr(10) ||
  CASE WHEN l_linenumber = 1 THEN '  ' || chr(10) ELSE '' END ||
  CASE WHEN l_partkey % 11 = 0 THEN '0 0.5 0.5 0.1'
    WHEN l_partkey % 11 = 1 THEN '0 abc 0.5 0.1 0.1'
    WHEN l_partkey % 11 = 2 THEN '0 NaN 0.5 0.1 0.1'
    WHEN l_partkey % 11 = 3 THEN '1  0.5 0.5 0.1 0.1 '
    WHEN l_partkey % 11 = 4 THEN '0 0.5 1.5 0.1 0.1'
    WHEN l_partkey % 11 = 5 THEN '0 0.5 0.5 0.0 1.25'
    ELSE '0 0.5 0.5 0.125 0.25' END AS text
FROM lineitem""",
    # One annotation document per order line; w and h are the image size it names.
    "fx_documents": """
SELECT CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' ||
    CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS image_id,
  CAST(l_partkey % 12 AS INT) AS kind,
  640 + l_suppkey % 64 AS w, 480 + l_partkey % 32 AS h,
  l_partkey % 600 AS x, l_suppkey % 400 AS y, CAST(l_quantity AS BIGINT) AS q,
  l_returnflag AS name, l_linenumber AS n
FROM lineitem""",
    # Raw model results, one per order line: two boxes, with some broken results.
    "fx_results": """
SELECT l_orderkey AS image_id, l_linenumber AS n, l_partkey AS p, l_suppkey AS s,
  CAST(l_partkey % 48 AS DOUBLE) / 64 AS a, CAST(l_suppkey % 48 AS DOUBLE) / 64 AS b,
  CAST(1 + l_partkey % 127 AS DOUBLE) / 128 AS conf, CAST(l_partkey % 9 AS INT) AS kind
FROM lineitem""",
    # Runs: one per customer, their datasets are nations.
    "fx_runs": """
SELECT c_custkey AS run_id, CAST(c_nationkey AS STRING) AS dataset_fingerprint,
  c_custkey AS finished_at,
  CASE WHEN c_custkey % 7 = 0 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN c_custkey % 11 = 0 THEN 'test' ELSE 'val' END AS split,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS model_sha256,
  CAST((c_custkey * 37) % 512 AS DOUBLE) / 512 AS small_object_recall,
  CAST((c_custkey * 17) % 64 AS DOUBLE) / 64 AS recall,
  CAST((c_custkey * 29) % 32 AS DOUBLE) / 32 AS map50_95,
  CAST((c_custkey * 11) % 16 AS DOUBLE) / 16 AS false_positives_per_image,
  CAST(c_custkey % 8 AS DOUBLE) AS p95_inference_latency_ms
FROM customer""",
}


class Inputs:
    """Tables and derived views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run SQL that names base tables in braces, such as ``{lineitem}``."""
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def view(self, name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
        """A derived view; numbering is safe for keys with very many rows."""
        numbered = NUMBERED.get(name)
        if numbered is None:
            return self.sql(_braced(VIEWS[name]))
        place = f"_{numbered.number}"
        rows = grouped_row_number(
            self.sql(_braced(numbered.rows)),
            [numbered.key],
            [F.expr(c) for c in numbered.order.split(", ")],
            [F.expr(c) for c in numbered.levels],
            place,
            hot_rows,
        )
        number = (F.col(place) - 1).cast("int").alias(numbered.number)
        return rows.select(*numbered.columns.split(", "), number)


def _braced(text: str) -> str:
    for table in TABLES:
        text = text.replace(f"FROM {table}", f"FROM {{{table}}}")
    return text


def with_views(sql: str) -> str:
    """Put the texts of the views that ``sql`` names in front of it."""
    needed = [f"{name} AS ({text}\n)" for name, text in VIEWS.items() if name in sql]
    if not needed:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(needed) + ",\n" + body[len("WITH RECURSIVE") :]
    if body.upper().startswith("WITH"):
        return "WITH " + ",\n".join(needed) + ",\n" + body[len("WITH") :]
    return "WITH " + ",\n".join(needed) + "\n" + body
