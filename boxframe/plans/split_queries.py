"""Queries on splits, pairing, leaks, manifests, fingerprints and combination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.operators import combine, fingerprint, profile, quality, splits
from boxframe.plans.fixtures import Inputs
from boxframe.plans.registry import query
from boxframe.schemas import SPLITS
from boxframe.sinks.files import manifest_json
from boxframe.sources import labels, listing, split_lists

SEED = 42
OPTIONS = {"clip_boxes": True, "keep_empty_images": True, "target_class_id": 0}
SOURCE_SHA = "f" * 64


def _list(inputs: Inputs, name: str) -> DataFrame:
    return inputs.view("fx_split_lists").filter(F.col("list") == name).select("image_id")


def _members(inputs: Inputs) -> DataFrame:
    return splits.assign_splits(_list(inputs, "trainval"), _list(inputs, "test"), 0.2, SEED)


def _items(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_items")


_OFFICIAL = """WITH held AS (SELECT DISTINCT image_id FROM fx_split_lists WHERE list = 'test'),
free AS (SELECT DISTINCT image_id FROM fx_split_lists WHERE list = 'trainval'
  AND image_id NOT IN (SELECT image_id FROM held)),
ranked AS (SELECT image_id, row_number() OVER (ORDER BY sha256('42:' || image_id), image_id) AS r,
  count(*) OVER () AS n FROM free),
members AS (
  SELECT image_id, CASE WHEN r <= least(n - 1, greatest(1, round_even(n * 0.2, 0))) THEN 'val'
    ELSE 'train' END AS split FROM ranked
  UNION ALL SELECT image_id, 'test' FROM held)
"""


@query("split_official", _OFFICIAL + "SELECT image_id, split FROM members")
def split_official(inputs: Inputs) -> DataFrame:
    return _members(inputs)


@query(
    "split_fallback",
    """WITH ids AS (SELECT DISTINCT image_id FROM fx_split_lists),
ranked AS (SELECT image_id, row_number() OVER (ORDER BY sha256('42:' || image_id), image_id) AS r,
  count(*) OVER () AS n FROM ids),
cuts AS (SELECT *, least(n - 1, greatest(1, round_even(n * 0.15, 0))) AS n_test FROM ranked),
ends AS (SELECT *, n_test + least(n - n_test - 1, greatest(1, round_even((n - n_test) * (0.15::DOUBLE / 0.85::DOUBLE), 0)))
  AS n_val FROM cuts)
SELECT image_id, CASE WHEN r <= n_test THEN 'test' WHEN r <= n_val THEN 'val' ELSE 'train' END
  AS split FROM ends""",
)
def split_fallback(inputs: Inputs) -> DataFrame:
    return splits.assign_fallback_splits(inputs.view("fx_split_lists").select("image_id"), SEED)


@query(
    "split_warnings",
    """WITH n AS (SELECT image_id, count(*) FILTER (WHERE list = 'trainval') AS a,
  count(*) FILTER (WHERE list = 'test') AS b FROM fx_split_lists GROUP BY 1)
SELECT 'duplicate' AS rule, 'trainval' AS list, image_id FROM n WHERE a > 1
UNION ALL SELECT 'duplicate', 'test', image_id FROM n WHERE b > 1
UNION ALL SELECT 'overlap', 'trainval', image_id FROM n WHERE a > 0 AND b > 0""",
)
def split_warnings(inputs: Inputs) -> DataFrame:
    return splits.split_warnings(_list(inputs, "trainval"), _list(inputs, "test"))


@query(
    "test_precedence",
    """SELECT DISTINCT image_id, 'kept' AS outcome FROM fx_split_lists WHERE list = 'trainval'
  AND image_id NOT IN (SELECT image_id FROM fx_split_lists WHERE list = 'test')
UNION ALL SELECT DISTINCT image_id, 'removed' FROM fx_split_lists WHERE list = 'trainval'
  AND image_id IN (SELECT image_id FROM fx_split_lists WHERE list = 'test')""",
)
def test_first(inputs: Inputs) -> DataFrame:
    trainval = split_lists.unique_ids(_list(inputs, "trainval"))
    kept, removed = splits.apply_test_precedence(trainval, _list(inputs, "test"))
    return kept.withColumn("outcome", F.lit("kept")).unionByName(
        removed.withColumn("outcome", F.lit("removed"))
    )


@query(
    "duplicate_ids",
    "SELECT list, image_id, count(*) AS n FROM fx_split_lists GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_ids(inputs: Inputs) -> DataFrame:
    return split_lists.duplicate_ids(inputs.view("fx_split_lists"), "list")


_LIST_LINES = """SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '   ' WHEN doc_id % 10 = 1 THEN
    chr(65279) || 'img/' || CAST(doc_id AS STRING) || '.jpg'
  WHEN doc_id % 10 = 2 THEN '..' ELSE '  ' || CAST(doc_id - doc_id % 4 AS STRING) || '.xml ' END AS value
FROM """


@query(
    "split_list_scan",
    f"""WITH l AS ({_LIST_LINES} documents)
SELECT image_id, count(*) AS n, count(*) > 1 AS repeated FROM (
  SELECT CASE WHEN doc_id % 10 = 2 THEN NULL WHEN doc_id % 10 = 1 THEN CAST(doc_id AS VARCHAR)
    ELSE CAST(doc_id - doc_id % 4 AS VARCHAR) END AS image_id FROM l WHERE trim(value) <> '')
GROUP BY 1""",
)
def split_list_scan(inputs: Inputs) -> DataFrame:
    # Spark's chr() is one byte, so the byte-order mark is written out.
    lines = inputs.sql(_LIST_LINES.replace("chr(65279)", "'﻿'") + "{documents}")
    entries = split_lists.clean_split_list(lines)
    return entries.groupBy("image_id").agg(
        F.count("*").alias("n"), (F.count("*") > 1).alias("repeated")
    )


def _tree(table: str, key: str, text: str, order: str, digits: int = 4) -> str:
    """SQL of a list digest: leaves by the first digits of the ID's hash, then branches, then the root."""
    half = digits - digits // 2
    return f"""SELECT {key}, CAST(sum(c) AS BIGINT) AS n, sha256(string_agg(branch || b, '' ORDER BY branch)) AS digest FROM (
  SELECT {key}, left(leaf, {half}) AS branch, sum(c) AS c, sha256(string_agg(leaf || d, '' ORDER BY leaf)) AS b FROM (
    SELECT {key}, left(sha256(image_id), {digits}) AS leaf, count(*) AS c, sha256(string_agg({text}, '' ORDER BY {order})) AS d
    FROM {table} GROUP BY 1, 2) GROUP BY 1, 2) GROUP BY 1"""


_LINE = "image_id || chr(10)"


@query("split_files", _OFFICIAL + _tree("members", "split", _LINE, "image_id"))
def split_files(inputs: Inputs) -> DataFrame:
    return fingerprint.split_hash(_members(inputs))


@query("split_hash", _tree("fx_items", "split", _LINE, "image_id"))
def split_hash(inputs: Inputs) -> DataFrame:
    return fingerprint.split_hash(_items(inputs).select("split", "image_id"))


@query("split_hash_merkle", _tree("fx_items", "split", _LINE, "image_id", 1))
def split_hash_merkle(inputs: Inputs) -> DataFrame:
    """Few leaves of many IDs each."""
    return fingerprint.split_hash(_items(inputs).select("split", "image_id"), leaf_digits=1)


@query(
    "split_file_digest",
    """SELECT split, count(*) AS n, sha256(string_agg(image_id || chr(10), '' ORDER BY image_id))
  AS digest FROM fx_items GROUP BY 1""",
)
def split_file_digest(inputs: Inputs) -> DataFrame:
    return fingerprint.file_digest(_items(inputs).select("split", "image_id"))


_HASHES = f"""WITH h AS (SELECT split, digest AS d FROM ({_tree("fx_items", "split", _LINE, "image_id")})),
w AS (SELECT max(d) FILTER (WHERE split = 'test') AS test, max(d) FILTER (WHERE split = 'train')
  AS train, max(d) FILTER (WHERE split = 'val') AS val FROM h),
j AS (SELECT '"split_hashes":{{"test":"' || test || '","train":"' || train || '","val":"' || val || '"}}'
  AS s FROM w)
"""


@query(
    "fingerprint",
    _HASHES + f"""SELECT sha256('{{"conversion":{{"clip_boxes":true,"keep_empty_images":true,"target_class_id":0}},"source_archive_sha256":"{SOURCE_SHA}",' || s || '}}') AS dataset_fingerprint FROM j""",
)
def dataset_fingerprint(inputs: Inputs) -> DataFrame:
    hashes = fingerprint.split_hash(_items(inputs).select("split", "image_id"))
    return fingerprint.dataset_fingerprint(hashes, SOURCE_SHA, OPTIONS)


@query(
    "combined_fingerprint",
    _HASHES + f"""SELECT sha256('{{"seed":42,"source_fingerprints":{{"a":"{SOURCE_SHA}","b":"x"}},' || s || '}}') AS dataset_fingerprint FROM j""",
)
def combined_fingerprint(inputs: Inputs) -> DataFrame:
    hashes = fingerprint.split_hash(_items(inputs).select("split", "image_id"))
    return fingerprint.combined_fingerprint(hashes, {"b": "x", "a": SOURCE_SHA}, SEED)


@query(
    "manifest_row",
    """WITH c AS (SELECT source, split, count(*) AS n, CAST(sum(object_count) AS BIGINT) AS o
  FROM fx_items GROUP BY 1, 2)
SELECT source, '{"fingerprint":null,"images":' || n || ',"objects":' || o || ',"source":"' || source ||
  '","split":"' || split || '"}' AS manifest FROM c""",
)
def manifest_row(inputs: Inputs) -> DataFrame:
    counts = profile.dataset_counts(_items(inputs))
    fields = {n: F.col(n) for n in ("split", "source", "objects", "images")}
    fields["fingerprint"] = F.lit(None).cast("string")
    return counts.select("source", manifest_json(fields).alias("manifest"))


@query(
    "content_digest",
    _tree(
        "fx_items",
        "source",
        "split || chr(0) || image_id || chr(0) || sha256(text) || chr(0) || sha256(source) || chr(0)",
        "CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END, image_id",
    ),
)
def content_digest(inputs: Inputs) -> DataFrame:
    items = _items(inputs).select(
        "source",
        "split",
        "image_id",
        F.sha2("text", 256).alias("image_sha"),
        F.sha2("source", 256).alias("label_sha"),
    )
    return fingerprint.content_digest(items)


@query(
    "content_leak",
    """WITH d AS (SELECT image_id, split, sha256(text) AS digest,
  CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END AS o FROM fx_items),
f AS (SELECT digest, min(o) AS o FROM d GROUP BY 1),
k AS (SELECT d.digest, d.o, d.split, max(image_id) AS kept_id FROM d JOIN f
  ON d.digest = f.digest AND d.o = f.o GROUP BY ALL)
SELECT d.split, d.image_id, k.split AS kept_split, k.kept_id
FROM d JOIN k ON d.digest = k.digest AND d.o > k.o""",
)
def content_leak(inputs: Inputs) -> DataFrame:
    items = _items(inputs).select("image_id", "split", F.sha2("text", 256).alias("digest"))
    return quality.content_leak(items)


_LABELLED = """SELECT CASE WHEN doc_id % 20 < 3 THEN 'test' WHEN doc_id % 20 < 6 THEN 'val' ELSE 'train' END
  AS split, CAST(CASE WHEN doc_id % 50 = 0 THEN doc_id + 1000000 ELSE doc_id END AS STRING) AS image_id
FROM """


@query(
    "pairing",
    f"""WITH l AS ({_LABELLED} labels)
SELECT CASE WHEN l.image_id IS NULL THEN 'missing_label' ELSE 'orphan_label' END AS rule,
  coalesce(i.split, l.split) AS split, coalesce(i.image_id, l.image_id) AS image_id
FROM fx_items i FULL JOIN l ON i.split = l.split AND i.image_id = l.image_id
WHERE i.image_id IS NULL OR l.image_id IS NULL""",
)
def pairing(inputs: Inputs) -> DataFrame:
    return quality.pairing(_items(inputs), inputs.sql(_LABELLED + "{labels}"))


# Members of splits with some IDs in two or three of them.
_SHARED = """SELECT split, image_id FROM fx_items
UNION ALL SELECT 'val', image_id FROM fx_items WHERE CAST(image_id AS BIGINT) % 37 = 0
UNION ALL SELECT 'test', image_id FROM fx_items WHERE CAST(image_id AS BIGINT) % 74 = 0"""


def _shared(inputs: Inputs) -> DataFrame:
    base = _items(inputs).select("split", "image_id")
    number = F.col("image_id").cast("bigint")
    for name, step in (("val", 37), ("test", 74)):
        more = _items(inputs).filter(number % step == 0).select(F.lit(name).alias("split"), "image_id")
        base = base.unionByName(more)
    return base


@query(
    "split_overlap",
    f"""WITH m AS (SELECT DISTINCT * FROM ({_SHARED}))
SELECT a.split AS split_a, b.split AS split_b, a.image_id FROM m a JOIN m b
ON a.image_id = b.image_id AND a.split < b.split""",
)
def split_overlap(inputs: Inputs) -> DataFrame:
    return splits.split_overlap(_shared(inputs))


@query(
    "split_integrity",
    _OFFICIAL + """, x AS (SELECT lower(regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]+$', ''))
    AS k, count(*) AS n FROM fx_paths WHERE lower(path) SIMILAR TO '.*\\.(jpg|jpeg|png|bmp|tif|tiff|ppm)'
  GROUP BY 1)
SELECT CASE WHEN l.doc_id IS NULL THEN 'missing_annotation' WHEN x.n IS NULL THEN 'missing_image'
  ELSE 'ambiguous_image' END AS rule, m.split, 'd' || m.image_id AS image_id
FROM members m LEFT JOIN labels l ON CAST(l.doc_id AS VARCHAR) = m.image_id
LEFT JOIN x ON x.k = 'd' || m.image_id
WHERE l.doc_id IS NULL OR x.n IS NULL OR x.n > 1""",
)
def split_integrity(inputs: Inputs) -> DataFrame:
    named = F.concat(F.lit("d"), F.col("image_id"))
    members = _members(inputs).withColumn("image_id", named)
    noted = inputs.table("labels").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("image_id")
    )
    return splits.split_integrity(members, noted, listing.image_index(inputs.view("fx_paths")))


@query(
    "included_splits",
    _OFFICIAL + """SELECT image_id, split FROM members WHERE image_id IN (
  SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)""",
)
def included_splits(inputs: Inputs) -> DataFrame:
    good = inputs.table("labels").filter("quality = 1")
    return splits.included_splits(
        _members(inputs), good.select(F.col("doc_id").cast("string").alias("image_id"))
    )


@query(
    "manifest_reconcile",
    """WITH listed AS (SELECT split, image_id FROM fx_items WHERE split <> 'val'
    AND NOT (split = 'test' AND CAST(image_id AS BIGINT) % 40 = 1)
  UNION ALL SELECT split, image_id FROM fx_items WHERE split = 'val'
  UNION ALL SELECT 'train', 'gone' || image_id FROM fx_items WHERE CAST(image_id AS BIGINT) % 100 = 6),
j AS (SELECT coalesce(o.split, l.split) AS split, o.image_id AS seen, l.image_id AS listed
  FROM fx_items o FULL JOIN listed l ON o.split = l.split AND o.image_id = l.image_id),
c AS (SELECT split, count(*) AS listed_count FROM fx_items WHERE split <> 'train' GROUP BY 1)
SELECT j.split, count(*) FILTER (WHERE listed IS NULL) AS unlisted,
  count(*) FILTER (WHERE seen IS NULL) AS unseen, count(seen) AS observed_count,
  any_value(listed_count) AS listed_count,
  count(*) FILTER (WHERE listed IS NULL OR seen IS NULL) = 0 AS ids_match,
  coalesce(count(seen) = any_value(listed_count), false) AS count_matches
FROM j LEFT JOIN c ON j.split = c.split GROUP BY 1""",
)
def manifest_reconcile(inputs: Inputs) -> DataFrame:
    items = _items(inputs).select("split", "image_id")
    number = F.col("image_id").cast("bigint")
    listed = items.filter(~((F.col("split") == "test") & (number % 40 == 1))).unionByName(
        items.filter(number % 100 == 6).select(
            F.lit("train").alias("split"), F.concat(F.lit("gone"), "image_id").alias("image_id")
        )
    )
    counts = items.filter("split <> 'train'").groupBy("split").agg(
        F.count("*").alias("listed_count")
    )
    return quality.manifest_reconcile(items, listed, counts)


_COLLIDING = """SELECT 'a' AS source, split, 'Doc' || image_id AS image_id FROM fx_items
UNION ALL SELECT 'b' AS source, 'train' AS split, 'dOC' || image_id AS image_id FROM fx_items
  WHERE CAST(image_id AS BIGINT) % 11 = 0"""


@query(
    "id_collisions",
    f"""WITH c AS ({_COLLIDING})
SELECT lower(image_id) AS key, source, split, image_id FROM c
WHERE lower(image_id) IN (SELECT lower(image_id) FROM c GROUP BY 1 HAVING count(*) > 1)""",
)
def id_collisions(inputs: Inputs) -> DataFrame:
    items = _items(inputs)
    a = items.select(
        F.lit("a").alias("source"), "split", F.concat(F.lit("Doc"), "image_id").alias("image_id")
    )
    b = items.filter(F.col("image_id").cast("bigint") % 11 == 0).select(
        F.lit("b").alias("source"),
        F.lit("train").alias("split"),
        F.concat(F.lit("dOC"), "image_id").alias("image_id"),
    )
    return quality.id_collisions(a.unionByName(b))


@query(
    "dataset_counts",
    """SELECT source, split, count(*) AS images, CAST(sum(object_count) AS BIGINT) AS objects
FROM fx_items GROUP BY 1, 2""",
)
def dataset_counts(inputs: Inputs) -> DataFrame:
    return profile.dataset_counts(_items(inputs))


@query(
    "dataset_counts_wide",
    "SELECT source, "
    + ", ".join(
        f"count(*) FILTER (WHERE split = '{s}') AS {s}_images, "
        f"CAST(coalesce(sum(object_count) FILTER (WHERE split = '{s}'), 0) AS BIGINT) AS {s}_objects"
        for s in SPLITS
    )
    + " FROM fx_items GROUP BY 1",
)
def dataset_counts_wide(inputs: Inputs) -> DataFrame:
    return profile.dataset_counts_wide(_items(inputs))


_SOURCES = {
    "documents": ("real", "SELECT CAST(doc_id AS STRING) AS image_id, CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, n_chars AS object_count FROM {documents}"),
    "talks": ("talk-1", "SELECT CAST(conv_id AS STRING) || '.' || CAST(turn AS STRING) AS image_id, 'train' AS split, CAST(length(text) AS BIGINT) AS object_count FROM {conversations}"),
    "benchmark": ("bench", "SELECT CAST(item_id AS STRING) AS image_id, 'test' AS split, CAST(length(text) AS BIGINT) AS object_count FROM {benchmark}"),
}


@query(
    "combine_sources",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS source, '{prefix}__' || image_id AS image_id, split, object_count FROM ("
        + text.replace("{", "").replace("}", "")
        + ") AS s"
        for name, (prefix, text) in _SOURCES.items()
    ),
)
def combine_sources(inputs: Inputs) -> DataFrame:
    sources = {name: inputs.sql(text) for name, (_, text) in _SOURCES.items()}
    return combine.combine_sources(sources, {n: p for n, (p, _) in _SOURCES.items()})


# Two sources of order lines, one with IDs that differ in case, labels that are lacking, left over and broken.
_CHECKED_IMAGES = """SELECT CASE WHEN n % 2 = 0 THEN 'real' ELSE 'made' END AS source,
  CASE WHEN n % 10 < 6 THEN 'train' WHEN n % 10 < 8 AND n % 2 = 0 THEN 'val' ELSE 'test' END AS split,
  CASE WHEN l_linenumber = 2 AND l_partkey % 50 = 0 THEN 'Shared_' || CAST(n % 97 AS STRING)
    WHEN l_linenumber = 3 AND l_partkey % 50 = 0 THEN 'sHARED_' || CAST(n % 97 AS STRING)
    ELSE CAST(n AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING)
  END AS image_id FROM (SELECT *, l_orderkey AS n FROM {lineitem}) AS numbered"""
_CHECKED_LABELS = """SELECT CASE WHEN n % 2 = 0 THEN 'real' ELSE 'made' END AS source,
  CASE WHEN n % 10 < 6 THEN 'train' WHEN n % 10 < 8 AND n % 2 = 0 THEN 'val' ELSE 'test' END AS split,
  CASE WHEN l_partkey % 83 = 0 THEN 'left_over_' ELSE '' END ||
    CAST(n AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS image_id,
  CASE WHEN l_partkey % 11 = 0 THEN '0 0.5 0.5 0.1' WHEN l_partkey % 11 = 3 THEN '1 0.5 0.5 0.1 0.1' ELSE '0 0.5 0.5 0.1 0.1' END AS text
FROM (SELECT *, l_orderkey AS n FROM {lineitem}) AS numbered"""


@query(
    "combine_report",
    f"""WITH i AS (SELECT source, split, image_id, count(*) AS n FROM ({_CHECKED_IMAGES}) AS a GROUP BY ALL),
l AS (SELECT DISTINCT source, split, image_id FROM ({_CHECKED_LABELS}) AS b),
r AS (SELECT *, row_number() OVER (PARTITION BY source, lower(image_id)
  ORDER BY CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END, image_id) AS k FROM i),
f AS (
  SELECT 'missing_label' AS rule, source, split FROM i ANTI JOIN l USING (source, split, image_id)
  UNION ALL SELECT 'orphan_label', source, split FROM l ANTI JOIN i USING (source, split, image_id)
  UNION ALL SELECT 'repeated_id', source, split FROM r WHERE k > 1 OR n > 1
  UNION ALL SELECT 'empty_split', a.source, s.split FROM (SELECT DISTINCT source FROM i) AS a,
    (VALUES ('train'), ('val'), ('test')) AS s(split)
    WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.source = a.source AND i.split = s.split)
  UNION ALL SELECT 'field_count', source, split FROM ({_CHECKED_LABELS}) AS b WHERE text = '0 0.5 0.5 0.1'
  UNION ALL SELECT 'class_not_zero', source, split FROM ({_CHECKED_LABELS}) AS b WHERE text LIKE '1 %')
SELECT 'error' AS severity, rule, source, split, count(*) AS n FROM f GROUP BY ALL""".replace("{lineitem}", "lineitem"),
)
def combine_report(inputs: Inputs) -> DataFrame:
    images, files = inputs.sql(_CHECKED_IMAGES), inputs.sql(_CHECKED_LABELS)
    _, broken = labels.parse_labels(files)
    issues = combine.source_issues(images, files, broken, ["real", "made"])
    return issues.groupBy("severity", "rule", "source", "split").agg(F.count("*").alias("n"))


@query(
    "id_intersect",
    "SELECT doc_id AS image_id FROM documents INTERSECT SELECT doc_id FROM labels",
)
def id_intersect(inputs: Inputs) -> DataFrame:
    docs = inputs.table("documents").select(F.col("doc_id").alias("image_id"))
    labelled = inputs.table("labels")
    return combine.common_ids(docs, labelled.select(F.col("doc_id").alias("image_id")))


@query("id_except", "SELECT doc_id AS image_id FROM documents EXCEPT SELECT doc_id FROM labels")
def id_except(inputs: Inputs) -> DataFrame:
    docs = inputs.table("documents").select(F.col("doc_id").alias("image_id"))
    labelled = inputs.table("labels").select(F.col("doc_id").alias("image_id"))
    return combine.missing_ids(docs, labelled)


@query(
    "observed_classes",
    """SELECT class_id, count(*) AS n_boxes, class_id = 0 AS allowed FROM (
  SELECT CAST(list_extract(string_split(line, ' '), 1) AS INTEGER) AS class_id FROM (
    SELECT unnest(string_split(text, chr(10))) AS line FROM fx_label_files)
  WHERE trim(line) <> '' AND line NOT LIKE '%abc%' AND line NOT LIKE '%NaN%'
    AND line <> '0 0.5 0.5 0.1') GROUP BY 1""",
)
def observed_classes(inputs: Inputs) -> DataFrame:
    boxes, _ = labels.parse_labels(inputs.view("fx_label_files"))
    return quality.observed_classes(boxes)


@query(
    "validation_report",
    f"""WITH l AS ({_LABELLED} labels), images AS (SELECT DISTINCT * FROM ({_SHARED})),
p AS (SELECT CASE WHEN l.image_id IS NULL THEN 'missing_label' ELSE 'orphan_label' END AS rule
  FROM images i FULL JOIN l ON i.split = l.split AND i.image_id = l.image_id
  WHERE i.image_id IS NULL OR l.image_id IS NULL),
o AS (SELECT 'split_overlap' AS rule FROM images a JOIN images b
  ON a.image_id = b.image_id AND a.split < b.split),
d AS (SELECT image_id, split, sha256(text) AS digest,
  CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END AS o FROM fx_items),
c AS (SELECT 'content_in_two_splits' AS rule FROM d
  WHERE o > (SELECT min(o) FROM d e WHERE e.digest = d.digest)),
t AS (SELECT unnest(string_split(text, chr(10))) AS line FROM fx_label_files),
e AS (SELECT 'class_not_zero' AS rule FROM t WHERE line LIKE '1 %'
  UNION ALL SELECT 'field_count' FROM t WHERE line = '0 0.5 0.5 0.1'
  UNION ALL SELECT 'not_numeric' FROM t WHERE line LIKE '%abc%'
  UNION ALL SELECT 'not_finite' FROM t WHERE line LIKE '%NaN%'
  UNION ALL SELECT 'center_outside' FROM t WHERE line LIKE '% 1.5 %'
  UNION ALL SELECT 'size_outside' FROM t WHERE line LIKE '% 1.25'
  UNION ALL SELECT 'box_outside_image' FROM t WHERE trim(line) <> '' AND line NOT LIKE '%abc%'
    AND line NOT LIKE '%NaN%' AND line <> '0 0.5 0.5 0.1' AND (
    f2 - f4 / 2 < -1e-6 OR f2 + f4 / 2 > 1 + 1e-6 OR f3 - f5 / 2 < -1e-6 OR f3 + f5 / 2 > 1 + 1e-6)),
a AS (SELECT * FROM p UNION ALL SELECT * FROM o UNION ALL SELECT * FROM c UNION ALL SELECT * FROM e)
SELECT 'error' AS severity, rule, count(*) AS n FROM a GROUP BY 2""".replace(
        "f2", "TRY_CAST(regexp_split_to_array(trim(line), '\\s+')[2] AS DOUBLE)"
    )
    .replace("f3", "TRY_CAST(regexp_split_to_array(trim(line), '\\s+')[3] AS DOUBLE)")
    .replace("f4", "TRY_CAST(regexp_split_to_array(trim(line), '\\s+')[4] AS DOUBLE)")
    .replace("f5", "TRY_CAST(regexp_split_to_array(trim(line), '\\s+')[5] AS DOUBLE)"),
)
def validation_report(inputs: Inputs) -> DataFrame:
    _, line_issues = labels.parse_labels(inputs.view("fx_label_files"))
    contents = _items(inputs).select("image_id", "split", F.sha2("text", 256).alias("digest"))
    issues = quality.validation_issues(
        _shared(inputs), inputs.sql(_LABELLED + "{labels}"), line_issues, contents=contents, unlabelled=True
    )
    return issues.groupBy("severity", "rule").agg(F.count("*").alias("n"))


@query(
    "first_missing",
    """SELECT doc_id AS image_id FROM documents ANTI JOIN labels USING (doc_id)
ORDER BY doc_id LIMIT 10""",
)
def first_missing(inputs: Inputs) -> DataFrame:
    docs = inputs.table("documents").select(F.col("doc_id").alias("image_id"))
    labelled = inputs.table("labels").select(F.col("doc_id").alias("image_id"))
    return quality.first_missing(docs, labelled)
