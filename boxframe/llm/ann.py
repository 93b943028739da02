"""Approximate nearest neighbours by cross-polytope hashing.

A table rotates unit vectors by a pseudo-rotation (three rounds of random signs and a fast Hadamard
transform) and assigns each to the nearest signed axis. A query probes, in every table, the axes nearest to
it. Candidates are reranked by exact inner products in double precision.

Tables hold plain directions. Entries fall into ranges of norms that differ by a fourth of an octave, so that
within one the largest inner product is nearly the least angle. A range with no more entries than a table has
buckets (two for each dimension), such as that of some very long vectors, gains nothing from hashing: every query
meets all of it. Each range is thus searched like a table of its own, and none hides another. Equal vectors are one entry of the index, however many rows hold them. A bucket with many entries or queries
is worked on in blocks of bounded size, each by its own task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.llm.common import Scratch

TABLES = 8
PROBES = 18
#: Entries and queries of one bucket that a task gets at a time.
BLOCK = 4096
#: Ranges of norms in an octave.
RANGES = 4
#: Number of the table, with one bucket, of what is compared without hashing.
WHOLE = -1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows; their length is a power of two."""
    size, step = x.shape[1], 1
    while step < size:
        pair = x.reshape(len(x), -1, 2, step)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(len(x), size)
        step *= 2
    return x / np.sqrt(size)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, x.shape[1]))
    for row in signs:
        x = hadamard(x * row)
    return x


def buckets(x: np.ndarray, table: int, probes: int, seed: int) -> np.ndarray:
    """The nearest signed axes of each row, nearest first: 2 * axis, plus 1 for the negative one."""
    y = rotated(x, table, seed)
    near = np.stack([y, -y], 2).reshape(len(y), -1)
    probes = min(probes, near.shape[1])
    if probes == 1:
        return near.argmax(1)[:, None]
    some = np.argpartition(-near, probes - 1, 1)[:, :probes]
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(near, some, 1), 1), 1)


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors padded to a power-of-two length, and the binary logarithms of the norms."""
    top = np.abs(x).max(1, keepdims=True)
    x = x / top
    norms = np.sqrt((x * x).sum(1, keepdims=True))
    size = 1 << (x.shape[1] - 1).bit_length()
    return np.pad(x / norms, ((0, 0), (0, size - x.shape[1]))), (np.log2(top) + np.log2(norms))[:, 0]


def _by_length(batch: pa.RecordBatch, some: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and vectors of those rows of the batch, for each length among them."""
    column = batch.column("vector")
    lengths = column.value_lengths().to_numpy()[some]
    for length in np.unique(lengths):
        rows = some[lengths == length]
        yield int(length), rows, column.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), length)


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of the entry's range of norms. Half a range more keeps unit vectors together."""
    for batch in batches:
        if batch.num_rows:
            ranges = np.empty(batch.num_rows, np.int32)
            for _, rows, vectors in _by_length(batch, np.arange(batch.num_rows)):
                ranges[rows] = np.floor(RANGES * directions(vectors)[1] + 0.5)
            yield batch.append_column("range", pa.array(ranges))


def _hashed(batches: Iterator[pa.RecordBatch], tables: int, probes: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Places of each row: those of the tables if ``hashed``, and that of no hashing if ``whole``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        whole, some = (np.flatnonzero(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("whole", "hashed"))
        places = [(length, WHOLE, np.zeros(len(rows), np.int32), rows) for length, rows, _ in _by_length(batch, whole)]
        for length, rows, vectors in _by_length(batch, some):
            unit = directions(vectors)[0]
            for table in range(tables):
                found = buckets(unit, table, probes, seed)
                places.append((length, table, found.ravel().astype(np.int32), np.repeat(rows, found.shape[1])))
        for length, table, bucket, row in places:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(row), length, np.int32)), pa.array(np.full(len(row), table, np.int32)), pa.array(bucket), batch.column("entry").take(pa.array(row)), batch.column("vector").take(pa.array(row))],
                names=["length", "table", "bucket", "entry", "vector"],
            )


def _best(entries: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The ``k`` best entries of the block for each query of the block, those of one score by their number."""
    ids = entries.column("entry").to_numpy()
    x = np.stack(entries.column("vector").to_numpy()).astype(float) if len(entries) else np.empty((0, 1))
    asked, out = queries.column("entry").to_numpy(), []
    if len(entries) and len(queries):
        q = np.stack(queries.column("vector").to_numpy()).astype(float)
        # What a product's rounding can change, in any order of summing.
        wide = 4 * x.shape[1] * np.finfo(float).eps * np.sqrt((x * x).sum(1))
        for start in range(0, len(q), 256):
            part = q[start : start + 256]
            scores, slack = part @ x.T, np.sqrt((part * part).sum(1, keepdims=True)) * wide
            # All that may reach place k, ties at its score among them.
            least = -np.partition(slack - scores, k - 1, 1)[:, k - 1 : k] if len(x) > k else -np.inf
            row, col = np.nonzero(~(scores + slack < least))
            # Summed anew in a fixed order, so that a pair's score is the same in every block.
            exact = np.concatenate([(x[col[i : i + 65536]] * part[row[i : i + 65536]]).sum(1) for i in range(0, len(row), 65536)])
            order = np.lexsort((ids[col], -exact, row))
            first = np.searchsorted(row, np.arange(len(part)))
            order = order[np.arange(len(row)) - first[row] < k]
            out.append((asked[start : start + 256][row[order]], ids[col[order]], exact[order]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    return pa.table({"query": pa.array(columns[0], pa.int64()), "entry": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})


def usable(vectors: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part, one for each ID."""
    values = F.col(f"`{vector}`").cast("array<double>")
    good = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(values, lambda v: v != 0)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), values.alias("vector")).filter(F.coalesce(good, F.lit(False)) & F.col("vec_id").isNotNull())
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    tables: int = TABLES,
    probes: int = PROBES,
    seed: int = 0,
    small: int | None = None,
) -> DataFrame:
    """The ``k`` nearest found of each query: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    Queries are the rows for which ``is_query`` (of ``vec_id``) holds, candidates all rows but the query's
    own. A query that meets fewer than ``k`` candidates is compared with all. Ranges of norms with at most
    ``small`` entries (as many as a table has buckets by default) aren't hashed. ``score`` is the inner product,
    largest first, ties by the smaller ID. Vectors that are null, zero
    or hold null or non-finite components take no part, nor do rows without an ID. Vectors of each length are
    searched by themselves, as others have no inner product with them. Of rows with one ID the least vector counts. Other columns are not read. An empty
    table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.table(usable(vectors, vector, vec_id), "rows")
    # An entry of the index is a distinct vector, named by its least ID; the k + 1 least IDs are all that a
    # query can need, one of them being its own.
    ranked = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    members = rows.withColumn("place", ranked).filter(F.col("place") <= k + 1)
    distinct = members.groupBy("vector").agg(F.min("vec_id").alias("entry"), F.sort_array(F.collect_list("vec_id")).alias("members")).select("entry", "vector", "members")
    entries = scratch.table(distinct.mapInArrow(_ranged, "entry bigint, vector array<double>, members array<bigint>, range int"), "entries")
    # The exponents of doubles bound the number of ranges of a length.
    length = F.size("vector")
    most = 2 * F.col("length_of") if small is None else F.lit(small)
    few = scratch.table(entries.groupBy(length.alias("length_of"), F.col("range").alias("of")).count().filter(F.col("count") <= most).select("length_of", "of"), "few")
    whole = F.col("of").isNotNull()
    shape = "length int, table int, bucket int, entry bigint, vector array<double>"
    indexed = entries.join(few, (length == F.col("length_of")) & (F.col("range") == F.col("of")), "left").select("entry", "vector", whole.alias("whole"), (~whole).alias("hashed"))
    queries = rows.filter(is_query).select(F.col("vec_id").alias("entry"), "vector")
    keys = ["length", "table", "bucket"]

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    def ranked(index: DataFrame, asked: DataFrame) -> DataFrame:
        """The nearest of what the queries meet in the index; both have ``whole`` and ``hashed``."""
        placed = index.mapInArrow(lambda b: _hashed(b, tables, 1, seed), shape)
        wanted = asked.mapInArrow(lambda b: _hashed(b, tables, probes, seed), shape)
        # A row for each bucket: two per axis and table of a length.
        counts = scratch.table(blocks(placed, "entry_blocks").join(blocks(wanted, "query_blocks"), keys), "counts")

        def dealt(df: DataFrame, own: str, other: str, first: bool) -> DataFrame:
            mine = F.pmod(F.xxhash64("entry"), F.col(own)).cast("int")
            theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
            parts = df.join(counts, keys).select(*keys, "entry", "vector", mine.alias("mine"), theirs.alias("theirs"))
            return parts.select(*keys, F.col("mine" if first else "theirs").alias("b1"), F.col("theirs" if first else "mine").alias("b2"), "entry", "vector")

        left = dealt(placed, "entry_blocks", "query_blocks", True).groupBy(*keys, "b1", "b2")
        right = dealt(wanted, "query_blocks", "entry_blocks", False).groupBy(*keys, "b1", "b2")
        found = left.cogroup(right).applyInArrow(lambda a, b: _best(a, b, k + 1), "query bigint, entry bigint, score double")
        # A query meets a near entry in several tables.
        merged = found.groupBy("query", "entry").agg(F.max("score").alias("score"))
        best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
        kept = merged.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
        named = kept.join(entries.select(F.col("entry").alias("entry_of"), "members"), F.col("entry") == F.col("entry_of")).select("query", "score", F.explode("members").alias("vec_id"))
        final = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        out = named.filter("vec_id <> query").withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
        return out.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")

    yes, no = F.lit(True), F.lit(False)
    out = scratch.table(ranked(indexed, queries.withColumns({"whole": yes, "hashed": yes})), "found")
    # Fewer than k rows are all that a query has met. If its length has more, it is compared with all of it.
    sizes = scratch.table(rows.groupBy(length.alias("length_of")).agg((F.count("*") - 1).alias("others")), "sizes")
    counted = out.groupBy("query_id").agg(F.count("*").alias("met"))
    judged = queries.join(counted, F.col("entry") == F.col("query_id"), "left").join(sizes, length == F.col("length_of"))
    short = scratch.table(judged.filter(F.coalesce("met", F.lit(0)) < F.least(F.lit(k), "others")).select("entry", "vector"), "short")
    if short.isEmpty():
        return out
    again = ranked(entries.withColumns({"whole": yes, "hashed": no}), short.withColumns({"whole": yes, "hashed": no}))
    return out.join(short.select(F.col("entry").alias("query_id")), "query_id", "left_anti").unionByName(again)
