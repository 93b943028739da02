"""Near-duplicate vectors: all pairs whose cosine reaches a threshold, by quantised tile products.

Vectors are dealt to the nearest of a bounded number of pivots, and a cell to blocks of at most a tile. Two tiles
are multiplied as 8-bit integers, each vector with a scale of its own. What rounding to integers took from a vector
is known as a length, so by Cauchy-Schwarz a pair's cosine is known up to the two lengths (and their product). Pairs
surely below go, pairs surely above link, and only pairs in between are worked out again in double precision.

Angles add up at most, which saves products without losing a pair: a vector isn't sent to a cell that it is too far
from, and where all pairs of two cells are surely near (the core of a cell is, by its radius), each vector is counted
against the whole cell. So a large group of near copies costs as much as it has vectors. Vectors in no such order,
as random ones, meet tile by tile; each is sent once for each tile then, and the work is that of all pairs, which
an exact count of links asks for.

A pair of tiles gives a count for each of its vectors and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import Scratch, components

THRESHOLD = 0.9
#: Vectors of a tile.
TILE = 8192
#: Most pivots, and so cells; they and a few numbers for each pair of cells are held by the driver and each task.
CELLS = 256
#: Rows and columns that are multiplied at a time, and rows that are dealt at a time.
STEP, SLICE = 1024, 512
#: Angles from rounded cosines are off by up to the root of the rounding.
SLACK = 1e-6
#: Dimensions whose 8-bit products sum up exactly in a 32-bit float: 127 ** 2 * 1024 < 2 ** 24.
EXACT = 1024

PLACED = "entry bigint, weight bigint, part int, block_hash bigint, angle double, x array<double>"
DEALT = "p int, i int, q int, j int, side int, entry bigint, weight bigint, x array<double>"


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows over a power of two, so that the largest entry is near 1: no product over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def angles(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(u @ v.T, -1, 1))


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows as 8-bit integers, their scales, and bounds of the lengths that rounding took."""
    scale = np.abs(u).max(1) / 127
    whole = np.rint(u / scale[:, None])
    lost = u - whole * scale[:, None]
    return whole.astype(np.int8), scale, np.sqrt((lost * lost).sum(1)) * (1 + 1e-9) + 1e-12


def integer_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 8-bit rows, exactly: in floats that hold the sums of so many dimensions."""
    if a.shape[1] <= EXACT:
        return a.astype(np.float32) @ b.astype(np.float32).T
    parts = range(0, a.shape[1], EXACT)
    return sum((a[:, k : k + EXACT].astype(np.float32) @ b[:, k : k + EXACT].astype(np.float32).T).astype(float) for k in parts)


class Forest:
    """Components of numbered nodes, by hooking larger roots to smaller ones."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots()[a], self.parent[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def roots(self) -> np.ndarray:
        while (above := self.parent[self.parent]).tobytes() != self.parent.tobytes():
            self.parent = above
        return self.parent


def links(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of ``x`` and ``y`` whose cosine reaches the threshold; of one tile (``same``) each pair once."""
    norms = [np.sqrt((v * v).sum(1)) for v in (x, y)]
    (qa, sa, ea), (qb, sb, eb) = (quantised(v / n[:, None]) for v, n in zip((x, y), norms, strict=True))
    for r in range(0, len(x), STEP):
        rows = slice(r, r + STEP)
        for c in range(r if same else 0, len(y), STEP):
            cols = slice(c, c + STEP)
            whole = integer_product(qa[rows], qb[cols])
            # A first cut by the largest loss among the columns leaves few pairs for their own bounds.
            most = eb[cols].max()
            least = (threshold - ea[rows] - most - ea[rows] * most) / sa[rows] - 1e-5 / sa[rows]
            i, j = np.nonzero(whole * sb[cols].astype(whole.dtype) >= least[:, None].astype(whole.dtype))
            guess = whole[i, j].astype(float)
            i, j = i + r, j + c
            if same:
                above = j > i
                i, j, guess = i[above], j[above], guess[above]
            guess *= sa[i] * sb[j]
            bound = ea[i] + eb[j] + ea[i] * eb[j]
            sure = guess - bound >= threshold
            open_ = np.flatnonzero(~sure & (guess + bound >= threshold))
            size = max(1, (1 << 22) // x.shape[1])
            for k in range(0, len(open_), size):
                some = open_[k : k + size]
                a, b = i[some], j[some]
                sure[some] = (x[a] * y[b]).sum(1) / (norms[0][a] * norms[1][b]) >= threshold
            yield i[sure], j[sure]


def _compared(part: pa.Table, threshold: float) -> pa.Table:
    """Of a pair of tiles: ``entry``, ``n`` (weight of what it links with) and ``other`` (an edge of the forest)."""
    part = part.sort_by([("side", "ascending"), ("entry", "ascending")])
    ids, weights, side = (part.column(c).to_numpy() for c in ("entry", "weight", "side"))
    x = part.column("x").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    first = int((side == 0).sum())
    same = part.column("p")[0].as_py() == part.column("q")[0].as_py() and part.column("i")[0].as_py() == part.column("j")[0].as_py()
    offset = 0 if same else first
    counts, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
    if first and (same or first < len(ids)):
        for a, b in links(x[:first], x[offset:], threshold, same):
            b = b + offset
            counts += np.bincount(a, weights[b], len(ids)).astype(np.int64) + np.bincount(b, weights[a], len(ids)).astype(np.int64)
            forest.join(a, b)
    some = counts > 0
    roots = forest.roots()
    return pa.table({"entry": pa.array(ids[some]), "n": pa.array(counts[some]), "other": pa.array(ids[roots[some]])})


def _placed(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, core: float) -> Iterator[pa.RecordBatch]:
    """Adds the nearest pivot's part (2 * cell, plus 1 within the core) and the angle to the pivot."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
            away = angles(units(x), pivots)
            cell = away.argmin(1)
            angle = away[np.arange(len(x)), cell]
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(scaled(x).ravel()))
            columns = [batch.column("entry"), batch.column("weight"), pa.array((2 * cell + (angle <= core)).astype(np.int32)), batch.column("block_hash"), pa.array(angle), values]
            yield pa.RecordBatch.from_arrays(columns, names=["entry", "weight", "part", "block_hash", "angle", "x"])


class Cells:
    """What is known of all parts: pivots, radii, blocks, and which pairs of parts are compared or all linked."""

    def __init__(self, pivots: np.ndarray, rows: list, tile: int, threshold: float):
        parts = 2 * len(pivots)
        self.pivots, self.alpha = pivots, math.acos(threshold)
        self.radius, self.blocks, self.weight = np.zeros(parts), np.zeros(parts, int), np.zeros(parts, np.int64)
        self.first = np.full(parts, -1, np.int64)
        for row in rows:
            p = row["part"]
            self.radius[p], self.blocks[p], self.weight[p], self.first[p] = row["radius"], -(-row["n"] // tile), row["weight"], row["first"]
        between = np.repeat(np.repeat(angles(pivots, pivots), 2, 0), 2, 1)
        between[np.arange(parts), np.arange(parts)] = 0
        reach, there = self.radius[:, None] + self.radius, self.blocks > 0
        there = there[:, None] & there
        self.linked = there & (between + reach <= self.alpha - SLACK)
        self.compared = there & ~self.linked & (between - reach <= self.alpha + SLACK)


def _dealt(batches: Iterator[pa.RecordBatch], cells: Cells) -> Iterator[pa.RecordBatch]:
    """A row for each pair of tiles that a vector takes part in."""
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE):
            batch = whole.slice(start, SLICE)
            part, hashed = batch.column("part").to_numpy(), batch.column("block_hash").to_numpy()
            x = batch.column("x").flatten().to_numpy().reshape(len(part), -1)
            near = np.repeat(angles(units(x), cells.pivots), 2, 1) <= cells.radius + cells.alpha + SLACK
            row, other = np.nonzero(cells.compared[part] & near)
            own, block = part[row], (hashed % np.maximum(cells.blocks[part], 1))[row]
            times = cells.blocks[other]
            at = np.repeat(np.arange(len(row)), times)
            theirs = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            row, own, other, block = row[at], own[at], other[at], block[at]
            # The lesser of the two tiles stands first.
            late = (own > other) | (own == other) & (block > theirs)
            p, q = np.where(late, other, own), np.where(late, own, other)
            i, j = np.where(late, theirs, block), np.where(late, block, theirs)
            numbers = [pa.array(v.astype(np.int32)) for v in (p, i, q, j, late)]
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays([*numbers, *[batch.column(c).take(rows) for c in ("entry", "weight", "x")]], names=["p", "i", "q", "j", "side", "entry", "weight", "x"])


def _of_length(entries: DataFrame, scratch: Scratch, threshold: float, tile: int, cells: int) -> DataFrame:
    """Counts and edges (``entry``, ``n``, ``other``) of entries whose vectors have one length."""
    n = entries.count()
    sample = entries.orderBy("block_hash", "entry").limit(min(cells, -(-n // tile))).select("v").collect()
    pivots = units(np.array([row["v"] for row in sample], float))
    core = math.acos(threshold) / 2 - SLACK
    placed = scratch.table(entries.mapInArrow(lambda b: _placed(b, pivots, core), PLACED), "placed")
    stats = placed.groupBy("part").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"), F.max("angle").alias("radius"), F.min("entry").alias("first"))
    known = Cells(pivots, stats.collect(), tile, threshold)  # two rows a pivot
    dealt = placed.mapInArrow(lambda b: _dealt(b, known), DEALT)
    shape = "entry bigint, n bigint, other bigint"
    found = dealt.groupBy("p", "i", "q", "j").applyInArrow(lambda t: _compared(t, threshold), shape)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links with all of a part. The first of each part stands for it: a row links with one of them, firsts with all."""
        for batch in batches:
            if not batch.num_rows:
                continue
            part, entry = batch.column("part").to_numpy(), batch.column("entry").to_numpy()
            whole = known.linked[part]
            own = whole[np.arange(len(part)), part]
            n = whole @ known.weight - own * batch.column("weight").to_numpy()
            row, other = np.nonzero(whole & ((entry == known.first[part])[:, None] | (np.cumsum(whole, 1) == 1)))
            lone = np.unique(row, return_index=True)[1]
            amount = np.zeros(len(row), np.int64)
            amount[lone] = n[row[lone]]
            yield pa.RecordBatch.from_arrays([pa.array(entry[row]), pa.array(amount), pa.array(known.first[other])], names=["entry", "n", "other"])

    return found.unionByName(placed.mapInArrow(counted, shape))


def near_groups(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    tile: int = TILE,
    cells: int = CELLS,
) -> DataFrame:
    """A row for each row: ``vec_id``, ``n_links`` (other rows with a cosine of the threshold or more),
    ``component_id`` (least ID reachable by links, its own included) and ``kept`` (the two are equal).

    Vectors that are null, empty, zero or hold null or non-finite entries link with nothing, nor do vectors of
    different lengths. Equal vectors are compared once, however many rows hold them, and all count. Rows of one ID are
    vectors of their own and count as others. A row without an ID takes part; it has the least ID it reaches, or
    none, and is kept if it has none. An empty table gives no rows. Other columns are not read.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    scratch = Scratch(vectors.sparkSession)
    values = F.col(f"`{vector}`").cast("array<double>")
    good = F.forall(values, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))) & F.exists(values, lambda v: v != 0)
    rows = scratch.table(vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.when(good, values).alias("v")), "rows")
    usable = rows.filter("v is not null")
    distinct = usable.groupBy("v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    block_hash = F.xxhash64("v").bitwiseAND(F.lit((1 << 62) - 1))
    entries = scratch.table(distinct.withColumns({"entry": F.monotonically_increasing_id(), "block_hash": block_hash, "length": F.size("v")}), "entries")
    parts = None
    # A few lengths, as vectors of one table come from a model or two.
    for row in entries.select("length").distinct().orderBy("length").collect():
        part = _of_length(entries.filter(F.col("length") == row["length"]), scratch, threshold, tile, cells)
        parts = part if parts is None else parts.unionByName(part)
    alone = F.col("vec_id")
    if parts is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), alone.alias("component_id"), F.lit(True).alias("kept"))
    parts = scratch.table(parts, "parts")
    counts = parts.groupBy("entry").agg(F.sum("n").alias("n"))
    nodes = components(vectors.sparkSession, parts.select(F.col("entry").alias("a"), F.col("other").alias("b")))
    named = scratch.table(entries.select("entry", "least").join(nodes, F.col("entry") == F.col("node"), "left").select("entry", "least", F.coalesce("component", "entry").alias("component")), "named")
    # Written, so that Spark can split a component that holds very many entries in the join.
    least = scratch.table(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    solved = named.join(least, "component").join(counts, "entry", "left").select("entry", "component_id", F.coalesce("n", F.lit(0)).alias("n"))
    known = scratch.table(entries.join(solved, "entry").select(F.col("v").alias("of"), "component_id", (F.col("n") + F.col("weight") - 1).alias("n")), "known")
    joined = rows.join(known, F.col("v") == F.col("of"), "left")
    component = F.when(F.col("of").isNull(), alone).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), alone.eqNullSafe(component).alias("kept"))
