"""Whitening of vectors along the leading eigenvectors of their covariance.

The covariance ``V`` is never formed. A product ``V @ Q`` is one pass over the written table: each task
centres its rows, multiplies them with the few columns of ``Q`` and adds up; one row per dimension and task is
summed by Spark. What comes to the driver is as long as a vector and as wide as a block, whatever the number
of rows.

The eigenvectors come from a block Jacobi-Davidson iteration: Rayleigh-Ritz in a small subspace, the leading
pairs whose residual has reached double precision are locked, and the subspace grows by approximate solutions
of the projected correction equations, found by a few MINRES steps for all columns of the block at once, so
that a step is one pass too. A last Rayleigh-Ritz step over all locked pairs, with products made anew, settles
their order and checks every residual.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import Scratch

#: Numbers that an entry is made of: ``floor(SCALE * entry) + SHIFT``.
SCALE, SHIFT = 64, 1_000_000
#: Vectors with an entry beyond this have no exact integers and take no part.
LARGEST = float(1 << 46)
COMPONENTS = 32
#: Columns of a product.
BLOCK = 32
#: MINRES steps for a correction.
INNER = 4
#: A residual of so many units of rounding of the largest eigenvalue is one of double precision.
ROUNDINGS = 64
#: Eigenvalues below this share of the largest are zero as far as doubles can tell; they have no component.
RANK = 1e-11
#: Rows that a task turns into components at a time.
SLICE = 2048


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Solutions, one for each column of ``right``, after ``steps`` steps of MINRES.

    ``product`` applies the symmetric operator of each column. A column whose Krylov space is used up stays.
    """

    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=b > 0)

    beta = np.linalg.norm(right, axis=0)
    small = beta * 1e-14
    x, before, v = np.zeros_like(right), np.zeros_like(right), over(right, beta)
    d, d_before = np.zeros_like(right), np.zeros_like(right)
    phi, link = beta.copy(), np.zeros_like(beta)
    cos, sin = -np.ones_like(beta), np.zeros_like(beta)
    delta, epsilon = np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        p = product(v) - before * link
        alpha = (v * p).sum(0)
        p -= v * alpha
        link = np.linalg.norm(p, axis=0)
        link[link <= small] = 0
        across, turned = cos * delta + sin * alpha, sin * delta - cos * alpha
        epsilon_next, delta = sin * link, -cos * link
        length = np.hypot(turned, link)
        cos, sin = over(turned, length), over(link, length)
        d, d_before = over(v - across * d - epsilon * d_before, length), d
        x += cos * phi * d
        phi, epsilon = sin * phi, epsilon_next
        before, v = v, over(p, link)
        if not phi.any() or not link.any():
            break
    return x


def _orthonormal(columns: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to ``against`` (orthonormal themselves)."""
    for _ in range(2):
        for other in against:
            columns = columns - other @ (other.T @ columns)
        lengths = np.linalg.norm(columns, axis=0)
        columns = columns[:, lengths > 0] / lengths[lengths > 0]
        if not columns.shape[1]:
            return columns
        left, sizes, _ = np.linalg.svd(columns, full_matrices=False)
        columns = left[:, sizes > 1e-8]
    return columns


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray],
    size: int,
    wanted: int = COMPONENTS,
    block: int = BLOCK,
    inner: int = INNER,
    seed: int = 0,
    most: int = 1000,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) and unit eigenvectors (columns) of a symmetric operator.

    ``product`` takes up to ``block`` columns. ``most`` bounds the outer steps; if they don't suffice, that is an error.
    """
    wanted, block = min(wanted, size), min(block, size)
    random = np.random.default_rng(seed)

    def applied(columns: np.ndarray) -> np.ndarray:
        return np.hstack([product(columns[:, i : i + block]) for i in range(0, columns.shape[1], block)])

    def ritz(basis: np.ndarray, images: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        return values, basis, images, np.linalg.norm(images - basis * values, axis=0)

    locked = np.empty((size, 0))
    basis = _orthonormal(random.standard_normal((size, block)))
    images = applied(basis)
    top, best, stalled = 0.0, np.inf, 0
    for _ in range(most):
        values, basis, images, residuals = ritz(basis, images)
        top = max(top, float(np.abs(values).max(initial=0)))
        bound = ROUNDINGS * np.finfo(float).eps * top
        good = residuals <= bound
        whole = locked.shape[1] + basis.shape[1] == size
        # In the whole space, or where steps gain nothing any more, what is left is rounding.
        stalled = stalled + 1 if residuals[0] > 0.5 * best else 0
        best = min(best, residuals[0])
        if residuals[0] <= 64 * bound and (whole or stalled > 3):
            good = good | (residuals <= 64 * bound)
        n = int(np.argmin(good)) if not good.all() else len(good)
        n = min(n, wanted - locked.shape[1])
        if n:
            locked, basis, images, values, residuals = np.hstack([locked, basis[:, :n]]), basis[:, n:], images[:, n:], values[n:], residuals[n:]
            best, stalled = np.inf, 0
        if locked.shape[1] == wanted:
            values, vectors, _, residuals = ritz(_orthonormal(locked), applied(_orthonormal(locked)))
            if (residuals <= 64 * bound).all():
                return values, vectors
            locked, basis, images = np.empty((size, 0)), vectors, applied(vectors)
            continue
        count = min(block, wanted - locked.shape[1], basis.shape[1])
        added = np.empty((size, 0))
        if count and not whole:
            near, shifts = basis[:, :count], values[:count]
            held = np.hstack([locked, near])

            def projected(columns: np.ndarray) -> np.ndarray:
                columns = columns - held @ (held.T @ columns)
                columns = applied(columns) - columns * shifts
                return columns - held @ (held.T @ columns)

            right = near * shifts - images[:, :count]
            added = _orthonormal(minres(projected, right - held @ (held.T @ right), inner), locked, basis)
        if not added.shape[1] and not whole:
            added = _orthonormal(random.standard_normal((size, min(block, size - locked.shape[1] - basis.shape[1]))), locked, basis)
        if whole:
            # Products of rotated columns carry rounding along; made anew they don't.
            basis = _orthonormal(basis, locked)
            images = applied(basis)
            continue
        if basis.shape[1] + added.shape[1] > wanted + 4 * block:
            keep = max(wanted - locked.shape[1], block) + block
            basis, images = basis[:, :keep], images[:, :keep]
        basis, images = np.hstack([basis, added]), np.hstack([images, applied(added)])
    raise ArithmeticError(f"no convergence to double precision in {most} steps")


@dataclass
class Whitening:
    """Components of the vectors of one length: what :func:`whiten` needs of them."""

    length: int
    n: int
    #: Sums per dimension as whole parts of the mean and what is left of ``n`` times it.
    mean: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def axes(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def integers(vectors: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """``vec_id`` and ``x`` of the vectors that take part: no null or non-finite entry, one entry at least."""
    values = F.col(f"`{vector}`").cast("array<double>")
    good = F.forall(values, lambda v: v.isNotNull() & (F.abs(v) <= LARGEST)) & (F.size(values) > 0)
    x = F.transform("v", lambda v: F.floor(v * SCALE).cast("long") + SHIFT)
    return vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), values.alias("v")).filter(F.coalesce(good, F.lit(False))).select("vec_id", x.alias("x"))


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, length)


def _sums(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    total = [0] * length
    for batch in batches:
        x = _matrix(batch, length)
        # In halves, as the sum of a batch may not fit 64 bits.
        high, low = (x >> 24).sum(0).tolist(), (x & 0xFFFFFF).sum(0).tolist()
        total = [t + (h << 24) + w for t, h, w in zip(total, high, low, strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(length, dtype=np.int32)), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["dim", "total"])


def _centred(batch: pa.RecordBatch, length: int, mean: np.ndarray, part: np.ndarray) -> np.ndarray:
    return (_matrix(batch, length) - mean).astype(float) - part


def _added(rows: DataFrame, partial: Callable[[pa.RecordBatch], np.ndarray], height: int, width: int) -> np.ndarray:
    """The sum over all batches of ``partial``, ``height`` rows of ``width`` numbers."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for batch in batches:
            if batch.num_rows:
                total += partial(batch)
        values = pa.ListArray.from_arrays(pa.array(np.arange(height + 1, dtype=np.int32) * width), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(height, dtype=np.int32)), values], names=["dim", "part"])

    parts = rows.mapInArrow(of_task, "dim int, part array<double>")
    summed = parts.groupBy("dim").agg(F.array(*[F.sum(F.col("part")[j]) for j in range(width)]).alias("total"))
    out = np.zeros((height, width))
    for row in summed.collect():  # a row for each dimension
        out[row["dim"]] = row["total"]
    return out


def _fit(rows: DataFrame, length: int, wanted: int, block: int, inner: int, seed: int) -> Whitening:
    """Components of ``rows`` (``x``), all of one length."""
    n = rows.count()
    sums = {r["dim"]: int(r["total"]) for r in rows.mapInArrow(lambda b: _sums(b, length), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    mean = np.array([sums[i] // n for i in range(length)], np.int64)
    rest = np.array([sums[i] % n for i in range(length)], np.int64)
    part = rest / n
    width = min(block, length)
    spread = np.zeros(length)

    def product(columns: np.ndarray) -> np.ndarray:
        padded = np.pad(columns, ((0, 0), (0, width - columns.shape[1])))

        def partial(batch: pa.RecordBatch) -> np.ndarray:
            c = _centred(batch, length, mean, part)
            return np.hstack([c.T @ (c @ padded), (c * c).sum(0)[:, None]])

        found = _added(rows, partial, length, width + 1) / n
        spread[:] = found[:, width]
        return found[:, : columns.shape[1]]

    values, vectors = jacobi_davidson(product, length, wanted, block, inner, seed)
    real = values > RANK * max(values[0], 0)
    model = Whitening(length, n, mean, rest, values[real], vectors[:, real], float(spread.sum()))
    k, axes = int(real.sum()), model.axes
    if k:

        def moments(batch: pa.RecordBatch) -> np.ndarray:
            w = _centred(batch, length, mean, part) @ axes
            return np.vstack([w.T @ w, w.sum(0)])

        found = _added(rows, moments, k + 1, k) / n
        model.identity_error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    return model


def _deviations(k: np.ndarray, rest: np.ndarray, n: int) -> list[int]:
    """Sums over the entries of a row of ``(n * k - rest) ** 2``, exactly."""
    largest = int(np.abs(k).max(initial=0)) + 1
    if (n * largest) ** 2 * k.shape[1] < 1 << 62:
        return ((n * k - rest) ** 2).sum(1).tolist()
    if max(largest, 1 << 20) ** 2 * k.shape[1] < 1 << 62 and n < 1 << 40:
        squares, low, high = (k * k).sum(1), k @ (rest & 0xFFFFF), k @ (rest >> 20)
        last = sum(int(r) ** 2 for r in rest)
        return [n * n * s - 2 * n * (a + (b << 20)) + last for s, a, b in zip(squares.tolist(), low.tolist(), high.tolist(), strict=True)]
    return ((k.astype(object) * n - rest.astype(object)) ** 2).sum(1).tolist()


def _whitened(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    axes, k = model.axes, len(model.values)
    part, explained = model.rest / model.n, model.values / model.trace
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE):
            batch = whole.slice(start, SLICE)
            rows = batch.num_rows
            above = _matrix(batch, model.length) - model.mean
            w = (above.astype(float) - part) @ axes
            deviations = pa.array([Decimal(d) for d in _deviations(above, model.rest, model.n)], pa.decimal128(38, 0))
            at = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n)),
                    deviations.take(at),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def whiten(
    vectors: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    components: int = COMPONENTS,
    block: int = BLOCK,
    inner: int = INNER,
    seed: int = 0,
) -> DataFrame:
    """A row for each vector and component: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error``.

    An entry becomes the integer ``floor(64 * entry) + 1000000``. ``n`` is the number of vectors, ``deviation`` (38
    digits) the exact sum of ``(n * x - S) ** 2``, ``whitened`` the centred vector's place on the component over the
    root of its eigenvalue, ``explained`` the eigenvalue's share of the trace and ``identity_error`` the largest
    entry of the whitened covariance less the identity.

    Vectors that are null, empty, or hold null or non-finite entries, or one beyond 2^46, take no part. Repeated rows
    and IDs count as often as they come, and rows without an ID like others. Vectors of each length are a list of
    their own. There are no more components than the covariance has eigenvalues above rounding, so none for equal
    vectors, and no rows for them or for an empty table. Equal eigenvalues leave their components' directions open;
    all rows are given the same ones. Other columns are not read.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.table(integers(vectors, vector, vec_id), "integers")
    shape = rows.select("vec_id").schema.simpleString()[len("struct<") : -1].replace(":", " ")
    shape += ", component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    length = F.size("x")
    out = None
    # A few lengths, as vectors of one table come from a model or two; each is fitted by itself.
    for row in rows.groupBy(length.alias("length")).count().orderBy("length").collect():
        own = rows if out is None and row["count"] == rows.count() else rows.filter(length == row["length"])
        model = _fit(own.select("x"), row["length"], components, block, inner, seed)
        part = own.mapInArrow(lambda b, m=model: _whitened(b, m), shape)
        out = part if out is None else out.unionByName(part)
    return rows.limit(0).mapInArrow(lambda b: iter(()), shape) if out is None else out

