"""Embedding whitening from variances alone.

For integers ``x`` the covariance of two dimensions follows from three
variances: ``2 cov(i, j) = var(i + j) - var(i) - var(j)``. Tasks add up the
exact squares of every centred dimension and of every centred sum of two
dimensions; the sums are whole numbers, so their order and the tasks' number
change nothing. The driver holds one number per pair of dimensions, whatever
the number of rows, and solves the symmetric eigenproblem.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import fields_and, written

# Rows turned into arrays at once.
BLOCK_ROWS = 4096
# Entries are exact as doubles and as longs below this size.
LARGEST = 2.0**42
# An eigenvalue below this share of the largest one counts as no variance.
LEAST_SHARE = 1e-13
_SAFE = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """Moments and components of ``floor(scale * c) + offset``.

    ``means`` are whole numbers next to the mean, ``rests`` what the sums have
    beyond ``n`` times these. ``values`` are eigenvalues in falling order,
    ``vectors`` their unit eigenvectors in columns, ``trace`` the total variance.
    """

    scale: int
    offset: int
    n: int
    means: tuple[int, ...]
    rests: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def kept(self, components: int) -> int:
        return min(components, len(self.means))


def fit(rows: DataFrame, *, scale: int = 1024, offset: int = 100_000, vector: str = "embedding") -> Whitening:
    """Moments, variances and components of all usable vectors.

    A vector that is null or holds a null or non-finite entry takes no part.
    Shorter vectors count as padded with entries of zero. An entry of 2**42 or
    more in size is refused with an error. Repeated rows count each.
    """
    source = rows.select(vector)
    sums = source.mapInArrow(_sums(scale, offset), "dim int, n long, total decimal(38,0)")
    found = {r["dim"]: r for r in sums.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
    n = found[-1]["n"] if -1 in found else 0
    dims = max(found, default=-1) + 1
    totals = [int(found[d]["total"]) + (n - found[d]["n"]) * offset for d in range(dims)]
    means = tuple((2 * s + n) // (2 * n) for s in totals)
    rests = tuple(s - n * m for s, m in zip(totals, means, strict=True))
    squares = source.mapInArrow(_squares(scale, offset, means), "i int, j int, total decimal(38,0)")
    exact = {(r["i"], r["j"]): int(r["total"]) for r in squares.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}

    def spread(i: int, j: int) -> int:
        """n**3 times the variance of dimension i, or of the sum of two."""
        rest = rests[i] if i == j else rests[i] + rests[j]
        return n * n * exact.get((i, j), 0) - n * rest * rest

    covariance = np.zeros((dims, dims))
    for i in range(dims):
        covariance[i, i] = spread(i, i) / n**3
        for j in range(i + 1, dims):
            covariance[i, j] = covariance[j, i] = (spread(i, j) - spread(i, i) - spread(j, j)) / (2 * n**3)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    largest = np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None, :], 0) if dims else vectors
    trace = sum(spread(i, i) for i in range(dims)) / n**3 if n else 0.0
    return Whitening(scale, offset, n, means, rests, values, vectors * np.where(largest < 0, -1.0, 1.0), trace)


def project(rows: DataFrame, model: Whitening, components: int = 8, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per usable row: key, ``deviation`` as decimal(38,0), and ``whitened``, an array of the first components.

    ``deviation`` is the exact sum over dimensions of ``(n * x - S)**2``. A
    component without variance is null.
    """
    schema = fields_and(rows.select(vec_id), "deviation decimal(38,0), whitened array<double>")
    return rows.select(vec_id, vector).mapInArrow(_projected(model, components, vec_id), schema)


def whiten(rows: DataFrame, components: int = 8, *, scale: int = 1024, offset: int = 100_000, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Each usable vector in whitened components: one row per vector and component.

    Columns: the key, ``component`` from 1, ``n``, ``deviation`` as
    decimal(38,0), ``whitened``, ``explained`` (share of the total variance) and
    ``identity_error``: how far the covariance of all whitened rows, measured
    on them, is from the identity at most. Rules for vectors as in :func:`fit`.
    Equal and null keys are rows of their own. Vectors of fewer dimensions than
    ``components`` have as many as dimensions. Where a component has no
    variance, as in tables of one row or of equal rows, ``whitened`` is null,
    and ``identity_error`` speaks of the others. Other columns are not read. A
    table without usable vectors gives no rows.
    """
    model = fit(rows, scale=scale, offset=offset, vector=vector)
    k = model.kept(components)
    made = written(project(rows, model, components, vec_id=vec_id, vector=vector), "whitened")
    names = [f"w{c}" for c in range(k)]
    wide = made.select(*[F.col("whitened")[c].alias(name) for c, name in enumerate(names)])
    error = _identity_error(wide, [c for c in names if model.values[names.index(c)] > _least(model)])
    explained = F.lit([float(v / model.trace) if model.trace else 0.0 for v in model.values[:k]] or [0.0])
    return made.select("*", F.posexplode("whitened").alias("_at", "_w")).select(
        F.col(vec_id),
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("_w").alias("whitened"),
        explained[F.col("_at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _least(model: Whitening) -> float:
    return LEAST_SHARE * float(model.values[0]) if len(model.values) else 0.0


def _identity_error(wide: DataFrame, names: list[str]) -> float | None:
    """Largest absolute entry of the columns' covariance less the identity."""
    if not names:
        return None
    means = wide.agg(*[F.avg(c).alias(c) for c in names]).first()
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    found = wide.agg(*[F.avg((F.col(a) - means[a]) * (F.col(b) - means[b])) for a, b in pairs]).first()
    return max(abs(found[k] - (a == b)) for k, (a, b) in enumerate(pairs))


def _blocks(batches: Iterator[pa.RecordBatch], column: int, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in the batch, lengths, and the integers of usable vectors, padded to the longest of a block."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            lists = batch.column(column).slice(first, BLOCK_ROWS)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            parents = np.repeat(np.arange(len(lists)), sizes)
            entries = pc.cast(pc.list_flatten(lists), pa.float64())
            values = pc.fill_null(entries, float("nan")).to_numpy(zero_copy_only=False)
            usable = lists.is_valid().to_numpy(zero_copy_only=False).copy()
            finite = np.isfinite(values)
            usable[parents[~finite]] = False
            if (np.abs(values[finite & usable[parents]]) >= LARGEST).any():
                raise ValueError("an entry is too large to be exact")
            width = int(sizes[usable].max(initial=0))
            matrix = np.full((len(lists), width), offset, np.int64)
            inside = usable[parents]
            places = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            matrix[parents[inside], places[inside]] = np.floor(scale * values[inside]).astype(np.int64) + offset
            yield batch, first + np.flatnonzero(usable), sizes[usable], matrix[usable]


def _widened(x: np.ndarray, dims: int, offset: int) -> np.ndarray:
    return x if x.shape[1] == dims else np.pad(x, ((0, 0), (0, dims - x.shape[1])), constant_values=offset)


def _exact(x: np.ndarray) -> list[int]:
    """Column sums of whole numbers without overflow."""
    if len(x) and x.shape[1] and int(np.abs(x).max()) * len(x) >= _SAFE:
        x = x.astype(object)
    return [int(v) for v in x.sum(0)]


def _sums(scale: int, offset: int):
    """Per task: rows under dimension -1, and of each dimension the vectors that have it and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts, totals = 0, [], []
        for _, places, sizes, x in _blocks(batches, 0, scale, offset):
            rows += len(places)
            width = x.shape[1]
            counts += [0] * (width - len(counts))
            totals += [0] * (width - len(totals))
            here = (sizes[:, None] > np.arange(width)).sum(0)
            for d, (have, total) in enumerate(zip(here, _exact(x), strict=True)):
                counts[d] += int(have)
                totals[d] += total - (len(places) - int(have)) * offset
        yield _numbers(["dim", "n", "total"], [-1, *range(len(counts))], pa.array([rows, *counts], pa.int64()), [0, *totals])

    return run


def _numbers(names: list[str], first: list[int], second: pa.Array, totals: list[int]) -> pa.RecordBatch:
    exact = pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), second, exact], names)


def _squares(scale: int, offset: int, means: tuple[int, ...]):
    """Per task the exact squares of each centred dimension (i, i) and of each centred sum (i, j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = len(means)
        mean = np.array(means, np.int64)
        totals = [[0] * (dims - i) for i in range(dims)]
        for _, _, _, x in _blocks(batches, 0, scale, offset):
            z = _widened(x, dims, offset) - mean
            if z.size and (2 * int(np.abs(z).max())) ** 2 * len(z) >= _SAFE:
                z = z.astype(object)
            for i in range(dims if len(z) else 0):
                paired = z[:, i:] + z[:, [i]]
                paired[:, 0] = z[:, i]
                totals[i] = [t + int(v) for t, v in zip(totals[i], (paired * paired).sum(0), strict=True)]
        first = [i for i in range(dims) for _ in range(i, dims)]
        second = pa.array([j for i in range(dims) for j in range(i, dims)], pa.int32())
        yield _numbers(["i", "j", "total"], first, second, [t for row in totals for t in row])

    return run


def _projected(model: Whitening, components: int, vec_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims, n = model.kept(components), len(model.means), model.n
        mean = np.array(model.means, np.int64)
        rest = np.array(model.rests, object)
        shift = np.array([r / n for r in model.rests])
        values = model.values[:k]
        with np.errstate(divide="ignore"):
            factors = np.where(values > _least(model), model.vectors[:, :k] / np.sqrt(values), np.nan)
        for batch, places, _, x in _blocks(batches, 1, model.scale, model.offset):
            z = _widened(x, dims, model.offset) - mean
            whitened = ((z - shift) @ factors).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * k), pa.array(whitened, mask=np.isnan(whitened)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places)), _deviations(z, rest, n), lists], [vec_id, "deviation", "whitened"])

    return run


def _deviations(z: np.ndarray, rest: np.ndarray, n: int) -> pa.Array:
    """Sum over dimensions of (n * z - rest)**2, whatever its size."""
    small = not z.size or int(np.abs(z).max()) ** 2 * z.shape[1] < _SAFE
    exact = z if small else z.astype(object)
    squares, cross = (exact * exact).sum(1).astype(object), z.astype(object) @ rest
    whole = squares * (n * n) - cross * (2 * n) + int((rest * rest).sum())
    return pa.array([Decimal(int(v)) for v in whole], pa.decimal128(38, 0))
