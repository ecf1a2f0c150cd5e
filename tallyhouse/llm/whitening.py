"""Whitening of embeddings along the leading eigenvectors of their covariance.

Entries become whole numbers, so that counts and sums of the fit are exact. The covariance is summed in tasks, centred first,
as one row per pair of dimensions, which Spark adds up; what reaches the driver is as large as the square of the dimension,
whatever the number of vectors. The eigenvectors are found there by spectrum slicing (see `spectrum`).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.spectrum import EPS, leading

COMPONENTS = 32
GRID, ORIGIN = 64, 1_000_000  # an entry c becomes floor(GRID * c) + ORIGIN
ROWS = 2048  # vectors worked on at a time
LARGEST = 1 << 51  # whole numbers are held within this, as are all of entries below 3e13
_PLACED = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])


class Fit(NamedTuple):
    n: int
    total: np.ndarray  # exact sum of the whole numbers of each dimension
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, as columns
    trace: float
    identity_error: float  # largest entry of |covariance of the whitened vectors - identity|


def vectors_of(table: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows whose vector is not null and holds neither a null nor a non-finite entry."""
    entries = F.col(column).cast("array<double>")
    whole = F.forall(entries, lambda e: e.isNotNull() & (F.abs(e) < float("inf")))
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("vector")).where(F.col("vector").isNotNull() & whole)


def _centred(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, whole numbers less the origin) of some rows at a time; a short vector goes on with zeros."""
    column = batch["vector"]
    for k in range(0, len(column), ROWS):
        part = column.slice(k, ROWS)
        sizes, flat = part.value_lengths().to_numpy(zero_copy_only=False), part.flatten().to_numpy(zero_copy_only=False)
        out = np.zeros((len(part), dims))
        out[np.arange(dims) < sizes[:, None]] = flat
        yield k, np.clip(np.floor(GRID * out), -LARGEST, LARGEST).astype(np.int64)


def _sums(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, object)
        for batch in batches:
            for _, x in _centred(batch, dims):
                n, total = n + len(x), total + x.sum(0)
        yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dims), pa.int32()), "n": [n] * dims, "total": [str(t) for t in total]})

    rows = vectors.mapInArrow(run, "dim int, n long, total string").groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    n = rows[0].n if rows else 0
    total = [0] * dims
    for r in rows:
        total[r.dim] = int(r.total) + n * ORIGIN
    return n, total


def _products(vectors: DataFrame, dims: int, made, out_dims: int) -> np.ndarray:
    """Sum over all vectors of the outer product of `made` (a function of the whole numbers) with itself, `out_dims` wide."""
    upper = np.triu_indices(out_dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((out_dims, out_dims))
        for batch in batches:
            for _, x in _centred(batch, dims):
                y = made(x)
                total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": upper[0].astype(np.int32), "j": upper[1].astype(np.int32), "total": total[upper]})

    out = np.zeros((out_dims, out_dims))
    for r in vectors.mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.total
    return out


def _projection(n: int, total: list[int], values: np.ndarray, vectors: np.ndarray):
    """The function from whole numbers less the origin to whitened vectors."""
    mean = np.array([(s - n * ORIGIN) / n for s in total])
    axes = vectors / np.sqrt(values)
    return lambda x: (x - mean) @ axes


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit:
    """Exact sums, covariance and its leading eigenpairs; `vectors` comes from `vectors_of` and is read four times.

    The dimension is that of the longest vector. Components without variance (as from repeated rows only, or beyond the number
    of vectors) cannot be scaled to one and are left out; no vector at all gives a fit without components.
    """
    dims = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    n, total = _sums(vectors, dims) if dims else (vectors.count(), [])
    if not n or not dims:
        return Fit(n, np.array(total, dtype=object), np.zeros(0), np.zeros((dims, 0)), 0.0, 0.0)
    mean = np.array([(s - n * ORIGIN) / n for s in total])
    covariance = _products(vectors, dims, lambda x: x - mean, dims) / n
    values, axes = leading(covariance, components)
    trace = float(np.trace(covariance))
    kept = values > 16 * dims * EPS * trace
    values, axes = values[kept], axes[:, kept]
    error = 0.0
    if len(values):
        again = _products(vectors, dims, _projection(n, total, values, axes), len(values)) / n
        error = float(np.abs(again - np.eye(len(values))).max())
    return Fit(n, np.array(total, dtype=object), values, axes, trace, error)


def whiten(vectors: DataFrame, by: Fit) -> DataFrame:
    """One row a vector: vec_id, deviation (sum over dimensions of (n * x - S)^2, exact; null where it exceeds a long) and the
    whitened vector, an entry a component. Repeated rows and ids stay as they are. The fit is sent to the tasks; its size is
    dimension times components."""
    dims, total, n = len(by.total), by.total, by.n
    near = np.array([int(s) - n * ORIGIN for s in total], dtype=object)
    project = _projection(n, total.tolist(), by.values, by.vectors) if dims and n else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["vec_id"]
            for k, x in _centred(batch, dims):
                rough = ((x - (near / n).astype(np.float64)) ** 2).sum(1) * float(n) * n if dims else np.zeros(len(x))
                if dims and (np.abs(x).max() if x.size else 0) * n < 2**62 and rough.max(initial=0) < 2**62:
                    exact = ((n * x - near.astype(np.int64)) ** 2).sum(1).tolist()
                else:
                    exact = [int(((n * row.astype(object) - near) ** 2).sum()) if dims else 0 for row in x]
                    exact = [e if e < 2**63 else None for e in exact]
                white = project(x) if project else np.zeros((len(x), 0))
                width = white.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays([ids.slice(k, len(x)), pa.array(exact, pa.int64()), lists], schema=_PLACED)

    return vectors.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def components_of(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row a remaining vector and component, with the share of the variance and the error of the whole fit."""
    vectors = vectors_of(table)
    by = fit(vectors, components)
    shares = F.array(*[F.lit(float(e / by.trace)) for e in by.values]).cast("array<double>")
    return whiten(vectors, by).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(by.n).cast("long").alias("n"), "deviation", F.col("value").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"), F.lit(by.identity_error).alias("identity_error"),
    )
