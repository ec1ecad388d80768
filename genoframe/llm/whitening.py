"""Whitening of embeddings from a scatter matrix that is exact.

Components become integers. The fit list holds each distinct vector of integers once. Tasks subtract a shift, the least
vector, and add up sums S and cross-products in integers of any size: products of 18-bit digits are float64
matrix products without rounding, totals are Python's integers, and Spark adds them limb by limb. n XᵀX - SSᵀ is formed
of exact integers; only then it becomes floating point, correctly rounded, and is decomposed by eigh.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.exact import Scatter, as_longs, integers, largest, limbs, matrix, narrow, summed
from genoframe.scratch import written

#: Components of a vector, and lengths of vectors, at most: the driver holds a matrix for each length.
MOST_DIM, MOST_LENGTHS = 4096, 64


@dataclass
class Fit:
    """Of the vectors of one length: how many, their sums, components as columns with their variances, and all variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n x - S exactly, the centred rows on the components over the square roots of their variances); NaN where there is none."""
        centred = narrow(x, self.n * largest(x) + max(map(abs, self.sums)))
        centred = centred * self.n - np.array(self.sums, centred.dtype)
        with np.errstate(divide="ignore", invalid="ignore"):
            found = ((centred / self.n).astype(np.float64) @ self.components) / np.sqrt(self.variances)
        return centred, np.where(self.variances > 0, found, np.nan)


def decomposed(n: int, sums: list[int], cross: list[list[int]], shift: list[int], k: int) -> Fit:
    """The k first components; sums and cross are those of rows less the shift. The largest entry of a component is positive."""
    scatter = [[n * cross[i][j] - sums[i] * sums[j] for j in range(len(sums))] for i in range(len(sums))]
    covariance = np.array([[v / (n * n) for v in row] for row in scatter])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:k]
    values, vectors = values[order], vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    trace = sum(scatter[i][i] for i in range(len(sums))) / (n * n)
    # What eigh leaves of a direction without variance is rounding of the largest value.
    values = np.where(values > len(sums) * np.finfo(float).eps * values.max(initial=0.0), values, 0.0)
    return Fit(n, [s + n * h for s, h in zip(sums, shift)], vectors, values, trace)


def _by_length(batch: pa.RecordBatch):
    """(length, rows, vectors) of each length in a batch with the columns dim and x."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield dim, rows, matrix(batch.column("x").take(pa.array(rows)))


def fitted(distinct: DataFrame, k: int) -> dict[int, Fit]:
    """A fit for each length of vectors in distinct(dim, x)."""
    shifts = {r.dim: list(r.x) for r in distinct.groupBy("dim").agg(F.min("x").alias("x")).limit(MOST_LENGTHS + 1).collect()}
    if len(shifts) > MOST_LENGTHS or max(shifts, default=0) > MOST_DIM:
        raise ValueError(f"vectors of over {MOST_LENGTHS} lengths, or of over {MOST_DIM} components")

    def run(batches):
        sums: dict[int, Scatter] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                sums.setdefault(dim, Scatter(shifts[dim])).add(x)
        rows = [(dim, i, j, *limb) for dim, own in sums.items() for i, j, v in (*own.totals(), (-1, -1, own.n)) for limb in limbs(v)]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=["dim", "i", "j", "place", "limb"])

    found = summed(distinct.select("dim", "x").mapInArrow(run, "dim int, i int, j int, place int, limb long"), ["dim", "i", "j"])
    fits = {}
    for dim, shift in shifts.items():
        sums = [found.get((dim, i, -1), 0) for i in range(dim)]
        cross = [[found.get((dim, min(i, j), max(i, j)), 0) for j in range(dim)] for i in range(dim)]
        fits[dim] = decomposed(found[dim, -1, -1], sums, cross, shift, k)
    return fits


def identity_errors(distinct: DataFrame, fits: dict[int, Fit], k: int) -> dict[int, float]:
    """For each length the largest entry, without its sign, of the whitened fit list's covariance less the identity."""

    def run(batches):
        for batch in batches:
            for dim, _, x in _by_length(batch):
                w = fits[dim].whitened(x)[1]
                w = np.column_stack([w, np.full((len(w), k - w.shape[1]), np.nan)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), dim, np.int32)), *(pa.array(c, from_pandas=True) for c in w.T)], names=["dim", *(f"w{c}" for c in range(k))])

    rows = distinct.select("dim", "x").mapInArrow(run, ", ".join(["dim int", *(f"w{c} double" for c in range(k))]))
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    wanted = [F.covar_pop(f"w{a}", f"w{b}").alias(f"v{a}_{b}") for a, b in pairs]
    # Components without variance are null in all rows and so are their covariances.
    return {r.dim: max((abs(r[f"v{a}_{b}"] - (a == b)) for a, b in pairs if r[f"v{a}_{b}"] is not None), default=0.0) for r in rows.groupBy("dim").agg(*wanted).collect()}


def whitened(rows: DataFrame, scale: int = 256, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable row and component up to k.

    Rows whose vector is null or empty or holds nulls, NaN or infinities are dropped. Vectors of each length are a fit list
    of their own, and have min(k, length) components. Repeated rows stay; null ids do too. A component without
    variance (equal vectors, fewer vectors than components) has a null `whitened` and 0 for `explained`, or null if there is
    no variance at all. Components beyond a long's range, scaled, count as the nearest long; a deviation beyond it is null.
    An empty table returns no rows; other columns are not looked at.
    """
    kept = integers(rows, id_col, vector_col, scale)
    distinct = written(kept.select("dim", "x").distinct())
    fits = fitted(distinct, k)
    errors = identity_errors(distinct, fits, k)

    def run(batches):
        for batch in batches:
            for dim, at, x in _by_length(batch):
                fit = fits[dim]
                many = len(fit.variances)
                centred, found = fit.whitened(x)
                centred = narrow(centred, dim * largest(centred) ** 2)
                deviation = as_longs((centred * centred).sum(axis=1))
                explained = pa.array([v / fit.trace if fit.trace > 0 else None for v in fit.variances.tolist()], pa.float64())
                row, part = pa.array(np.repeat(np.arange(len(at)), many)), pa.array(np.tile(np.arange(many), len(at)))
                columns = [
                    batch.column("vec_id").take(pa.array(at)).take(row), pa.array(part.to_numpy() + 1, pa.int32()), pa.array(np.full(len(row), fit.n)), deviation.take(row),
                    pa.array(found.reshape(-1), from_pandas=True), explained.take(part), pa.array(np.full(len(row), errors[dim])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = dict(kept.dtypes)["vec_id"]
    out = kept.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("vec_id", id_col)
