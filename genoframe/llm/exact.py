"""Vectors of integers, and sums of them that are exact at any size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a limb. Spark adds limbs as longs, which is exact for as many as 2^31 partial sums.
LIMB = 32
#: Bits of a digit and rows of a block: products of digits, summed over a block, stay below 2^53.
DIGIT, BLOCK_ROWS = 18, 16384
LONG = 1 << 63


def integers(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, dim, x) of the rows whose vector is not null or empty and holds neither nulls nor non-finite components.

    x are the components, as doubles, times scale, rounded down; what a long cannot hold is the nearest one that it can.
    """
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(F.size("vector") > 0).where(finite)
    return rows.select("vec_id", F.size("vector").alias("dim"), F.transform("vector", lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows; long components."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def narrow(x: np.ndarray, most: int) -> np.ndarray:
    """x as it is if what is worked out from it, at most `most` in size, stays a long; else as Python's integers."""
    return x if most < LONG else x.astype(object)


def largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def as_longs(numbers: Iterable) -> pa.Array:
    """Null for what a long cannot hold."""
    return pa.array([int(v) if -LONG <= v < LONG else None for v in numbers], pa.int64())


def limbs(number: int) -> Iterator[tuple[int, int]]:
    """(place, limb) of a number; limbs have its sign."""
    sign, number, place = (-1, -number, 0) if number < 0 else (1, number, 0)
    while number:
        yield place, sign * (number & ((1 << LIMB) - 1))
        number >>= LIMB
        place += 1


def summed(parts: DataFrame, keys: list[str]) -> dict[tuple, int]:
    """The sum for each key of parts(keys, place, limb). Keys must be bounded in number, as sums come to the driver."""
    found: dict[tuple, int] = {}
    for *key, place, limb in parts.groupBy(*keys, "place").agg(F.sum("limb").alias("limb")).collect():
        found[tuple(key)] = found.get(tuple(key), 0) + (limb << (LIMB * place))
    return found


def digits(x: np.ndarray) -> list[np.ndarray]:
    """x as float64 matrices d with x = sum of d[k] << (DIGIT * k); all but the last are not negative."""
    found, half = [], 1 << (DIGIT - 1)
    while largest(x) >= half:
        found.append((x & ((1 << DIGIT) - 1)).astype(np.float64))
        x = x >> DIGIT
    return [*found, x.astype(np.float64)]


class Scatter:
    """n, the sums and the sums of cross-products of the rows that are added, less a shift, in integers of any size."""

    def __init__(self, shift: list[int]):
        self.shift, self.n = shift, 0
        self.sums = np.zeros(len(shift), object)
        self.cross = np.zeros((len(shift), len(shift)), object)
        self._held: dict[int, np.ndarray] = {}
        self._blocks = 0

    def add(self, x: np.ndarray) -> None:
        wide = largest(x) + max(map(abs, self.shift), default=0)
        for at in range(0, len(x), BLOCK_ROWS):
            block = narrow(x[at : at + BLOCK_ROWS], wide)
            block = block - np.array(self.shift, block.dtype)
            self.n += len(block)
            self.sums += block.sum(axis=0) if wide * len(block) < LONG else block.astype(object).sum(axis=0)
            parts = digits(block)
            for i, a in enumerate(parts):
                for j, b in enumerate(parts):
                    self._held[i + j] = self._held.get(i + j, 0) + (a.T @ b).astype(np.int64)
            self._blocks += len(parts)
            if self._blocks >= 1024:
                self._carry()

    def _carry(self) -> None:
        for k, part in self._held.items():
            self.cross += part.astype(object) << (DIGIT * k)
        self._held, self._blocks = {}, 0

    def totals(self) -> Iterator[tuple[int, int, int]]:
        """(i, j, number): sums of cross-products for i <= j; j is -1 for sums."""
        self._carry()
        dim = len(self.shift)
        yield from ((i, -1, int(self.sums[i])) for i in range(dim))
        yield from ((i, j, int(self.cross[i, j])) for i in range(dim) for j in range(i, dim))
