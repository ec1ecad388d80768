"""Clusters by nearest centroid, exact, with most comparisons in single precision.

A float32 matrix product gives each vector's scores |c|² - 2xc of all centroids and a bound of their rounding errors, so that
each score is an interval that holds the exact one. A centroid whose interval ends below all others' begin is
the nearest. Where intervals overlap, distances are worked out with exact integers, and of equal ones the smallest number wins.
Sums of clusters are exact integers too, added limb by limb, so centroids do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.exact import LONG, as_longs, integers, largest, limbs, matrix, narrow, summed
from genoframe.scratch import written

#: Rounding unit of float32 and of float64.
U32, U64 = 2.0**-24, 2.0**-53


class Centroids:
    def __init__(self, centroids: list[list[int]]):
        self.exact = np.array(centroids, object)
        self.long = self.exact.astype(np.int64)
        self.size = largest(self.long)
        real = self.long.astype(np.float64)
        self.real32 = real.astype(np.float32)
        self.squares = np.array([float(sum(int(v) * int(v) for v in c)) for c in centroids])
        self.norms = np.sqrt((real**2).sum(axis=1)) * (1 + 1e-9)

    def intervals(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lowest, highest) that |c|² - 2xc can be, for each row and centroid.

        A float32 product of m components, converted ones included, is off by at most g |x||c| with g = (m+2)u / (1 - (m+2)u), in whatever
        order it is summed. All are integers, so nothing underflows; what overflows gets an interval without ends.
        """
        real = x.astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            dots = (real.astype(np.float32) @ self.real32.T).astype(np.float64)
            norms = np.sqrt((real**2).sum(axis=1)) * (1 + 1e-9)
            terms = (x.shape[1] + 2) * U32
            reach = np.outer(norms, self.norms)
            error = 2 * reach * (terms / (1 - terms)) * (1 + 1e-6) + 8 * U64 * (self.squares + 2 * reach)
            score = self.squares - 2 * dots
            low, high = score - error, score + error
        unknown = ~np.isfinite(score) | (reach > 1e37)
        return np.where(unknown, -np.inf, low), np.where(unknown, np.inf, high)

    def distances(self, x: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Exact squared distance of each row to the centroid of that number."""
        most = x.shape[1] * (largest(x) + self.size) ** 2
        off = narrow(x, most) - (self.long if most < LONG else self.exact)[number]
        return (off * off).sum(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, int]:
        """(number of the nearest centroid for each row, rows that needed exact integers)."""
        low, high = self.intervals(x)
        open_ = low <= high.min(axis=1)[:, None]
        number = open_.argmax(axis=1)
        again = np.flatnonzero(open_.sum(axis=1) > 1)
        if len(again):
            row, which = np.nonzero(open_[again])
            off = self.distances(x[again[row]], which)
            best: dict[int, tuple] = {}
            if off.dtype == object:
                for r, c, d in zip(row.tolist(), which.tolist(), off.tolist()):
                    best[r] = min(best.get(r, (d, c)), (d, c))
                number[again] = [best[r][1] for r in range(len(again))]
            else:
                order = np.lexsort((which, off, row))
                first = order[np.append(True, row[order][1:] != row[order][:-1])]
                number[again] = which[first]
        return number, len(again)


def _totals(kept: DataFrame, now: list[list[int]], distances: bool) -> dict[tuple[int, int], int]:
    """By (cluster, component) the sums of its vectors; component -1 is their number, -2 with `distances` the sum of distances."""

    def run(batches):
        own = Centroids(now)
        sums = np.zeros((len(now), len(now[0]) + 2), object)
        for batch in batches:
            x = matrix(batch.column("x"))
            number, _ = own.nearest(x)
            off = own.distances(x, number) if distances else None
            x = narrow(x, largest(x) * len(x))
            for c in np.unique(number).tolist():
                mine = number == c
                sums[c, :-2] += x[mine].sum(axis=0).astype(object)
                sums[c, -1] += int(mine.sum())
                if distances:
                    sums[c, -2] += sum(off[mine].tolist())
        rows = [(c, i - len(now[0]) - 2 if i >= len(now[0]) else i, *limb) for c in range(len(now)) for i in range(sums.shape[1]) for limb in limbs(int(sums[c, i]))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["cluster", "component", "place", "limb"])

    return summed(kept.select("x").mapInArrow(run, "cluster int, component int, place int, limb long"), ["cluster", "component"])


def first_centroids(kept: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors with the least SHA-256 of `<seed>:<vec_id>`, in its order; of one id the least vector first, null ids last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.x) for r in kept.select(digest.alias("digest"), "x").orderBy(F.asc_nulls_last("digest"), "x").limit(k).collect()]


def moved(now: list[list[int]], totals: dict[tuple[int, int], int]) -> list[list[int]]:
    """Means rounded down; a centroid without vectors stays."""
    many = [totals.get((c, -1), 0) for c in range(len(now))]
    return [[totals.get((c, i), 0) // many[c] for i in range(len(own))] if many[c] else own for c, own in enumerate(now)]


def clusters(rows: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: str = "3", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector with exactly `dim` components, all finite.

    Other vectors, null ones too, take no part. Repeated rows and null ids stay rows of their own. Fewer than k vectors are as
    many centroids; an empty table returns no rows; other columns are not looked at. Components beyond a long's
    range, scaled, count as the nearest long; a distance or inertia beyond it is null. The driver holds k centroids.
    """
    kept = integers(rows, id_col, vector_col, scale).where(F.col("dim") == dim)
    kind = dict(kept.dtypes)["vec_id"]
    kept = written(kept.select("vec_id", "x"))
    now = first_centroids(kept, k, seed)
    for _ in range(rounds if now else 0):
        now = moved(now, _totals(kept, now, False))
    totals = _totals(kept, now, True) if now else {}
    inertias = [totals.get((c, -2), 0) for c in range(len(now))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]

    def run(batches):
        own = Centroids(now) if now else None
        for batch in batches:
            x = matrix(batch.column("x"))
            number, _ = own.nearest(x)
            which = pa.array(number)
            columns = [
                batch.column("vec_id"), pa.array(number, pa.int32()), as_longs(own.distances(x, number).tolist()), as_longs(inertias).take(which),
                as_longs([sum(inertias)] * len(number)), pa.array(digests).take(which),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    out = kept.mapInArrow(run, f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.withColumnRenamed("vec_id", id_col)


def clusters_sql(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: str = "3") -> str:
    """DuckDB's SQL for clusters() over the table embeddings, one step for each round."""
    nearest = "select r, k, d from (select v.r, c.k, sum((v.e - c.e) * (v.e - c.e)) as d from v join {} c using (i) group by all) qualify row_number() over (partition by r order by d, k) = 1"
    steps = [
        f"kept as materialized (select row_number() over () as r, vec_id, list_transform(embedding, lambda c: floor({scale} * c::double)::bigint) as x from embeddings"
        f" where len(embedding) = {dim} and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0)",
        "v as materialized (select r, unnest(range(1, len(x) + 1)) as i, unnest(x) as e from kept)",
        f"firsts as (select row_number() over (order by sha256(concat('{seed}:', vec_id)), x) - 1 as k, x from kept qualify k < {k})",
        "c0 as materialized (select k, unnest(range(1, len(x) + 1)) as i, unnest(x) as e from firsts)",
    ]
    for n in range(rounds):
        steps += [
            f"a{n} as materialized ({nearest.format(f'c{n}')})",
            f"m{n} as (select k, i, sum(e)::bigint as s, count(*) as n from a{n} join v using (r) group by all)",
            f"c{n + 1} as materialized (select k, i, coalesce((s - ((s % n) + n) % n) // n, e) as e from c{n} left join m{n} using (k, i))",
        ]
    steps += [
        f"last as materialized ({nearest.format(f'c{rounds}')})",
        f"digests as (select k, sha256(string_agg(e::varchar, ',' order by i)) as centroid_sha256 from c{rounds} group by k)",
    ]
    return (
        f"with {', '.join(steps)} select vec_id, k::int as cluster, d::bigint as distance, (sum(d) over (partition by k))::bigint as cluster_inertia,"
        " (sum(d) over ())::bigint as inertia, centroid_sha256 from last join kept using (r) join digests using (k)"
    )
