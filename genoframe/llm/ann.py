"""Nearest neighbours by largest inner product: a navigable small-world graph per shard, shard results merged.

Vectors are dealt into shards by ranges of their norms and a hash of their id. Each shard becomes one row that
holds its vectors and a hierarchical graph as flat arrays of neighbours. The inner product is searched as
a distance: vectors get one more component that makes all norms of a shard equal. As a shard's norms differ by
a bounded factor, that component is never so large that single precision rounds the inner product away. Queries go to every
shard in blocks; each shard gives its k best, scored in double precision on the original vectors.

A search grows with the logarithm of a shard's rows but with the number of shards, so shards are as large as tasks can
hold: at first there are enough for all tasks, then they grow up to SHARD_BYTES of vectors. Likewise a shard is sent to
as few blocks of queries as keep all tasks busy and fit in BLOCK_BYTES.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genoframe.llm.shared import partitions
from genoframe.scratch import written

#: Fewest rows of a shard (but for what is left over) and of a block of queries, if there are so many.
SHARD_ROWS, BLOCK_ROWS = 8192, 4096
#: Most bytes of a shard's vectors and of a block's, in double precision.
SHARD_BYTES, BLOCK_BYTES = 1 << 26, 1 << 25
#: Binary logarithm of the most by which norms of a shard differ; 1 lies in the middle of its range.
NORM_RANGE = 3
INDEX_SCHEMA = "dim int, shard int, rows long, vectors binary, ids binary, starts binary, extra binary, base binary, upper binary, places binary, top int"
FOUND_SCHEMA = "query_id long, vec_id long, score double"


@dataclass
class Graph:
    """base: neighbours on the lowest level, a row for each point, -1 where there is none. upper: the same for the
    levels above, one row for each point and level; places: where a point's rows begin there. top: the entry point."""

    vectors: np.ndarray
    base: np.ndarray
    upper: np.ndarray
    places: np.ndarray
    top: int

    def levels(self) -> np.ndarray:
        return np.diff(self.places)

    def neighbours(self, point: int, level: int) -> np.ndarray:
        row = self.base[point] if level == 0 else self.upper[self.places[point] + level - 1]
        return row[row >= 0]

    def _nearest(self, query: np.ndarray, entries: list[int], wide: int, level: int, seen: np.ndarray, mark: int) -> list[tuple[float, int]]:
        """The `wide` nearest found from the entries on, as (nearness, point), in no order."""
        vectors, best, todo = self.vectors, [], []
        for p in entries:
            seen[p] = mark
            s = float(vectors[p] @ query)
            best.append((s, p))
            todo.append((-s, p))
        heapq.heapify(best)
        heapq.heapify(todo)
        while todo:
            s, p = heapq.heappop(todo)
            if -s < best[0][0] and len(best) >= wide:
                break
            near = self.neighbours(p, level)
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            scores = vectors[near] @ query
            if len(best) >= wide:
                keep = scores > best[0][0]
                near, scores = near[keep], scores[keep]
            for s, p in zip(scores.tolist(), near.tolist()):
                if len(best) < wide:
                    heapq.heappush(best, (s, p))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, p))
                else:
                    continue
                heapq.heappush(todo, (-s, p))
        return best

    def search(self, query: np.ndarray, wide: int, seen: np.ndarray, mark: int) -> list[int]:
        """Points near the query, about the `wide` nearest; seen holds no mark from `mark` on. Takes one mark for each level."""
        entries = [self.top]
        for level in range(int(self.levels()[self.top]), 0, -1):
            entries = [max(self._nearest(query, entries, 1, level, seen, mark))[1]]
            mark += 1
        return [p for _, p in self._nearest(query, entries, wide, 0, seen, mark)]


def _spread(vectors: np.ndarray, scores: np.ndarray, points: np.ndarray, most: int) -> np.ndarray:
    """Of the points, those that are nearer to the centre than to any chosen before, nearest first; then the others, up to most."""
    order = np.argsort(-scores, kind="stable")
    points, scores = points[order], scores[order]
    among = vectors[points] @ vectors[points].T
    open_, chosen = np.ones(len(points), bool), []
    for i in range(len(points)):
        if open_[i]:
            chosen.append(i)
            if len(chosen) == most:
                break
            open_ &= among[i] < scores
            open_[: i + 1] = False
    if len(chosen) < most:
        rest = np.setdiff1d(np.arange(len(points)), chosen)
        chosen += rest[: most - len(chosen)].tolist()
    return points[chosen]


def build(vectors: np.ndarray, links: int = 12, wide: int = 64, seed: int = 11) -> Graph:
    """Graph over the rows (all of one norm), inserted one after another; `links` to each on upper levels, twice as many below."""
    n, room = len(vectors), 3 * links
    levels = np.floor(-np.log(np.random.default_rng(seed).uniform(1e-12, 1, n)) / math.log(links)).astype(np.int64)
    places = np.concatenate([[0], np.cumsum(levels)])
    graph = Graph(vectors, np.full((n, room), -1, np.int32), np.full((int(places[-1]), room), -1, np.int32), places, 0)
    used = [np.zeros(n, np.int64), np.zeros(int(places[-1]), np.int64)]
    seen, mark = np.zeros(n, np.int64), 0

    def join(point: int, level: int, others: np.ndarray) -> None:
        """Link point to the others, one way; a full row is thinned."""
        table, row, count = (graph.base, point, used[0]) if level == 0 else (graph.upper, places[point] + level - 1, used[1])
        have = count[row]
        if have + len(others) > room:
            most = 2 * links if level == 0 else links
            both = np.concatenate([table[row, :have], others])
            others = _spread(vectors, vectors[both] @ vectors[point], both, most)
            table[row], have = -1, 0
        table[row, have : have + len(others)] = others
        count[row] = have + len(others)

    for p in range(1, n):
        query, entries = vectors[p], [graph.top]
        highest = int(levels[graph.top])
        for level in range(highest, -1, -1):
            mark += 1
            near = graph._nearest(query, entries, wide if level <= levels[p] else 1, level, seen, mark)
            if level <= levels[p]:
                points = np.array([q for _, q in near], np.int32)
                own = _spread(vectors, np.array([s for s, _ in near]), points, links)
                join(p, level, own)
                for q in own.tolist():
                    join(q, level, np.array([p], np.int32))
            entries = [q for _, q in near] if level <= levels[p] else [max(near)[1]]
        if levels[p] > highest:
            graph.top = p
    return graph


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors over the power of two that brings their largest component to at most 1; without rounding."""
    return np.ldexp(vectors, -int(np.frexp(np.abs(vectors).max())[1]))


def _index(shard: pa.Table) -> pa.Table:
    """One row for the vectors (vec_id, dim, shard, vector) of a shard; equal vectors are one point with several ids."""
    dim, own = shard["dim"][0].as_py(), shard["shard"][0].as_py()
    ids = shard["vec_id"].to_numpy()
    vectors = shard["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
    order = np.lexsort((*vectors.T[::-1], ids))
    keep = order[np.append(True, ids[order][1:] != ids[order][:-1])]  # one vector for each id
    ids, vectors = ids[keep], vectors[keep]
    distinct, group = np.unique(vectors, axis=0, return_inverse=True)
    group = group.reshape(-1)
    order = np.lexsort((ids, group))
    starts = np.searchsorted(group[order], np.arange(len(distinct) + 1))
    scaled = _scaled(distinct)
    norms = (scaled**2).sum(axis=1)
    extra = np.sqrt(np.maximum(norms.max() - norms, 0.0))
    shuffled = np.random.default_rng(own).permutation(len(distinct))
    graph = build(np.column_stack([scaled, extra])[shuffled].astype(np.float32))
    row = (dim, own, len(ids), distinct[shuffled].tobytes(), ids[order].tobytes(), np.column_stack([starts[:-1], starts[1:]])[shuffled].astype(np.int64).tobytes(), extra[shuffled].tobytes(), graph.base.tobytes(), graph.upper.tobytes(), graph.places.astype(np.int64).tobytes(), graph.top)
    names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
    kinds = (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 7, pa.int32())
    return pa.table([pa.array([v], t) for v, t in zip(row, kinds)], names=names)


def _search(k: int, wide: int, links: int = 12):
    def run(index: pa.Table, block: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["query_id", "vec_id", "score"])
        if not index.num_rows or not block.num_rows:
            return none
        row = index.to_pylist()[0]
        dim = row["dim"]
        of = lambda name, kind: np.frombuffer(row[name], kind)
        vectors, ids, starts = of("vectors", np.float64).reshape(-1, dim), of("ids", np.int64), of("starts", np.int64).reshape(-1, 2)
        flat = np.column_stack([_scaled(vectors), of("extra", np.float64)]).astype(np.float32)
        graph = Graph(flat, of("base", np.int32).reshape(-1, 3 * links), of("upper", np.int32).reshape(-1, 3 * links), of("places", np.int64), row["top"])
        queries = block["vec_id"].to_numpy()
        asked = block["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
        seen, mark, out = np.zeros(len(flat), np.int64), 1, []
        high = int(graph.levels().max(initial=0)) + 1
        order = np.lexsort((*asked.T[::-1], queries))
        for i in order[np.append(True, queries[order][1:] != queries[order][:-1])].tolist():
            points = np.array(graph.search(np.append(_scaled(asked[i]), 0.0).astype(np.float32), wide, seen, mark))
            mark += high
            scores = (vectors[points] * asked[i]).sum(axis=1)
            own = []
            for s, p in zip(scores.tolist(), points.tolist()):
                a, b = starts[p]
                own += [(-s, v) for v in ids[a : min(b, a + k + 1)].tolist() if v != queries[i]][:k]
            own.sort()
            out += [(int(queries[i]), v, -s) for s, v in own[:k]]
        if not out:
            return none
        return pa.table([pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return run


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, dim) without null ids and vectors that are null, empty, zero or hold a null or non-finite component."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where("vec_id is not null and size(vector) > 0")
    return rows.where(finite & F.exists("vector", lambda x: x != 0.0)).withColumn("dim", F.size("vector"))


def _range(vector: Column) -> Column:
    """Number of the range that the norm is in."""
    squares = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x)
    # Only squares that leave the range of doubles need the norm over the largest component.
    most = F.array_max(F.transform(vector, F.abs))
    parts = F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x / most) * (x / most))
    log = F.when(squares.between(1e-250, 1e250), F.log2(squares) / 2).otherwise(F.log2(most) + F.log2(parts) / 2)
    return F.floor(log / NORM_RANGE + 0.5)


def rows_for(rows: int, dim: int, parts: int, fewest: int, most_bytes: int) -> int:
    """Rows of a part so that there are `parts` of them, but no fewer than `fewest` nor more than fit in the bytes."""
    return max(1, min(max(fewest, math.ceil(rows / max(1, parts))), most_bytes // (8 * max(1, dim))))


def index(rows: DataFrame, shard_rows: int | None = None) -> DataFrame:
    """A row for each shard of usable() rows, written to the shared folder. Vectors of other dimensions, and of norms in
    other ranges, are shards of their own. shard_rows: by default as many as leave two shards for each task, see rows_for()."""
    if shard_rows is None:
        n, dim = rows.agg(F.count("*"), F.max("dim")).first()
        shard_rows = rows_for(n, dim or 1, 2 * partitions(rows.sparkSession), SHARD_ROWS, SHARD_BYTES)
    ahead = Window.partitionBy("dim").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("dim", _range(F.col("vector")).alias("range")).count().withColumn("shards", F.ceil(F.col("count") / shard_rows))
    counts = counts.select("dim", "range", "shards", F.coalesce(F.sum("shards").over(ahead), F.lit(0)).alias("before"))
    # Vectors of one id may be in several ranges; the least one counts.
    one = rows.groupBy("dim", "vec_id").agg(F.min("vector").alias("vector"))
    sized = one.withColumn("range", _range(F.col("vector"))).join(F.broadcast(counts), ["dim", "range"])
    sized = sized.withColumn("shard", (F.col("before") + F.pmod(F.xxhash64("vec_id"), "shards")).cast("int"))
    return written(sized.select("vec_id", "dim", "shard", "vector").groupBy("dim", "shard").applyInArrow(_index, INDEX_SCHEMA))


def search(shards: DataFrame, queries: DataFrame, k: int = 20, wide: int = 128, block_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, nearest first, ties to smaller ids; never itself.

    block_rows: by default so many that shards and blocks together make two searches for each task, see rows_for().
    """
    asked = queries.agg(F.count("*"), F.max("dim")).first()
    if block_rows is None:
        block_rows = rows_for(asked[0], asked[1] or 1, math.ceil(2 * partitions(queries.sparkSession) / max(1, shards.count())), BLOCK_ROWS, BLOCK_BYTES)
    blocks = max(1, math.ceil(asked[0] / block_rows))
    names = shards.groupBy("dim").agg(F.collect_list("shard").alias("all"))
    asked = queries.join(F.broadcast(names), "dim").select("vec_id", "vector", "dim", F.explode("all").alias("shard"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))
    copies = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = copies.groupBy("dim", "shard", "block").cogroup(asked.groupBy("dim", "shard", "block")).applyInArrow(_search(k, wide), FOUND_SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, chosen: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """search() for the rows that `chosen` (of vec_id) picks, among all rows.

    Rows of one id count once, with the least vector. A query with fewer than k candidates gets all that are
    found; an empty table returns no rows; other columns are not looked at.
    """
    rows = usable(rows, id_col, vector_col)
    return search(index(rows), rows.where(chosen), k)


def nearest_exactly(rows: DataFrame, chosen: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The same by comparing every query with every row; for measuring recall on small tables."""
    rows = usable(rows, id_col, vector_col)
    asked = rows.where(chosen).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"), "dim")
    score = F.aggregate(F.zip_with("vector", "asked", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    found = rows.join(asked, "dim").where("vec_id <> query_id").select("query_id", "vec_id", score.alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
