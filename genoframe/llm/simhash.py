"""SimHash near-duplicates: links between fingerprints of few differing bits, found with BK-trees.

Method. Each text gets a 64-bit fingerprint. Equal fingerprints are taken together first, so a group of
copies counts once. Two fingerprints that differ in at most `radius` bits agree wholly in one of radius + 1
blocks of bits; the distinct fingerprints are dealt out by block value into shards, and every shard builds a
BK-tree (children keyed by their Hamming distance to the parent) in which its own fingerprints are searched,
following only edges within the radius. A shard over `shard_rows` is dealt out again by the blocks of its other
bits, and what is still larger is cut into chunks: each chunk's tree is sent to every other chunk. No link is
lost, no task holds more than two chunks, and of a shard's links only a spanning forest is passed on.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.operators.components import connected_components
from genoframe.llm.shared import partitions
from genoframe.scratch import written

BITS = 64
#: Shingles of a text whose bits are counted at a time.
BLOCK = 1 << 15


def shingle_hashes(text: bytes | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of a text in UTF-8, A-Z lower-cased, repeats included; of fewer words, of them all."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    words = min(words, len(tokens))
    joined = b" ".join(tokens)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s : e - 1], seed) for s, e in zip(starts, ends[words - 1 :])], np.uint64)


def vote(hashes: np.ndarray) -> int:
    """Of each bit, whether it is set in over half of the hashes; 0 of none."""
    set_in = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK].astype(">u8")
        set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(hashes)).tobytes(), "big")


def simhash(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """Fingerprint of a text in UTF-8: of each bit, whether it is set in over half of the shingles' hashes."""
    return vote(shingle_hashes(text, words, seed))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp) of every row; fp is the fingerprint as a signed long. A null text has no words: fingerprint 0."""

    def run(batches):
        for batch in batches:
            fps = [simhash(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["id", "fp"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"id {kind}, fp long")


class BKTree:
    """Distinct integers; the children of a node are keyed by their Hamming distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def insert(self, value: int) -> int:
        """The index of the value, which is put in if it is new."""
        new, at = len(self.values), 0
        while new:
            if not (d := (self.values[at] ^ value).bit_count()):
                return at
            nxt = self.children[at].setdefault(d, new)
            if nxt == new:
                break
            at = nxt
        self.values.append(value)
        self.children.append({})
        return new

    def near(self, value: int, radius: int):
        """Indices of the values within the radius."""
        todo = [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            at = todo.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                yield at
            for edge, child in children[at].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)

    def nearest(self, value: int, radius: int, but: int = -1) -> int | None:
        """Index (other than `but`) of the nearest value within the radius, which shrinks to the nearest found so far."""
        todo, best, found = [(0, 0)] if self.values else [], radius + 1, None
        values, children = self.values, self.children
        while todo:
            at, least = todo.pop()
            if least >= best:
                continue
            d = (values[at] ^ value).bit_count()
            if d < best and at != but:
                best, found = d, at
            for edge, child in children[at].items():
                if (gap := abs(d - edge)) < best:
                    todo.append((child, gap))
        return found


def _forest(members: list[int], others: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among members, or, if there are others, between others and members."""
    both = members + others
    parent = list(range(len(both)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree, out = BKTree(), []

    def look(i: int) -> None:
        for j in tree.near(both[i], radius):
            if (a := root(i)) != (b := root(j)):
                parent[max(a, b)] = min(a, b)
                out.append((both[i], both[j]))

    for i, value in enumerate(members):
        if not others:
            look(i)
        tree.insert(value)
    for i in range(len(members), len(both)):
        look(i)
    return out


def _search(radius: int):
    """Over batches of (key, sub, i, j, side, fp) sorted by shard: the links of every shard, whole shards at a time."""

    def run(batches):
        kept: list[np.ndarray] = []

        def links(shards: np.ndarray):
            cuts = np.flatnonzero((shards[1:, :4] != shards[:-1, :4]).any(axis=1)) + 1
            found: list[tuple[int, int]] = []
            for lo, hi in zip([0, *cuts], [*cuts, len(shards)]):
                if hi - lo > 1:
                    fps, side = shards[lo:hi, 5].view(np.uint64).tolist(), shards[lo:hi, 4]
                    n = int((side == 0).sum())
                    if n and not (shards[lo, 2] != shards[lo, 3] and n == hi - lo):  # a pair of chunks of which one is empty has no links to find
                        found += _forest(fps[:n], fps[n:], radius)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            if kept and (kept[0][0, :4] != rows[0, :4]).any():
                yield links(np.concatenate(kept))
                kept = []
            if len(cuts):
                yield links(np.concatenate([*kept, rows[: cuts[-1]]]))
                kept = [rows[cuts[-1] :]]
            else:
                kept.append(rows)
        if kept:
            yield links(np.concatenate(kept))

    return run


def _blocks(bits: int, parts: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each of `parts` blocks of `bits` bits."""
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _block(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def _rest(fp: Column, low: int, width: int) -> Column:
    """fp without that block of bits."""
    return F.shiftleft(F.shiftrightunsigned(F.shiftrightunsigned(fp, low), width), low).bitwiseOR(fp.bitwiseAND(F.lit((1 << low) - 1)))


def links(distinct: DataFrame, radius: int = 3, shard_rows: int = 1024) -> DataFrame:
    """(a, b): links of at most `radius` bits between the distinct fingerprints fp; as many as join what is joined, not all pairs."""
    fp, n = F.col("fp"), partitions(distinct.sparkSession)
    blocks = _blocks(BITS, radius + 1)
    keyed = distinct.select("fp", F.explode(F.array(*[F.struct(_block(fp, *b).bitwiseOR(F.lit(i << 32)).alias("key"), *[_block(_rest(fp, *b), *s).bitwiseOR(F.lit(k << 32)).alias(f"s{k}") for k, s in enumerate(_blocks(BITS - b[1], radius + 1))]) for i, b in enumerate(blocks)])).alias("x")).select("fp", "x.*")
    large = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows).select(F.col("key").alias("lk"), F.xxhash64("key").alias("lh"))
    keyed = keyed.withColumn("h", F.xxhash64("key")).join(large, (F.col("key") == F.col("lk")) & (F.col("h") == F.col("lh")), "left")
    subs = F.array(*[F.col(f"s{k}") for k in range(radius + 1)])
    keyed = keyed.select("fp", "key", F.explode(F.when(F.col("lk").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(subs)).alias("sub"))
    sizes = keyed.where("sub >= 0").groupBy("key", "sub").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows)
    sizes = sizes.select(F.col("key").alias("lk"), F.col("sub").alias("ls"), F.xxhash64("key", "sub").alias("lh"), F.ceil(F.col("n") / shard_rows).alias("chunks"))
    keyed = keyed.withColumn("h", F.xxhash64("key", "sub")).join(sizes, (F.col("key") == F.col("lk")) & (F.col("sub") == F.col("ls")) & (F.col("h") == F.col("lh")), "left")
    keyed = keyed.withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("fp"), "chunks"))
    cells = keyed.select("fp", "key", "sub", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"))
    cells = cells.select("key", "sub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).cast("long").alias("side"), "fp")
    return cells.repartition(n, "key", "sub", "i", "j").sortWithinPartitions("key", "sub", "i", "j", "side").mapInArrow(_search(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """One row for each row of docs: its id, fp (fingerprint as a long) and component_id.

    component_id is the smallest id that can be reached over links of at most `radius` differing bits, the
    row's own included. Null and empty texts share fingerprint 0, linked like any other. Repeated rows and
    equal ids stay as they are; a null id is never a component's name unless all its ids are null. Of an
    empty table nothing returns. Other columns are not looked at.
    """
    own = written(fingerprints(docs, id_col, text_col, words))
    distinct = written(own.groupBy("fp").agg(F.min("id").alias("least")))
    joined = connected_components(links(distinct, radius), "a", "b")
    named = joined.join(distinct, F.col("node") == F.col("fp")).select("node", "root", "least")
    roots = joined.select("root").distinct().join(distinct, F.col("root") == F.col("fp")).select(F.col("root").alias("node"), "root", "least")
    named = named.unionByName(roots)
    least = named.groupBy("root").agg(F.min("least").alias("first")).select(F.col("root").alias("lr"), F.xxhash64("root").alias("lh"), "first")
    named = named.withColumn("h", F.xxhash64("root")).join(least, (F.col("root") == F.col("lr")) & (F.col("h") == F.col("lh"))).select("node", "first")
    classes = distinct.join(named, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("cf"), F.xxhash64("fp").alias("ch"), F.coalesce("first", "least").alias("component_id"))
    return own.withColumn("h", F.xxhash64("fp")).join(classes, (F.col("fp") == F.col("cf")) & (F.col("h") == F.col("ch")), "left").select(F.col("id").alias(id_col), "fp", "component_id")
