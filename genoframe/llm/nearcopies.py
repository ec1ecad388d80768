"""Near copies by the likeness of their word shingles, found with SimHash and BK-trees.

Each distinct sequence of words gets a SimHash of 256 bits over its distinct shingles; texts of likeness 0.8 differ in
about 39 of them, unrelated ones in 128. A BK-tree over all texts would grow with the corpus, so texts are dealt into
shards by bands of MinHash values: every band that two texts share is a shard of its own, never joined to other shards.
A shard's tree is searched along the edges within the radius, and what it finds is compared by whole shingle sets.

1. In the shards of the first bands each text is linked to the nearest other one that the tree finds; these links, one
   for each text and shard, are compared exactly, and components of the links that hold are the first classes.
2. In those shards, then in the shards of all bands, that still hold several classes, every two texts of different
   classes within the radius are compared. Only texts with such a partner are sent their shingles. Large shards are
   dealt again by a second band, and what is still large is cut into chunks that meet in pairs; two chunks of a shard's
   largest class need not meet.

Classes are the components of links that hold, and of no others.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.operators.components import connected_components
from genoframe.llm.shared import parts
from genoframe.llm.simhash import BLOCK, BKTree, shingle_hashes
from genoframe.operators.groups import over_groups
from genoframe.scratch import written

#: Bands of MinHash values and values in each: of pairs of likeness 0.8, three in a million share no band.
BANDS, BAND_ROWS = 32, 5
#: Bands whose shards are searched for nearest texts first, and bands whose shards are then searched whole before all others.
FIRST_BANDS, THEN_BANDS = 8, 4
#: Words of 64 bits of a fingerprint, and differing bits within which the trees look: 4.5 deviations above those of likeness 0.8.
WORDS, RADIUS = 4, 64
#: Texts of a chunk.
CHUNK_TEXTS = 256
#: Most rows, of a few numbers each, that are broadcast.
BROADCAST_ROWS = 1_000_000

_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.random.default_rng(6).integers(0, 1 << 63, (WORDS, 2), np.uint64) * np.uint64(2) + np.uint64(1)


def bands(shingles: np.ndarray) -> np.ndarray:
    """A key for each band of the MinHash values of distinct shingles."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 1 << 12):
        least = np.minimum(least, (shingles[i : i + (1 << 12), None] * _FACTORS).min(axis=0))
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(least.reshape(BANDS, BAND_ROWS))], np.uint64).view(np.int64)


def wide_simhash(shingles: np.ndarray) -> bytes:
    """Fingerprint of WORDS times 64 bits: whether each bit is set in over half of the hashes that follow from the shingles'."""
    set_in = np.zeros(64 * WORDS, np.int64)
    for i in range(0, len(shingles), BLOCK):
        part = shingles[i : i + BLOCK, None] * _ODD[:, 0]
        part = (part ^ (part >> np.uint64(32))) * _ODD[:, 1]
        part = (part ^ (part >> np.uint64(29))).astype(">u8")
        set_in += np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * set_in > len(shingles)).tobytes()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sorted sets; two empty ones are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """(id, hash, high, low: digest of the words in order, fp, shingles: how many, bands) of rows(id, hash, text)."""

    def run(batches):
        for batch in parts(batches):
            out = []
            for text in batch.column(2).to_pylist():
                # Fingerprint and likeness are of the same set: a shingle counts once, however often it is repeated.
                distinct = np.unique(shingle_hashes(text, words))
                high, low = np.frombuffer(xxhash.xxh3_128_digest(b" ".join((text or b"").lower().split())), np.int64).tolist()
                out.append((high, low, wide_simhash(distinct), len(distinct), bands(distinct) if len(distinct) else np.zeros(0, np.int64)))
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["id", "hash", "high", "low", "fp", "shingles", "bands"])

    return rows.mapInArrow(run, "id long, hash long, high long, low long, fp binary, shingles long, bands array<long>")


def _rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, hash of the text) and more of each row: together they name a text of an id."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash"), *more)


def _same_text() -> Column:
    return F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))


def _sized(df: DataFrame) -> DataFrame:
    """df, written first, to be broadcast if it has at most BROADCAST_ROWS rows."""
    df = written(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _shared(shards: DataFrame, where: Column, *more: Column) -> DataFrame:
    """Rows of those shards for which `where`, an aggregate, is true, with the other aggregates. Shard and a hash of it join, so that a hot one can be split."""
    found = shards.groupBy("shard").agg(where.alias("_where"), *more).where("_where").drop("_where")
    found = _sized(found.withColumnRenamed("shard", "_s").withColumn("_h", F.xxhash64("_s")))
    same = (F.col("shard") == F.col("_s")) & (F.xxhash64("shard") == F.col("_h"))
    return shards.join(found, same).drop("_s", "_h")


def _nearest(texts: DataFrame, first: int) -> DataFrame:
    """(a, b): in every shard of the first bands, each text and the nearest other one within the radius.

    A shard over CHUNK_TEXTS is cut into chunks, other ones in each band, and each text is looked for in its own chunk and the first.
    """
    shards = texts.select("node", "fp", "shingles", F.explode(F.slice("bands", 1, first)).alias("shard"))
    shards = _shared(shards, F.count("*") > 1, F.ceil(F.count("*") / CHUNK_TEXTS).alias("chunks"))
    shards = shards.withColumn("own", F.pmod(F.xxhash64("node", "shard"), "chunks"))
    everywhere = F.when(F.col("own") == 0, F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).otherwise(F.array("own"))
    cells = shards.select("shard", F.explode(everywhere).alias("cell"), "own", "node", "fp")

    def look(key, group):
        tree, at_node, asked = BKTree(), [], []
        for _, cell, own, node, fp in group:
            k = tree.insert(int.from_bytes(fp, "big"))
            if k == len(at_node):
                at_node.append(node)
            elif own == cell:
                yield at_node[k], node
                continue
            if own == cell:
                asked.append((k, node))
        for k, node in asked:
            if at_node[k] != node:
                yield at_node[k], node
            elif (hit := tree.nearest(tree.values[k], RADIUS, k)) is not None:
                yield min(node, at_node[hit]), max(node, at_node[hit])

    return over_groups(cells, ["shard", "cell"], ["own", "node"], look, "a long, b long").distinct()


def _holding(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are at least so alike."""
    for side in ("a", "b"):
        own = sets.select(F.col("node").alias(f"_{side}"), F.col("set").alias(f"set_{side}"), F.xxhash64("node").alias("_h"))
        pairs = pairs.join(own, (F.col(side) == F.col(f"_{side}")) & (F.xxhash64(side) == F.col("_h"))).drop(f"_{side}", "_h")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                small, large = sorted((len(x), len(y)))
                keep.append(small >= least * large and likeness(x, y) >= least)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _open_shards(texts: DataFrame, bands: Column) -> DataFrame:
    """(shard, node, class, main, rest, most) of texts(node, class, bands) in shards of several classes: main is a shard's
    largest class, most the number of its texts and rest that of all others. Large ones are dealt again by a second band."""
    several = F.min("class") < F.max("class")
    shards = _shared(texts.select("node", "class", F.explode(bands).alias("shard")), several)

    def sized(shards: DataFrame) -> DataFrame:
        by_class = shards.groupBy("shard", "class").agg(F.count("*").alias("n"))
        stats = by_class.groupBy("shard").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.max("n").alias("most"), (F.sum("n") - F.max("n")).alias("rest"))
        stats = stats.withColumnRenamed("shard", "_s").withColumn("_h", F.xxhash64("_s"))
        return shards.join(stats, (F.col("shard") == F.col("_s")) & (F.xxhash64("shard") == F.col("_h"))).drop("_s", "_h")

    shards = written(sized(shards))
    again = shards.where(F.col("rest") > CHUNK_TEXTS).select("shard", "node", "class").join(texts.select("node", "bands"), "node")
    again = again.select("node", "class", F.col("shard").alias("_first"), F.explode("bands").alias("_second")).where("_first <> _second")
    again = again.select("node", "class", F.xxhash64(F.least("_first", "_second"), F.greatest("_first", "_second")).alias("shard")).distinct()
    again = sized(_shared(again, several))
    return shards.where(F.col("rest") <= CHUNK_TEXTS).unionByName(again.select(*shards.columns))


def _cells(shards: DataFrame) -> DataFrame:
    """_open_shards() as cells (shard, i, j) of one or two chunks; part is the chunk that a text is of."""
    c = F.col
    small = c("rest") + c("most") <= CHUNK_TEXTS
    rests, mains = (F.when(small, k).otherwise(F.ceil(c(n) / CHUNK_TEXTS)).cast("long") for n, k in (("rest", 1), ("most", 0)))
    shards = shards.withColumns({"rests": rests, "mains": mains})
    in_main = (c("class") == c("main")) & (c("mains") > 0)
    # The largest class's chunks come last and do not meet each other.
    shards = shards.withColumn("part", F.when(in_main, c("rests") + F.pmod(F.xxhash64("node"), c("mains"))).otherwise(F.pmod(F.xxhash64("node"), c("rests"))))
    others = F.sequence(F.lit(0).cast("long"), F.when(in_main, c("rests")).otherwise(c("rests") + c("mains")) - 1)
    cells = shards.select("shard", "node", "class", "part", F.explode(others).alias("other"))
    return cells.select("shard", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "class")


def _partners(group, fits):
    """Pairs (earlier, later) of rows (shard, i, j, part, node, class, fp, shingles, ...) within the radius that fits() admits, by a tree in which rows of the
    first chunk, and in a cell of one chunk all rows, are put."""
    tree, at_node = BKTree(), []
    for row in group:
        _, i, j, part, *_ = row
        value = int.from_bytes(row[6], "big")
        if i == j or part == j:
            for k in tree.near(value, RADIUS):
                for other in at_node[k]:
                    if fits(other, row):
                        yield other, row
        if i == j or part == i:
            k = tree.insert(value)
            if k == len(at_node):
                at_node.append([])
            at_node[k].append(row)


def _remaining(texts: DataFrame, bands: Column, sets: Callable[[DataFrame], DataFrame], least: float) -> DataFrame:
    """(a, b): links that hold between texts(node, class, fp, shingles, bands) of different classes in a shard of those bands; of a cell as many as join what is joined.

    sets: gives (node, set) of nodes."""
    cells = _cells(_open_shards(texts, bands)).join(texts.select("node", "fp", "shingles"), "node")
    cells = cells.select("shard", "i", "j", "part", "node", "class", "fp", "shingles")
    sizes_fit = lambda a, b: a[5] != b[5] and min(a[7], b[7]) >= least * max(a[7], b[7])

    def flag(key, group):
        seen = set()
        for pair in _partners(group, sizes_fit):
            for row in pair:
                if row[4] not in seen:
                    seen.add(row[4])
                    yield row

    def compare(key, group):
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while parent.setdefault(c, c) != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        for x, y in _partners(group, lambda a, b: sizes_fit(a, b) and root(a[5]) != root(b[5])):
            if root(x[5]) != root(y[5]) and likeness(np.frombuffer(x[8], np.uint64), np.frombuffer(y[8], np.uint64)) >= least:
                parent[root(y[5])] = root(x[5])
                yield x[4], y[4]

    keys, order = ["shard", "i", "j"], ["part", "node"]
    flagged = written(over_groups(cells, keys, order, flag, cells.schema))
    own = sets(flagged.select("node")).select(F.col("node").alias("_n"), "set", F.xxhash64("node").alias("_h"))
    flagged = flagged.join(own, (F.col("node") == F.col("_n")) & (F.xxhash64("node") == F.col("_h"))).drop("_n", "_h")
    return over_groups(flagged, keys, order, compare, "a long, b long")


def near_copies(docs: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, classes): texts(node, id, hash, ...) has a row for each distinct sequence of words with its smallest id;
    classes(node, root) names, for each of these nodes with a near copy, one node of its class.

    Near copies have at least that share of their distinct shingles in common; classes are what such links join.
    Case (A-Z) and white space do not matter; texts without words, null ones too, are copies of one another. Rows of
    one id with different words are different texts.
    """
    rows = _rows(docs, id_col, text_col, F.col(text_col).cast("binary").alias("text"))
    lead = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("lead")
    texts = sketches(rows, words).groupBy("high", "low").agg(lead, *[F.first(c).alias(c) for c in ("fp", "shingles", "bands")])
    texts = written(texts.select(F.monotonically_increasing_id().alias("node"), "lead.id", "lead.hash", "fp", "shingles", "bands"))

    def sets(nodes: DataFrame) -> DataFrame:
        """(node, set): the shingles of the texts of those nodes."""

        def shingled(batches):
            for batch in parts(batches):
                found = [np.unique(shingle_hashes(t, words)).tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "set"])

        wanted = _sized(texts.join(nodes.distinct(), "node", "left_semi").select("node", F.col("id").alias("_id"), F.col("hash").alias("_hash")))
        found = rows.join(wanted, _same_text()).select("node", "text").mapInArrow(shingled, "node long, set binary")
        return written(found.dropDuplicates(["node"]))

    pairs = written(_nearest(texts, FIRST_BANDS))
    links = written(_holding(pairs, sets(pairs.select(F.explode(F.array("a", "b")).alias("node"))), least))
    for own in (F.slice("bands", 1, THEN_BANDS), F.col("bands")):
        found = connected_components(links, "a", "b").select(F.col("node").alias("_n"), "root")
        classed = texts.join(found, F.col("node") == F.col("_n"), "left").select("node", F.coalesce("root", "node").alias("class"), "fp", "shingles", "bands")
        links = links.unionByName(written(_remaining(written(classed), own, sets, least)))
    return texts, connected_components(links, "a", "b")


def first_of_each(docs: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs, with all its columns, of each class of near copies: that with the smallest id.

    Null ids come after all others. Of several texts of that id in the class the one whose hash is least stays, and of
    equal ones the least row by its columns, but for those that have no order. Rows of one id whose texts are not alike
    all stay. An empty table stays empty.
    """
    texts, classes = near_copies(docs, words, least, id_col, text_col)
    named = texts.select("node", "id", "hash").join(classes.select(F.col("node").alias("_n"), "root"), F.col("node") == F.col("_n"), "left")
    lead = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("lead")
    chosen = named.groupBy(F.coalesce("root", "node").alias("class")).agg(lead).select(F.col("lead.id").alias("_id"), F.col("lead.hash").alias("_hash"))
    kept = _rows(docs, id_col, text_col, F.struct("*").alias("doc")).join(chosen, _same_text(), "left_semi")
    order = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    # Where all columns have an order doc is its own, and its text is dealt once.
    least_doc = F.min("doc") if len(order) == len(docs.columns) else F.min_by("doc", F.struct(*[F.col(f"doc.`{c}`") for c in order]))
    return kept.groupBy("id", "hash").agg(least_doc.alias("doc")).select("doc.*")
