import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from helpers import empty_documents, odd_documents
from pyspark.sql import functions as F

from genoframe.llm import mixing, sharding
from genoframe.llm.shared import gapless


def plain_shard(key, weights):
    """The same from Python's XXH64 of the key and, seeded by that, of the shard."""
    first = 42 if key is None else xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
    best = None
    for s, w in enumerate(weights):
        u = ((xxhash.xxh64_intdigest(s.to_bytes(4, "little"), first) >> 11) + 0.5) / 2**53
        score = (-w / math.log(u), -s)
        best = max(best or score, score)
    return -best[1]


@pytest.mark.parametrize("weights", [[1.0] * 24, [1.0, 2.0, 5.0]])
def test_shards(spark, weights):
    docs = odd_documents(spark)
    rows = sharding.shards(docs, weights).collect()
    assert len(rows) == docs.count()
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == texts
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.shard == plain_shard(r.doc_id, weights) and r.law == "key"
        assert r.grown_shard == plain_shard(r.doc_id, [*weights, weights[-1]])
        assert r.grown_shard in (r.shard, len(weights))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shares_follow_weights(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = {r["shard"]: r["count"] for r in sharding.shards(rows, [1.0, 3.0]).groupBy("shard").count().collect()}
    assert abs(found[1] / 20_000 - 0.75) < 0.02


def test_no_rows_and_bad_weights(spark):
    assert sharding.shards(empty_documents(spark), [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("x"), [1.0, 0.0])


def test_gapless_of_a_hot_group(spark):
    rows = spark.range(5000).withColumn("g", F.when(F.col("id") < 4000, "hot").otherwise("cold"))
    found = gapless(rows, "g", [F.col("id")], "n", F.xxhash64("id"), 16).collect()
    for g, n in (("hot", 4000), ("cold", 1000)):
        assert sorted(r.n for r in found if r.g == g) == list(range(n))


def test_period_keeps_windows():
    parts = {"a": 7, "b": 2, "c": 1}
    places = mixing.period(parts)
    total = sum(parts.values())
    assert sorted(p for x in places.values() for p in x) == list(range(total))
    for s, own in places.items():
        for j, p in enumerate(own):
            assert j * total // parts[s] <= p < -(-(j + 1) * total // parts[s])


def test_schedule_names_each_slot_once():
    blocks = {"a": 20, "b": 3, "c": 9, "d": 0}
    runs = mixing.schedule({"a": 5, "b": 3, "c": 1, "d": 1}, blocks)
    slots = Counter()
    for r in runs:
        for b in range(r.first, r.last + 1):
            j = b - r.first
            slots[r.start + j // r.parts * r.period + r.places[j % r.parts]] += 1
    assert sorted(slots) == list(range(32)) and set(slots.values()) == {1}
    for bad in ({"a": 0}, {"a": 1.5}, {"a": mixing.MOST_PARTS + 1}):
        with pytest.raises(ValueError):
            mixing.schedule(bad, {"a": 1})


def test_mixed(spark):
    docs = odd_documents(spark, 200)
    targets = {"src0": 3, "src1": 2}
    rows = mixing.mixed(docs, targets, 1, block_rows=4).collect()
    assert sorted(r.position for r in rows) == list(range(docs.count()))
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert all(r.mix_class == (r.source if r.source in targets else "*") for r in rows)
    by_position = sorted(rows, key=lambda r: r.position)
    assert [(r.slot, r.place) for r in by_position] == sorted((r.slot, r.place) for r in rows)
    # While all classes have blocks, each has had its share to within a block at every slot.
    classes = {"src0": 3, "src1": 2, "*": 1}
    counts = Counter(r.mix_class for r in rows)
    until = min(max(r.slot for r in rows if r.mix_class == c) for c in counts)
    for t in range(1, until + 1):
        for c, parts in classes.items():
            assert abs(len({r.slot for r in rows if r.mix_class == c and r.slot < t}) - t * parts / 6) < 1


def test_mixed_order_keeps_columns(spark):
    docs = odd_documents(spark, 50)
    found = mixing.in_mixed_order(docs, {"src0": 1})
    assert found.columns == docs.columns and found.count() == docs.count()
    assert mixing.in_mixed_order(empty_documents(spark), {"src0": 1}).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(docs, {"*": 1})


def plain_schedule(parts, blocks):
    """Slot by slot: of the sources that still have blocks, each block may run from its release on; the earliest deadline runs. When one runs dry the others begin anew."""
    from fractions import Fraction

    left, order, done = {s: n for s, n in blocks.items() if n}, [], dict.fromkeys(blocks, 0)
    while left:
        total, here, slot, dry = sum(parts[s] for s in left), dict.fromkeys(left, 0), 0, False
        while not dry:
            weight = {s: Fraction(parts[s], total) for s in left}
            ready = [s for s in left if here[s] / weight[s] // 1 <= slot]
            s = min(ready, key=lambda s: (-(-(here[s] + 1) / weight[s] // 1), -parts[s], s))
            order.append((s, done[s]))
            here[s], done[s], slot = here[s] + 1, done[s] + 1, slot + 1
            left[s] -= 1
            dry = not left[s]
        left = {s: n for s, n in left.items() if n}
    return order


def test_schedule_against_slot_by_slot():
    for parts, blocks in (({"a": 5, "b": 3, "c": 1}, {"a": 20, "b": 3, "c": 9}), ({"a": 4, "b": 4, "c": 2, "d": 6}, {"a": 7, "b": 31, "c": 1, "d": 12}), ({"a": 1}, {"a": 4}), ({"a": 7, "b": 2}, {"a": 1, "b": 30})):
        found = {}
        for r in mixing.schedule(parts, blocks):
            for b in range(r.first, r.last + 1):
                j = b - r.first
                found[r.start + j // r.parts * r.period + r.places[j % r.parts]] = (r.source, b)
        assert [found[k] for k in range(len(found))] == plain_schedule(parts, blocks)


def test_shared_folder(spark, tmp_path, monkeypatch):
    from genoframe import scratch as shared

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

        def set(self, key, value):
            self[key] = value

    class Context:
        def __init__(self, master, at=None):
            self.master, self.at = master, at

        def getCheckpointDir(self):
            return self.at

    class Session:
        def __init__(self, context, **conf):
            self.sparkContext, self.conf = context, Conf(conf)

    assert shared.shared_folder(Session(Context("spark://x", "hdfs://a/b"))) == "hdfs://a/b"
    assert shared.shared_folder(Session(Context("spark://x", "hdfs://a/b"), **{"spark.checkpoint.dir": "s3://c"})) == "s3://c"
    assert shared.shared_folder(Session(Context("local[4]"))).startswith("file://")
    with pytest.raises(ValueError):
        shared.shared_folder(Session(Context("yarn")))
    rows = shared.written(spark.range(3))
    assert rows.count() == 3 and shared.own_folder(spark).split("://")[-1].strip("/") in rows.inputFiles()[0]
