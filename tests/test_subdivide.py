"""Minimizers, anchors and alignment by rounds."""

import random
import re

import pytest
from pyspark.sql import functions as F


from genoframe.functions.wavefront import Costs, affine_path
from genoframe.operators import seeds, subdivide
from genoframe.sources.fasta import chunked

TURN = str.maketrans("ACGT", "TGCA")
turned = lambda s: s[::-1].translate(TURN)


def bases(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def mutated(rng, s, rate):
    out = []
    for x in s:
        r = rng.random()
        out.append(rng.choice("ACGT") if r < rate else "" if r < 1.2 * rate else x + rng.choice("ACGT") if r < 1.4 * rate else x)
    return "".join(out)


def plain_minimizers(s, k, w):
    """(place, hash, turned) word by word."""
    hashes, strands = seeds.words(s.encode(), k)
    found = {}
    for i in range(len(hashes) - w + 1):
        j = min(range(i, i + w), key=lambda j: (int(hashes[j]), j))
        word = s[j : j + k]
        if set(word) <= set("ACGT") and word != turned(word):
            assert bool(strands[j]) == (turned(word) < word)
            found[j] = (int(hashes[j].astype("int64")), bool(strands[j]))
    return {(j, *v) for j, v in found.items()}


@pytest.mark.parametrize("chunk", [50, 333, 10**6])
def test_minimizers_do_not_depend_on_chunks(spark, chunk):
    rng = random.Random(1)
    seqs = {"a": bases(rng, 1200), "n": bases(rng, 100) + "NNN" + bases(rng, 90), "short": bases(rng, 9), "same": "ACGT" * 40, "empty": ""}
    df = spark.createDataFrame(list(seqs.items()), "seq_id string, seq string")
    found = seeds.minimizers(seeds.overlapping(df, chunk, 14), 8, 5).collect()
    want = {(n, *m) for n, s in seqs.items() for m in plain_minimizers(s, 8, 5)}
    assert len(found) == len(want) and {(r.seq_id, r.pos, r.hash, r.turned) for r in found} == want
    assert seeds.words(b"ACCGTA", 6)[0] == seeds.words(turned("ACCGTA").encode(), 6)[0]


def test_seeds_and_frequent_words(spark):
    rows = lambda name, hashes: spark.createDataFrame([(name, i * 10, h, h % 2 == 1) for i, h in enumerate(hashes)], seeds.MINIMIZERS)
    t, q = rows("t", [1, 2, 3, 3, 3, 4]), rows("q", [2, 3, 1, 9, 4, 4, 4])
    found = seeds.seeds(t, q.withColumn("turned", F.lit(True)), 2)
    assert sorted((r.t_pos, r.q_pos, r.strand) for r in found.collect()) == [(0, 20, "+"), (10, 0, "-")]
    assert {(r.hash, r.n) for r in seeds.frequent(t, 2).collect()} == {(3, 3)}


def test_anchors_of_changed_sequences_against_all_words(spark):
    rng = random.Random(4)
    t = bases(rng, 20_000)
    parts = [mutated(rng, t[:6000], 0.05), bases(rng, 3000), mutated(rng, t[6000:12000], 0.05), turned(mutated(rng, t[12000:16000], 0.05)), mutated(rng, t[16000:], 0.05)]
    q = "".join(parts)
    frames = [spark.createDataFrame([(n, s)], "seq_id string, seq string") for n, s in (("t", t), ("q", q))]
    minis = [seeds.minimizers(seeds.overlapping(f, 1000)) for f in frames]
    found = seeds.anchors(seeds.seeds(*minis)).collect()
    k, places = seeds.K, {}
    for i in range(len(t) - k + 1):
        places.setdefault(t[i : i + k], []).append(i)
    exact = {"+": [(i, j) for j in range(len(q) - k + 1) for i in places.get(q[j : j + k], [])], "-": [(i, j) for j in range(len(q) - k + 1) for i in places.get(turned(q[j : j + k]), [])]}
    for strand, least in (("+", 0.95), ("-", 0.95)):
        own = [a for a in found if a.strand == strand]
        inside = [p for p in exact[strand] if any(a.t_start - 100 <= p[0] < a.t_end + 100 and a.q_start - 100 <= p[1] < a.q_end + 100 for a in own)]
        assert len(inside) >= least * len(exact[strand]) > 0
    assert all(a.n >= 3 and a.t_end - a.t_start <= 20_000 for a in found)
    back = [a for a in found if a.strand == "-"]
    assert back and min(a.t_start for a in back) >= 11_900 and max(a.t_end for a in back) <= 16_100
    assert seeds.anchors(seeds.seeds(*minis).limit(0)).count() == 0


def affine_cost(cs, cg):

    costs = Costs()
    return costs.mismatch * len(re.findall(r"\*", cs)) + sum(costs.gap(int(n)) for n, op in re.findall(r"(\d+)([ID])", cg))


def frames(spark, seqs, rows):
    sequences = spark.createDataFrame(list(seqs.items()), "seq_id string, seq string")
    segments = spark.createDataFrame(rows, "segment_id string, t string, t_start long, t_end long, q string, q_start long, q_end long, strand string")
    return segments, chunked(sequences, 4096)


def rounds(spark, seqs, rows, most, **more):
    segments, chunks = frames(spark, seqs, rows)
    records, skips = subdivide.align_in_rounds(segments, chunks, most, size=4096, **more)
    return records.collect(), skips.collect()


@pytest.mark.parametrize("large", [1_000_000, 6000])
def test_one_large_insertion_stays_in_register(spark, large):
    rng = random.Random(7)
    t = bases(rng, 20_000)
    q = mutated(rng, t[:9000], 0.03) + bases(rng, 3000) + mutated(rng, t[9000:], 0.03)
    seqs = {"t": t, "q": q, "r": turned(q)}
    rows = [("ahead", "t", 1, len(t), "q", 1, len(q), "+"), ("back", "t", 1, len(t), "r", 1, len(q), "-")]
    found, skips = rounds(spark, seqs, rows, 4000, piece=4000, large=large)
    for name in ("ahead", "back"):
        own = sorted((r for r in found if r.segment_id == name), key=lambda r: r.t_start)
        assert sum(r.nmatch for r in own) > 0.95 * 20_000
        assert all(a.t_end <= b.t_start for a, b in zip(own, own[1:]))
    for r in found:
        steps = [(int(n), op) for n, op in re.findall(r"(\d+)([MID])", r.cg)]
        assert sum(n for n, op in steps if op in "MD") == r.t_end - r.t_start and sum(n for n, op in steps if op in "MI") == r.q_end - r.q_start
        assert r.score == affine_cost(r.cs, r.cg)
        part = seqs[r.q][r.q_start : r.q_end]
        part = part if r.strand == "+" else turned(part)
        assert r.score == affine_path(t[r.t_start : r.t_end], part)[0]
    assert {s.reason for s in skips} <= {"gap"}


def test_reasons_and_odd_segments(spark):
    rng = random.Random(8)
    t = bases(rng, 300)
    seqs = {"t": t, "q": bases(rng, 300), "low": t.lower()}
    rows = [("far", "t", 1, 300, "q", 1, 300, "+"), ("none", "t", 1, 9, "x", 1, 9, "+"), ("long", "t", 1, 200, "q", 1, 20, "+"), ("bare", "t", 5, 4, "q", 1, 9, "+"), ("low", "t", 1, 300, "low", 1, 300, "+"), ("out", "t", 1000, 1100, "q", 1, 100, "+")]
    found, skips = rounds(spark, seqs, rows, 40, rounds=1, max_ratio=4.0)
    assert {(s.segment_id, s.reason) for s in skips if s.segment_id != "far"} == {("none", "no_sequence"), ("long", "length_ratio"), ("bare", "empty_span"), ("out", "no_sequence")}
    assert {s.reason for s in skips if s.segment_id == "far"} == {"too costly"}
    (low,) = [r for r in found if r.segment_id == "low"]
    assert (low.score, low.nmatch) == (0, 300)
    empty = rounds(spark, seqs, rows, 40)[0]
    assert empty
    segments, chunks = frames(spark, seqs, rows)
    records, skips = subdivide.align_in_rounds(segments.limit(0), chunks, 40, size=4096)
    assert records.count() == skips.count() == 0
