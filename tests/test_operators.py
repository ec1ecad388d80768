"""Small cases worked out by hand, and plain versions of what SQL does not express."""

import random

import pytest
from pyspark.sql import functions as F

from genoframe.functions import alignments as A
from genoframe.functions import codons, names, params
from genoframe.functions.align import align_by_tiles, align_pairs, edit_path
from genoframe.operators import assembly, chains, divergence, intervals, rates, scene, synteny, trees, variants, windows
from genoframe.plans import structure

CS = ":10*ag:5+ac*ct:3-ttt*ac:7*nn"
CG = "16M2I4M3D9M"


def one(df):
    return df.collect()[0]


def test_difference_string(spark):
    paf = spark.createDataFrame([("q", 0, 31, "+", "t", 0, 32, CS, CG)], "q_name string, q_start long, q_end long, strand string, t_name string, t_start long, t_end long, cs string, cg string")
    r = one(divergence.with_distance(paf))
    assert (r.msum, r.ti, r.tv, round(r.k2p, 6)) == (29, 2, 2, 0.153006)
    r = one(divergence.with_distance(paf, no_adjacent=True))
    assert (r.ti, r.tv) == (2, 2)
    r = one(divergence.with_distance(paf, off_indels=2))
    assert (r.ti, r.tv, r.sites, round(r.k2p, 6)) == (1, 1, 27, 0.078132)
    r = one(paf.select(A.cs_counts(F.col("cs")).alias("c"), A.gap_compressed_divergence(F.col("cs")).alias("de"), A.cigar_of(F.col("cs")).alias("cg")))
    assert (*r.c, round(r.de, 4), r.cg) == (25, 4, 2, 3, 2, 0.1935, CG)
    found = [(v.ref_start, v.query_start, v.ref_allele, v.query_allele) for v in variants.substitutions(paf).collect()]
    assert found == [(10, 10, "a", "g"), (16, 18, "c", "t"), (23, 22, "a", "c"), (31, 30, "n", "n")]
    found = [(v.kind, v.seq, v.start, v.end) for v in variants.presence_absence(paf, 1).collect()]
    assert found == [("ins", "ac", 16, 17), ("del", "ttt", 20, 22)]


def test_distance_is_null_where_undefined(spark):
    rows = spark.createDataFrame([(0, 0, 0), (0, 0, 10), (5, 5, 10)], "ti long, tv long, n long")
    assert [r[0] for r in rows.select(A.k2p(F.col("ti"), F.col("tv"), F.col("n"))).collect()] == [None, 0.0, None]


def test_genome_of(spark):
    rows = spark.createDataFrame([("annuaA_chr_chr1",), ("zz_chr1",), ("annuaA",)], "n string")
    known = spark.createDataFrame([("annuaA",), ("annuaA_chr",)], "genome string")
    found = {r.n: r.g for r in names.genome_of(rows, "n", known, "g").collect()}
    assert found == {"annuaA_chr_chr1": "annuaA_chr", "zz_chr1": "zz", "annuaA": "annuaA"}
    many = known.unionByName(spark.range(names.MOST_INLINE).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("genome")))
    assert {r.n: r.g for r in names.genome_of(rows, "n", many, "g").collect()} == found


def test_names(spark):
    rows = spark.createDataFrame([("chr10",), ("chr2",), ("chr1",)], "n string")
    assert [r.n for r in rows.orderBy(names.natural_key(F.col("n"))).collect()] == ["chr1", "chr2", "chr10"]
    r = one(spark.range(1).select(names.file_stem(F.lit("/a/B.x.FA.gz")).alias("a"), names.seconds(F.lit("10m")).alias("b"), names.seconds(F.lit("90")).alias("c"), *[names.letters(F.lit(n)).alias(f"l{n}") for n in (1, 26, 27, 702, 703)]))
    assert tuple(r) == ("B.x", 600, 90, "A", "Z", "AA", "ZZ", "AAA")


def test_windows(spark):
    fai = spark.createDataFrame([("c", 230)], "chrom string, len long")
    found = windows.make_windows(fai, 100, 50)
    assert sorted((r.start, r.end) for r in found.collect()) == [(0, 100), (50, 150), (100, 200), (150, 230), (200, 230)]
    snps = spark.createDataFrame([("c", 100)], "chrom string, pos long")
    counted = {r.start: r.snps for r in windows.snp_windows(found, snps, 100, 50).collect()}
    assert counted == {0: 0, 50: 1, 100: 1, 150: 0, 200: 0}
    none = windows.window_averages(found, spark.createDataFrame([], "chrom string, start long, end long, de double"), 50)
    assert {r.avg_de for r in none.collect()} == {None}


def test_pair_averages(spark):
    rows = spark.createDataFrame([("x", "y", 1.0, 0.2), ("y", "x", 3.0, 0.4), ("x", "z", 0.0, 0.5), ("x", "y", 9.0, None)], "id1 string, id2 string, weight double, value double")
    found = {(r.id1, r.id2): (r.weight, round(r.avg, 6)) for r in divergence.chromosome_averages(rows).collect()}
    assert found == {("x", "y"): (4.0, 0.35), ("x", "z"): (0.0, 0.0)}


def test_containment_of_equal_rows(spark):
    rows = spark.createDataFrame([(1, "t", 0, 9, 0, 9), (2, "t", 0, 9, 0, 9), (3, "t", 2, 5, 3, 4)], "rid long, t string, t_start long, t_end long, q_start long, q_end long")
    kept = lambda first: sorted(r.rid for r in intervals.without_contained(rows, "rid", ["t"], 4, first).collect())
    assert kept(True) == [1]
    assert kept(False) == []


COORDS = "rid long, t string, t_start long, t_end long, q string, q_start long, q_end long, strand string, block long"


def test_trim_and_merge(spark):
    rows = spark.createDataFrame([(1, "t", 0, 100, "q", 0, 100, "+", 1), (2, "t", 50, 200, "q", 60, 210, "+", 1)], COORDS)
    assert sorted((r.t_start, r.q_start) for r in synteny.trim_overlaps(rows).collect()) == [(0, 0), (100, 100)]
    rows = spark.createDataFrame([(k, "t", a, a + 100, "q", a, a + 100, "+", 1) for k, a in enumerate((0, 100, 200))], COORDS)
    assert sorted((r.t_start, r.t_end, r.status) for r in synteny.merge_small(rows, 150).collect()) == [(0, 200, "pass"), (200, 300, "fail")]


def _random_coords(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        a, b = rng.randrange(2000), rng.randrange(2000)
        out.append((k, "t", a, a + rng.randrange(1, 120), "q", b if k % 3 else a + 5, (b if k % 3 else a + 5) + rng.randrange(1, 120), "+", k % 2))
    return out


def test_trim_against_all_pairs(spark):
    rows = _random_coords(150, 1)
    plain = [list(r) for r in sorted(rows, key=lambda r: (r[2], r[5], r[3], r[6], r[8], r[0]))]
    for i, a in enumerate(plain):
        for j, b in enumerate(plain):
            if i != j and a[2] < b[2] < a[3] < b[3] and a[5] < b[5] < a[6] < b[6]:
                b[2], b[5] = a[3], a[6]
    found = [list(r) for r in synteny.trim_overlaps(spark.createDataFrame(rows, COORDS)).collect()]
    assert sorted(found) == sorted(plain)


def test_merge_against_plain(spark):
    rows, want = _random_coords(150, 2), []
    for block in (0, 1):
        todo = sorted([r[2], r[5], r[3], r[6]] for r in rows if r[8] == block)
        todo = [[a, c, b, d] for a, b, c, d in todo]
        while todo:
            cur = todo.pop(0)
            hit = None
            if cur[1] - cur[0] < 90 or cur[3] - cur[2] < 90:
                hit = next((i for i, o in enumerate(todo) if cur[0] <= o[1] and cur[1] >= o[0] and cur[2] <= o[3] and cur[3] >= o[2]), None)
            if hit is None:
                want.append((block, *cur))
            else:
                o = todo[hit]
                todo[hit] = [min(cur[0], o[0]), max(cur[1], o[1]), min(cur[2], o[2]), max(cur[3], o[3])]
    found = [(r.block, r.t_start, r.t_end, r.q_start, r.q_end) for r in synteny.merge_small(spark.createDataFrame(rows, COORDS), 90).collect()]
    assert sorted(found) == sorted(want)


def test_islands_across_ranges(spark):
    rng = random.Random(15)
    rows = [(rng.choice("ab"), s := rng.randrange(30_000), s + rng.choice([1, 5, 50, 4000 if rng.random() < 0.05 else 20])) for _ in range(500)]
    df = spark.createDataFrame(rows, "chrom string, start long, end long")
    found = lambda size: sorted(tuple(r) for r in intervals.islands(df, ["chrom"], size).collect())
    assert found(100) == found(None) == found(1 << 20) and len(found(100)) > 20
    covered = {c: len({p for x, a, b in rows if x == c for p in range(a, b)}) for c in "ab"}
    for size in (100, None):
        assert {r.chrom: r.covered for r in intervals.covered_bases(df, ["chrom"], size).collect()} == covered


def test_overlaps_on_levels(spark):
    rng = random.Random(16)
    rows = lambda n, seed: [(k, rng.choice("ab"), s := rng.randrange(100_000), s + rng.choice([1, 20, 300, 9000, 60_000])) for k in range(n)]
    a, b = rows(120, 1), rows(120, 2)
    schema = "id long, chrom string, start long, end long"
    left, right = spark.createDataFrame(a, schema), intervals.prefixed(spark.createDataFrame(b, schema))
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and x[3] > y[2])
    for levels in (1, 2, 3):
        found = intervals.overlap_join(left, right, ["chrom"], 16, levels=levels)
        assert sorted((r.id, r.r_id) for r in found.collect()) == want
    near = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and abs(x[2] - y[2]) <= 0.9 * (y[3] - y[2]) and abs(x[3] - y[3]) <= 0.9 * (y[3] - y[2]))
    assert sorted((r.id, r.r_id) for r in intervals.near_join_by_share(left, right, ["chrom"], 0.9, 16).collect()) == near
    one = spark.createDataFrame([(1, "c", 1000, 51_000)], schema), intervals.prefixed(spark.createDataFrame([(2, "c", 41_000, 91_000)], schema))
    assert intervals.near_join_by_share(*one, ["chrom"], 0.9).count() == 1


def test_nearest_against_all_pairs(spark):
    rng = random.Random(17)
    rows = [(k, rng.choice("abc"), s := rng.randrange(10_000_000), s + rng.randrange(1, 900)) for k in range(150)]
    paint = [(rng.choice("ab"), s := rng.randrange(10_000_000), s + rng.randrange(1, 40_000), f"r{k % 7}", k) for k in range(120)]
    want = {}
    for k, c, s, e in rows:
        own = [(max(0, min(e, b) - max(s, a)), max(a - e, s - b, 0), o, ref) for x, a, b, ref, o in paint if x == c]
        best = min(((-sh, o, ref) for sh, _, o, ref in own if sh), default=None) or min(((d, o, ref) for _, d, o, ref in own), default=(0, 0, None))
        want[k] = best[2]
    df = spark.createDataFrame(rows, "id long, chrom string, start long, end long")
    painted = spark.createDataFrame(paint, "chrom string, start long, end long, ref string, ord int")
    assert {r.id: r.ref for r in intervals.best_overlap(df, painted, "id", ["chrom"], 5000).collect()} == want


def test_segments_aligned_by_halving(spark):
    rng = random.Random(18)
    t = "".join(rng.choice("ACGT") for _ in range(1200))
    q = t[:600] + "".join(rng.choice("ACGT") for _ in range(600))
    turned = "".join({"A": "T", "C": "G", "G": "C", "T": "A"}[x] for x in reversed(t))
    seqs = spark.createDataFrame([("t", t), ("q", q), ("r", turned)], "seq_id string, seq string")
    rows = [("same", "t", 1, 600, "q", 1, 600, "+"), ("half", "t", 1, 1200, "q", 1, 1200, "+"), ("back", "t", 101, 400, "r", 801, 1100, "-"), ("none", "t", 1, 9, "x", 1, 9, "+"), ("long", "t", 1, 400, "q", 1, 40, "+")]
    segments = spark.createDataFrame(rows, "segment_id string, t string, t_start long, t_end long, q string, q_start long, q_end long, strand string")
    records, skips = synteny.align_segments(segments, seqs, 60, 4, 4.0)
    found = records.collect()
    assert {r.segment_id for r in found} >= {"same", "half", "back"}
    for r in found:
        part = {"t": t, "q": q, "r": turned}[r.q][r.q_start : r.q_end]
        part = part if r.strand == "+" else "".join({"A": "T", "C": "G", "G": "C", "T": "A"}[x] for x in reversed(part))
        same = sum(x == y for x, y in zip(t[r.t_start : r.t_end], part)) if r.segment_id != "half" else r.nmatch
        assert r.nmatch >= same
    half = [r for r in found if r.segment_id == "half"]
    assert min(r.t_start for r in half) == 0 and max(r.t_end for r in half) >= 600
    reasons = {(r.segment_id, r.reason) for r in skips.collect()}
    assert reasons == {("none", "no_sequence"), ("long", "length_ratio")}
    assert ("half", "too costly") in {(r.segment_id, r.reason) for r in synteny.align_segments(segments, seqs, 60, 0)[1].collect()}


def test_chain_blocks(spark):
    rows = [(0, 100, 0, 100, 100), (150, 300, 140, 290, 150), (900, 950, 900, 950, 50)]
    paf = spark.createDataFrame([("t", "q", "+", a, b, c, d, n, n) for a, b, c, d, n in rows], "t_name string, q_name string, strand string, t_start long, t_end long, q_start long, q_end long, nmatch long, alnlen long")
    found = chains.chain_blocks(paf, 1000, 10, 1.0)
    assert sorted((r.ref_start, r.ref_end, r.n_records, r.aln_len) for r in found.collect()) == [(0, 300, 2, 250), (900, 950, 1, 50)]
    assert chains.chain_blocks(paf, 1000, 10, 0).count() == 1
    assert chains.chain_blocks(paf.limit(0)).count() == 0


def test_disjoint_and_tiled(spark):
    rng = random.Random(3)
    rows = [("s", a := rng.randrange(5000), a + rng.randrange(1, 300), b := rng.randrange(5000), b + rng.randrange(1, 300), "+", 1) for _ in range(200)]
    kept = []
    for r in sorted(rows, key=lambda r: (-(r[2] - r[1] + r[4] - r[3]), r[1], r[3], r[5])):
        if all((r[2] <= k[1] or r[1] >= k[2]) and (r[4] <= k[3] or r[3] >= k[4]) for k in kept):
            kept.append(r)
    df = spark.createDataFrame(rows, "segment string, t_start long, t_end long, q_start long, q_end long, strand string, n_anchors long")
    found = chains.drop_overlaps(df, "segment")
    assert sorted(tuple(r) for r in found.collect()) == sorted(kept)
    rows = [("s", 10, 20, 5, 15, "+", 1), ("s", 40, 60, 35, 50, "-", 1)]
    df = spark.createDataFrame(rows, df.schema).withColumns({"tl": F.lit(100).cast("long"), "ql": F.lit(90).cast("long")})
    assert sorted((r.t_start, r.t_end, r.q_start, r.q_end) for r in chains.tile(df, "segment", "tl", "ql").collect()) == [(0, 30, 0, 25), (30, 100, 25, 90)]


def test_rates(spark):
    ks = spark.createDataFrame([("a", "b", x) for x in (0.0, 0.1, 0.2, 0.4, 0.9, 2.0, None)], "id1 string, id2 string, ks double")
    r = one(rates.medians(ks, 2.0))
    assert (r.n, round(r.median, 6)) == (4, 0.3)


def test_trees(spark):
    rows = [("A", "B", 2.0), ("A", "C", 4.0), ("B", "C", 6.0)]
    pairs = spark.createDataFrame([(*r, 0) for r in rows], "id1 string, id2 string, d double, ord int")
    matrix = divergence.symmetric(pairs, "d")
    assert one(trees.newick(matrix)).tree == "((A:1,B:1):1.5,C:2.5);"
    assert one(trees.newick(matrix, "nj")).tree.count("(") == 2
    assert trees.without_decimals("(A:1.25,B:3);") == "(A:1,B:3);"


def test_symmetric_last_value_and_missing(spark):
    pairs = spark.createDataFrame([("A", "B", 1.0, 0), ("B", "A", 2.0, 1), ("A", "C", 3.0, 2)], "id1 string, id2 string, d double, ord int")
    found = {(r.i, r.j): r.d for r in divergence.symmetric(pairs, "d").collect()}
    assert found["A", "B"] == found["B", "A"] == 2.0 and found["B", "C"] is None and found["C", "C"] == 0.0
    assert {(r.i, r.j): r.d for r in divergence.symmetric(pairs, "d", 0.0).collect()}["B", "C"] == 0.0


def test_codons(spark):
    assert codons.repaired("ATGGCC", "MA") == ("ATGGCC", [])
    assert codons.repaired("ATGAGCC", "MA") == ("ATGGCC", [(3, "A")])
    assert codons.repaired("ATGTTTGGCCAAA", "MAK")[1] == [(3, "TTTG")]
    with pytest.raises(ValueError):
        codons.repaired("ATG", "MA")
    rows = spark.createDataFrame([("ATGAGCC", "MA*"), ("ATG", "MA"), (None, None)], "cds string, protein string")
    found = codons.repair_frames(rows).select("repair.*").collect()
    assert found[0].fixed == "ATGGCC" and found[0].out[0].at == 3 and "amino acid 2" in found[1].error


def test_repaired_frames_of_all_documents(spark, tmp_path):
    rng = random.Random(4)
    texts = {k: "".join(rng.choice("acgt") for _ in range(n)) for k, n in enumerate((0, 2, 3, 50, 300, 900, 2000))} | {7: "atgtaagcc" * 20, 8: "taa", 9: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.id: r for r in structure.repaired_frames(spark, str(tmp_path)).collect()}
    base = str.maketrans("bdefhijklmnopqrsuvwxyz", "acgtacgtacgtacgtacgtacgt"[:22])
    assert found.keys() == texts.keys()
    for k, text in texts.items():
        meant = (text or "").translate(base)
        meant = meant[: len(meant) // 3 * 3]
        protein = "".join(codons.amino_acid(meant[i : i + 3]) for i in range(0, len(meant), 3))
        cds = "".join(meant[i : i + 30] + "a" * (i + 30 <= len(meant)) for i in range(0, len(meant), 30))
        try:
            fixed, out, error = *codons.repaired(cds, protein.rstrip("*")), None
        except ValueError as e:
            fixed, out, error = None, None, str(e)
        assert (found[k].fixed, found[k].out and [tuple(x) for x in found[k].out], found[k].error) == (fixed, out, error)
    assert "taa" in found[7].fixed


def test_params(spark):
    r = one(spark.range(1).select(params.changed(F.lit('{"a":"1","b":"2","c":"3"}'), F.lit('{"a":"1","b":"4","d":"3"}')).alias("m"), params.in_bases(F.lit(12500)).alias("b")))
    assert {k: tuple(v) for k, v in r.m.items()} == {"b": ("2", "4")} and r.b == "12.5 kb"


def test_chromosome_names(spark):
    rows = spark.createDataFrame([(1, "chr01A"), (2, "chr1b"), (3, "Chr1"), (4, "chr01a"), (5, "chr2"), (6, "scaffold3")], "ord long, header string")
    found = {r.ord: r.new for r in assembly.name_chromosomes(rows, "Zm").collect()}
    assert found == {1: "Zm_chr1A", 2: "Zm_chr1B", 3: "Zm_chr1C", 4: "Zm_chr1D", 5: "Zm_chr2"}


def test_chromosome_names_after_z(spark):
    headers = [(i, f"chr{i % 2 + 1}" + ("b" if i % 5 == 0 else "")) for i in range(1600)]
    found = {r.ord: r for r in assembly.name_chromosomes(spark.createDataFrame(headers, "ord long, header string"), "Zm").collect()}
    spelled = lambda n: spelled((n - 1) // 26) + chr(65 + (n - 1) % 26) if n else ""
    free, kept = {c: (x for n in range(1, 2000) if (x := spelled(n)) != "B") for c in "12"}, set()
    for i, header in headers:
        own = "B" if header.endswith("b") and header[3] not in kept else next(free[header[3]])
        kept |= {header[3]} if own == "B" else set()
        assert found[i].letter == own and found[i].new == f"Zm_chr{header[3]}{own}"
    assert len({r.new for r in found.values()}) == 1600
    ns = [1, 26, 27, 702, 703, 18278, 18279, 475254, 475255, 10**9]
    assert [r.x for r in spark.createDataFrame([(n,) for n in ns], "n long").select(names.letters(F.col("n")).alias("x")).collect()] == [spelled(n) for n in ns]


def test_chromosomes_of_one_scale(spark):
    fai = spark.createDataFrame([("x1", 100), ("y2", 90)], "chrom string, len long")
    assert {r.rule for r in assembly.chromosomes(fai).collect()} == {"pure-scale"}


def test_triage_against_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(scene, "FOLD_ROWS", 25)
    rng = random.Random(14)
    blocks = []
    for k in range(150):
        s, t, n = rng.randrange(4000), rng.randrange(4000), rng.randrange(0, 120)
        blocks.append((k, rng.choice("ab"), s, s + n, rng.choice("xyz"), t, t + (n if k % 3 else rng.randrange(0, 12)), "+"))

    def bare(spans, s, e):
        return 0.0 if e <= s else 1 - len({p for a, b in spans for p in range(max(a, s), min(b, e))}) / (e - s)

    df = spark.createDataFrame(blocks, "id long, ca string, sa long, ea long, cb string, sb long, eb long, strand string")
    for both in (True, False):
        up, down, want, skewed = {}, {}, {}, []
        for k, ca, sa, ea, cb, sb, eb, _ in blocks:
            low, high = sorted((ea - sa, eb - sb))
            ratio = high / low if low > 0 else float("inf")
            if ratio > 4:
                skewed.append((ratio, k))
            else:
                want[k] = "clean"
                up.setdefault(ca, []).append((sa, ea))
                down.setdefault(cb, []).append((sb, eb))
        for _, k in sorted(skewed):
            _, ca, sa, ea, cb, sb, eb, _ = blocks[k]
            shares = bare(up.get(ca, []), sa, ea), bare(down.get(cb, []), sb, eb)
            want[k] = "rescued" if (min if both else max)(shares) >= 0.5 else "dropped"
            if want[k] == "rescued":
                up.setdefault(ca, []).append((sa, ea))
                down.setdefault(cb, []).append((sb, eb))
        triaged = scene.triage(df, 4.0, 0.5, both)
        assert {r.id: r.verdict for r in triaged.collect()} == want
        assert len(set(want.values())) == 3
    top = [r.ratio for r in scene.top_rescued(triaged, 3).collect()]
    assert len(top) == 3 and top == sorted(top, reverse=True)


def test_triage(spark):
    blocks = [(1, "a", 0, 100, "b", 0, 100, "+"), (2, "a", 200, 300, "b", 200, 210, "+"), (3, "a", 0, 90, "b", 50, 55, "+"), (4, "a", 210, 300, "b", 201, 206, "+")]
    df = spark.createDataFrame(blocks, "id long, ca string, sa long, ea long, cb string, sb long, eb long, strand string")
    assert {r.id: r.verdict for r in scene.triage(df, 4.0, 0.5).collect()} == {1: "clean", 2: "rescued", 3: "dropped", 4: "dropped"}


def test_painted(spark):
    rows = [("c", 100, 0, 30, "A"), ("c", 100, 20, 50, "B"), ("c", 100, 80, 100, "A")]
    df = spark.createDataFrame(rows, "chrom string, len long, start long, end long, ref string")
    found = sorted((r.start, r.end, r.ref) for r in scene.painted(df, 10).collect())
    assert found == [(0.0, 30.0, "A"), (30.0, 60.0, "B"), (60.0, 100.0, "A")] or found == [(0.0, 30.0, "A"), (30.0, 70.0, "B"), (70.0, 100.0, "A")]


def test_reverse_complement_twice(spark):
    r = one(spark.range(1).select(A.reverse_complement(A.reverse_complement(F.lit("ACGTnacgtN"))).alias("x"), A.reverse_complement(F.lit("AACG")).alias("y")))
    assert tuple(r) == ("ACGTnacgtN", "CGTT")


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_path():
    rng = random.Random(4)
    for _ in range(150):
        a = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 40)))
        b = "".join(c for c in a if rng.random() > 0.1) if rng.random() < 0.7 else "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 40)))
        path = edit_path(a, b)
        t = q = edits = 0
        for op, n in path:
            if op in "=X":
                assert all((x == y) == (op == "=") for x, y in zip(a[t : t + n], b[q : q + n]))
            t, q, edits = t + n * (op != "I"), q + n * (op != "D"), edits + n * (op != "=")
        assert (t, q) == (len(a), len(b)) and edits == _edits(a, b)
    assert edit_path("A" * 50, "C" * 50, most=10) is None


def test_edit_path_of_long_and_other_sequences():
    rng = random.Random(5)
    base = "".join(rng.choice("ACGT") for _ in range(3000))
    for b in ("", "A", base[:1500], base[700:], base[::-1][:400], "".join(c for c in base if rng.random() > 0.02), "T" * 300):
        path = edit_path(base, b)
        assert sum(n for op, n in path if op != "I") == 3000 and sum(n for op, n in path if op != "D") == len(b)
    far = edit_path(base, "".join(rng.choice("ACGT") for _ in range(2500)))
    assert sum(n for op, n in far if op != "=") > 1000


def test_tiles(spark):
    rng = random.Random(6)
    pairs = []
    for k in range(12):
        t = "".join(rng.choice("acgt") for _ in range(rng.randrange(1, 4000)))
        q = "".join(rng.choice("acgt") if rng.random() < 0.02 * (k % 4) else c for c in t if rng.random() > 0.02 * (k % 3))
        if k == 5:
            q = q[:200] + "".join(rng.choice("acgt") for _ in range(900)) + q[200:]
        pairs.append((k, t, q or "a"))
    pairs += [(20, "a" * 900, "a" * 850), (21, "acgt", "tgca"), (22, "", "a"), (23, None, "a"), (24, "ac" * 400, "ca" * 380)]
    df = spark.createDataFrame(pairs, "id long, target string, query string")
    found = {r.id: r for r in align_by_tiles(df, "id", long=True).withColumns({"t": A.target_of(F.col("cs")), "q": A.query_of(F.col("cs")), "cigar": A.cigar_of(F.col("cs")), "counts": A.cs_counts(F.col("cs"))}).collect()}
    assert found.keys() == {k for k, t, q in pairs if t and q}
    for k, t, q in pairs:
        if t and q:
            r = found[k]
            assert (r.t, r.q, r.cigar) == (t, q, r.cg) and r.counts.matches == r.nmatch
            least = _edits(t, q) if len(t) < 1000 else sum(n for op, n in edit_path(t, q) if op != "=")
            assert least <= r.edits <= 1.05 * least + 5


def test_align_pairs(spark):
    rows = spark.createDataFrame([("ACGTACGT", "ACGTTACCT"), ("", "A"), (None, "A"), ("A" * 9, "C" * 9)], "target string, query string")
    found = [r.aln for r in align_pairs(rows, most=5).collect()]
    assert (found[0].edits, found[0].nmatch) == (2, 7) and found[0].cs.count("+") == 1
    assert [f.reason for f in found] == [None, "empty", "empty", "too many edits"]


def test_covering_tiles(spark):
    rows = [("s", 10, 20, 5, 15), ("s", 15, 30, 14, 40), ("s", 40, 50, 40, 45)]
    df = spark.createDataFrame(rows, "segment string, t_start long, t_end long, q_start long, q_end long").withColumns({"tl": F.lit(60).cast("long"), "ql": F.lit(50).cast("long")})
    found = sorted(tuple(r)[1:] for r in chains.covering_tiles(df, "segment", "tl", "ql").collect())
    assert found == [(0, 10, 0, 5, False), (10, 20, 5, 15, True), (20, 40, 15, 40, False), (40, 50, 40, 45, True), (50, 60, 45, 50, False)]


def test_turned_cigar(spark):
    r = one(spark.range(1).select(A.turned_cigar(F.lit("3=2M1I1I4D")).alias("c")))
    assert r.c == "5=2D4I"


def test_chromosomes_by_length_cliff(spark):
    sizes = [1000, 990, 980, 20, 19, 18, 17]
    fai = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "chrom string, len long")
    found = assembly.chromosomes(fai).collect()
    assert {(r.chrom, r.rule) for r in found} == {(f"s{i}", "length-cliff") for i in range(3)}
    flat = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate([1000, 600, 350, 200, 120, 70])], "chrom string, len long")
    assert assembly.chromosomes(flat, min_fold=3.0).count() == 0
