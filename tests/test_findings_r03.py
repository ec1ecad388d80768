"""Small cases of what a review found."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from genoframe.functions import align, alignments, codons
from genoframe.operators import chains, groups, intervals, scene, seeds
from genoframe.sources import fasta, tables, text
from genoframe.sources.tables import paf_of


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def rows_of_joins(df, spark):
    """Rows that joins of df made, by the metrics of its plan."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if "Join" in name:
            n += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return n


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def rows_of_joins(df, spark):
    """Rows that joins of df made, by the metrics of its plan."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if "Join" in name:
            n += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return n


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def rows_of_joins(df, spark):
    """Rows that joins of df made, by the metrics of its plan."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if "Join" in name:
            n += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return n


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def rows_of_joins(df, spark):
    """Rows that joins of df made, by the metrics of its plan."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if "Join" in name:
            n += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return n


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def rows_of_joins(df, spark):
    """Rows that joins of df made, by the metrics of its plan."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if "Join" in name:
            n += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return n


def test_a_repeat_is_not_one_groups_rows(spark):
    rng = random.Random(3)
    unit = "".join(rng.choice("acgt") for _ in range(40))
    own = "".join(rng.choice("acgt") for _ in range(3000))
    df = spark.createDataFrame([("s", own + unit * 200 + own[:500])], "seq_id string, seq string")
    every, few = (seeds.minimizers(seeds.overlapping(df, 5000), most=most) for most in (None, 4))
    most = lambda x: x.groupBy("hash").count().agg(F.max("count")).first()[0]
    assert most(every) > 100 and most(few) <= 3 * 5
    found = [sorted(map(tuple, seeds.seeds(x, x, 4).collect())) for x in (every, few)]
    assert found[0] == found[1] != []


def test_seeds_deal_each_side_once(spark):
    df = spark.createDataFrame([("s", i, i % 50, False) for i in range(200)], seeds.MINIMIZERS)
    assert exchanges(seeds.seeds(df, df.withColumn("pos", F.col("pos") + 1))) == 2


def test_anchors_of_whole_pairs_are_those_of_stretches(spark):
    rng = random.Random(5)
    one = "".join(rng.choice("acgt") for _ in range(9000))
    two = one[:2000] + one[7000:] + one[3000:4000]
    minis = [seeds.minimizers(seeds.overlapping(spark.createDataFrame([("s", x)], "seq_id string, seq string"))) for x in (one, two)]
    found = seeds.seeds(*minis)
    rows = [sorted(map(tuple, seeds.anchors(found, long=long).collect())) for long in (True, False)]
    assert rows[0] == rows[1] and len(rows[0]) >= 2


def test_cover_is_met_as_islands(spark):
    rows = spark.createDataFrame([(i, "c", i * 10, i * 10 + 25) for i in range(40)], "id long, chrom string, start long, end long")
    cover = spark.createDataFrame([("c", 5 + i % 7, 200 - i % 5) for i in range(300)] + [("c", 300, 300), ("c", 310, 305), ("c", 320, 330)], "chrom string, start long, end long")
    found = intervals.uncovered_share(rows, cover, "id", ["chrom"], 64)
    plain = set(range(5, 200)) | set(range(320, 330))
    assert {r.id: r.uncovered for r in found.collect()} == {i: pytest.approx(1 - len(plain & set(range(i * 10, i * 10 + 25))) / 25) for i in range(40)}
    assert rows_of_joins(found, spark) < 300


def test_most_shared_is_that_of_all_pairs():
    rng = np.random.default_rng(7)
    for n in (1, 2, 5, 40, 257):
        s, ts = rng.integers(0, 300, 60), rng.integers(0, 300, n)
        e, te = s + rng.integers(1, 60, 60), ts + rng.integers(1, 60, n)
        order = rng.permutation(n)
        which, most = intervals.most_shared(s, e, ts, te, order)
        for i in range(60):
            shared = np.minimum(e[i], te) - np.maximum(s[i], ts)
            j = min(range(n), key=lambda j: (-shared[j], order[j]))
            assert most[i] == max(0, shared[j]) and (most[i] == 0 or which[i] == j)


def test_best_overlap_makes_no_pairs(spark):
    rows = spark.createDataFrame([(i, "c", i, i + 5 * (i % 9 > 0)) for i in range(60)] + [(99, "d", 1, 2), (98, None, 1, 2)], "id long, chrom string, start long, end long")
    painted = [("c", 10 + i % 7, 40 - i % 11, f"r{i}", 500 - i) for i in range(300)] + [("c", 45, 45, "x", 900), ("c", 50, 52, "y", 901)]
    found = intervals.best_overlap(rows, spark.createDataFrame(painted, "chrom string, start long, end long, ref string, ord long"), "id", ["chrom"], 16)
    want = {}
    for r in rows.collect():
        shared = [(max(r.start, s) - min(r.end, e), o, x) for c, s, e, x, o in painted if c == r.chrom]
        want[r.id] = min((q for q in shared if q[0] < 0), default=(0, 0, None))[2]
    assert {r.id: r.ref for r in found.collect() if want[r.id]} == {k: v for k, v in want.items() if v}
    assert found.count() == 62 and rows_of_joins(found, spark) < 1000


def test_a_split_is_not_one_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text, "PART", 10)
    (tmp_path / "a.txt").write_text("".join(f"{'h' if k % 37 == 0 else 'l'}{k}\n" for k in range(300)))
    head = F.col("line").startswith("h")
    found = text.counted(text.carried(text.lines(spark, str(tmp_path / "a.txt")), F.when(head, F.col("line")), "head"), head, "n")
    assert [(r.line[1:], r["head"], r.n) for r in found.orderBy("line_no").collect()] == [(str(k), f"h{k // 37 * 37}", k // 37 + 1) for k in range(300)]
    assert "_lines" in found._jdf.queryExecution().optimizedPlan().toString().split("Window", 1)[1].split("\n")[0]


def test_repeated_and_odd_tags(spark):
    line = "\t".join("q 9 0 9 + t 9 0 9 8 9 60".split() + ["de:f:0.1", "cs:Z::3*ac:2", "de:f:0.2", "x", ":a:b", "cg::9M", "ab:i:"])
    rows = spark.createDataFrame([("f", 0, i, x) for i, x in enumerate((line, line.replace("de:f:0.2", "df:f:0.2")))], "file string, split long, line_no long, line string")
    found = paf_of(rows).orderBy("line_no").collect()
    assert [(r.de, r.cs, r.cg) for r in found] == [(0.2, ":3*ac:2", None), (0.1, ":3*ac:2", None)]
    assert found[0].tags == {"de:f": "0.2", "cs:Z": ":3*ac:2", "ab:i": ""}
    # Tags are listed once, not anew for each key.
    assert paf_of(rows)._jdf.queryExecution().optimizedPlan().toString().count("split(lambda") == 1


def test_lines_of_rates_are_not_sorted_or_dealt(spark, tmp_path):
    for name, first in (("a", "Sequence\tKs"), ("b", "# none\nKs\tSequence")):
        (tmp_path / name).write_text(first + "\n" + "".join(f"{'p' if name == 'a' else k}\t{k if name == 'a' else 'p'}\n" for k in range(50)))
    found = tables.read_ks(spark, [str(tmp_path / x) for x in "ab"])
    assert sorted(r.ks for r in found.where("ks is not null").collect() if r.file.endswith("a")) == [float(k) for k in range(50)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan


def test_frames_are_repaired_a_few_at_a_time(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "MK", "ATG" + "a" * (i % 3) + "AAA") for i in range(200)] + [(200, "MW", "ATGAAA")], "id long, protein string, cds string").coalesce(1)
    plain = [codons.repaired("ATG" + "a" * k + "AAA", "MK") for k in range(3)]
    found = codons.repair_frames(rows).orderBy("id").collect()
    assert [(r.repair.fixed, [(x["at"], x.bases) for x in r.repair.out]) for r in found[:200]] == [plain[i % 3] for i in range(200)]
    assert found[200].repair.fixed is None and "amino acid 2" in found[200].repair.error
    assert "MapInArrow" in codons.repair_frames(rows)._jdf.queryExecution().executedPlan().toString()


def test_triage_of_short_blocks_takes_few_rounds(spark, monkeypatch):
    blocks = spark.createDataFrame([(i, "a", i * 700, i * 700 + 600 + i % 5, "b", i * 700, i * 700 + 40, "+") for i in range(400)], "id long, ca string, sa long, ea long, cb string, sb long, eb long, strand string")
    seen = []
    monkeypatch.setattr(scene, "FOLD_ROWS", 0)
    own = scene._first_about
    monkeypatch.setattr(scene, "_first_about", lambda *a: (seen.append(1), own(*a))[1])
    found = scene.triage(blocks, 4.0, 0.5)
    assert found.where("verdict = 'rescued'").count() == 400 and len(seen) <= 8


@pytest.mark.parametrize("longest", [40, 60_000])
def test_near_joins_are_dealt_and_bound_on_both_ends(spark, longest):
    rng = random.Random(31)
    rows = lambda n, most: [(k, rng.choice("ab"), s := rng.randrange(20_000), s + rng.choice([0, 1, most // 2, most])) for k in range(n)]
    a, b = rows(150, longest), rows(150, 60_000)
    schema = "id long, chrom string, start long, end long"
    left, right = spark.createDataFrame(a, schema), intervals.prefixed(spark.createDataFrame(b, schema))
    for found, reach in ((intervals.near_join(left, right, ["chrom"], 800), lambda y: 800), (intervals.near_join_by_share(left, right, ["chrom"], 0.9, 16), lambda y: 0.9 * (y[3] - y[2]))):
        want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and abs(x[2] - y[2]) <= reach(y) and abs(x[3] - y[3]) <= reach(y))
        assert sorted((r.id, r.r_id) for r in found.collect()) == want
        # Small tables too are dealt over bins, not sent whole to the one task of the other side.
        assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    starts = intervals._near_starts(left, right, F.lit(800)).count()
    assert (starts < 80) if longest == 40 else starts == 150
    assert intervals.near_join(left.limit(0), right, ["chrom"], 800).count() == 0


def test_edits_without_cuts():
    rng = random.Random(32)
    for n in (0, 1, 5, 90, 700):
        t = "".join(rng.choice("acgt") for _ in range(n))
        q = "".join(x if rng.random() > 0.2 else rng.choice(["", "a", "gg"]) for x in t)
        edits = lambda path: sum(k for op, k in path if op != "=")
        path, i, j = align.whole_path(t, q), 0, 0
        for op, k in path:
            assert op not in "=X" or all((a == b) == (op == "=") for a, b in zip(t[i : i + k], q[j : j + k], strict=True))
            i, j = i + k * (op != "I"), j + k * (op != "D")
        assert (i, j) == (len(t), len(q)) and edits(path) == align.fewest_edits(t, q) == edits(align.edit_path(t, q))


def test_cuts_at_chance_hits_are_taken_back(spark, tmp_path):
    """Documents of which some were cut at words that lie off the diagonal by chance."""
    found = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id in (730, 5163, 5808, 3963, 7921)")
    found.write.parquet(f"{tmp_path}/documents.parquet")
    rows = entry.queries()["aligned_segments"](spark, str(tmp_path)).collect()
    assert len(rows) == 5 and all(r.few for r in rows)


def test_slices_of_one_chunk_come_out_of_one_join(spark):
    seqs = spark.createDataFrame([(1, "acgtacgtac"), (2, "ttttgggg")], "seq_id long, seq string")
    rows = [(1, 0, 3), (1, 0, 3), (1, 4, 8), (2, 1, 2), (3, 0, 2), (1, None, 4), (2, 3, 3), (1, -1, 2), (1, 40, 42)]
    asked = spark.createDataFrame(rows, "seq_id long, start long, end long")
    found = fasta.slices(asked, seqs, size=4)
    assert sorted((r.seq_id, r.start or 0, r.seq or "") for r in found.collect()) == [(1, -1, ""), (1, 0, ""), (1, 0, "acg"), (1, 0, "acg"), (1, 4, "acgt"), (1, 40, ""), (2, 1, "t"), (2, 3, ""), (3, 0, "")]
    across = fasta.slices(spark.createDataFrame([(1, 2, 9), (2, 2, 100)], "seq_id long, start long, end long"), seqs, size=4)
    assert sorted(r.seq for r in across.collect()) == ["gtacgta", "ttgggg"]
    one = fasta.slices(asked.where("end <= 8 and start >= 0 and start < end and seq_id < 3"), seqs, size=4)
    assert rows_of_joins(one, spark) == 4


def test_difference_strings_are_counted_without_tokens(spark):
    want = {
        "=acg*ag=a+tt-ac": (4, 1, 2, 2, 2),
        ":2*ct:10+acg*ct:26-tt:9": (47, 2, 3, 2, 2),
        "::3": (3, 0, 0, 0, 0),
        "abc:3": (3, 0, 0, 0, 0),
        "++acg": (0, 0, 3, 0, 1),
        "-": (0, 0, 0, 0, 0),
        "*ag*": (0, 1, 0, 0, 0),
        "=acg:4": (7, 0, 0, 0, 0),
        ":=a": (1, 0, 0, 0, 0),
        ":x": (None, 0, 0, 0, 0),
        "-é-éé": (0, 0, 0, 3, 2),
        "": (0, 0, 0, 0, 0),
        None: (None,) * 5,
    }
    rows = spark.createDataFrame([(x,) for x in want], "cs string").select("cs", alignments.cs_counts(F.col("cs")).alias("c"), alignments.gap_compressed_divergence(F.col("cs")).alias("de"))
    for r in rows.collect():
        same, edits, gaps = r.c.matches, r.c.mismatches, r.c.gaps
        assert tuple(r.c) == want[r.cs]
        assert r.de == (None if same is None or not same + edits + gaps else (edits + gaps) / (same + edits + gaps))
    # Each token pass is two regular expressions and several passes over an array; seven of them were made for a row.
    plan = entry.queries()["gap_compressed_divergence"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan


def test_stretches_are_told_by_sums_of_pieces(spark, monkeypatch):
    rng = random.Random(33)
    rows = [(rng.choice(["a", "b", None]), s := rng.randrange(400) * rng.choice([1, 900]), s + rng.choice([0, 5, 3000])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, s long, e long")
    found = intervals.in_stretches(df, ["k"], "s", "e", 2000)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct" not in plan and "_piece" in plan
    found = sorted(map(str, found.collect()))
    monkeypatch.setattr(intervals, "LEAST_PIECE", 1 << 30)
    assert found == sorted(map(str, intervals.in_stretches(df, ["k"], "s", "e", 2000).collect())) and len({x[-3:] for x in found}) > 2


def test_rows_of_folds_are_plain_values():
    columns = [pa.array(x, t) for x, t in (([1, 2], "int64"), ([1, None], "int64"), (["a", "é"], "string"), ([None, "b"], "string"), ([True, False], "bool"), ([0.5, float("inf")], "float64"), ([[1], None], pa.list_(pa.int64())))]
    found = list(groups._rows([pa.RecordBatch.from_arrays(columns, names=list("abcdefg"))]))
    assert found == [(1, 1, "a", None, True, 0.5, [1]), (2, None, "é", "b", False, float("inf"), None)]
    assert [type(x) for x in found[0]] == [int, int, str, type(None), bool, float, list]


def test_runs_are_found_in_more_tasks_than_a_shuffle_has(spark):
    plan = entry.queries()["covering_tiles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert f"{chains.SPREAD * 4}), REPARTITION_BY_NUM" in plan
    rows = [("a", 0, 5, 0, 5, "+"), ("a", 6, 9, 7, 9, "+"), ("a", 20, 25, 900, 950, "-"), ("b", 1, 2, 3, 4, "-"), (None, 1, 2, 3, 4, "+")]
    found = chains.collinear_runs(spark.createDataFrame(rows, "k string, t_start long, t_end long, q_start long, q_end long, strand string"), ["k"])
    assert sorted((r.k or "", r.run, r.strand, r.t_start, r.t_end, r.n_anchors) for r in found.collect()) == [("", 1, "+", 1, 2, 1), ("a", 1, "+", 0, 9, 2), ("a", 2, "-", 20, 25, 1), ("b", 1, "-", 1, 2, 1)]
