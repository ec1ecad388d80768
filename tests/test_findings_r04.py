"""Small cases of what the review of round 4 found."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from genoframe.functions import align, wavefront
from genoframe.functions import alignments as A
from genoframe.functions.bands import Costs
from genoframe.operators import seeds


@pytest.fixture
def compared(spark, tmp_path):
    """Rows of a query over tables made by SQL, and those of its own SQL."""

    def run(name, **tables):
        con = duckdb.connect()
        for table, sql in tables.items():
            con.execute(f"copy ({sql}) to '{tmp_path}/{table}.parquet' (format parquet)")
            con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
        df = entry.queries()[name](spark, str(tmp_path))
        found = con.execute(entry.oracle_sql()[name])
        columns = [d[0] for d in found.description]
        return sorted(map(tuple, df.select(*columns).collect()), key=str), sorted(found.fetchall(), key=str)

    return run


def test_chromosome_names_beyond_two_letters(compared):
    own, sql = compared("chromosome_names", supplier="select i as s_suppkey from range(1, 36401) t(i)")
    assert len(own) == 36400 and own == sql
    assert any(r[3] and ord(r[3][0]) > 255 for r in own)


def changed(rng, t, rate, longest):
    out = []
    for x in t:
        r = rng.random()
        out.append(rng.choice("acgt") if r < rate else "" if r < 1.3 * rate else x + "".join(rng.choices("acgt", k=rng.randrange(1, longest))) if r < 1.6 * rate else x)
    return "".join(out)


def spelled(path, t, q):
    i = j = 0
    for op, n in path:
        if op in "=X":
            assert all((a == b) == (op == "=") for a, b in zip(t[i : i + n], q[j : j + n], strict=True))
        i, j = i + n * (op != "I"), j + n * (op != "D")
    assert (i, j) == (len(t), len(q))


@pytest.mark.parametrize("columns", [1 << 25, 1 << 13])
def test_pairs_of_any_length_by_fewest_edits_without_fronts(monkeypatch, columns):
    """Bands that are too narrow at first, halved pairs, unlike and equal ones; no pair by fronts one by one."""
    monkeypatch.setattr(align, "COLUMNS", columns)
    monkeypatch.setattr(align, "_middle", None)
    rng, pairs = random.Random(1), [("", "a"), ("a", ""), ("a", "c"), ("ac" * 700, "a" * 900), ("a" * 1500, "ac" * 750)]
    for n in (1, 60, 400, 1100, 2500):
        t = "".join(rng.choices("acgt", k=n))
        pairs += [(t, t), (t, changed(rng, t, 0.1, 4)), (t, changed(rng, t, 0.5, 30)), (t, "".join(rng.choices("acgt", k=n // 2 + 1))), (t, t[: n // 3] + t[2 * n // 3 :]), (t[: n // 2], t)]
    for (t, q), path in zip(pairs, align.edit_paths(pairs), strict=True):
        spelled(path, t, q)
        assert sum(n for op, n in path if op != "=") == align.fewest_edits(t, q)


def test_long_pairs_are_cut_and_others_not_dealt(spark, monkeypatch):
    monkeypatch.setattr(align, "WHOLE", 1000)
    rng = random.Random(2)
    texts = {i: "".join(rng.choices("acgt", k=n)) for i, n in enumerate((30, 999, 1001, 4000))}
    rows = [(i, t, t[:20] + "a" + t[20:], f"k{i}") for i, t in texts.items()]
    found = align.align_by_tiles(spark.createDataFrame([*rows, (9, "", "a", "k9"), (8, None, "a", "k8")], "id int, target string, query string, kept string"), "id", long=True, keep=("kept",))
    got = {r.id: r for r in found.select("*", A.target_of(F.col("cs")).alias("t"), A.query_of(F.col("cs")).alias("q")).collect()}
    assert {i: (r.t, r.q, r.edits, r.kept) for i, r in got.items()} == {i: (t, q, 1, k) for i, t, q, k in rows}


@pytest.mark.parametrize("costs", [Costs(), Costs(4, 6, 2, 24, 1), Costs(1, 0, 1, 0, 1)])
def test_short_pairs_of_some_cost_by_tables(monkeypatch, costs):
    """Same least cost as by fronts alone, which are left at a small cost; one by one the same paths."""
    rng, pairs, seen = random.Random(3), [], []
    for n in (0, 1, 50, 250):
        t = "".join(rng.choices("acgt", k=n))
        pairs += [(t, t), (t, changed(rng, t, 0.1, 4)), (t, changed(rng, t, 0.2, 120)), (t, "".join(rng.choices("acgt", k=n // 2 + 1)))]
    fronts = [wavefront.affine_path(t, q, costs, traced=wavefront.TRACED)[0] for t, q in pairs]
    own = wavefront._Together.step
    monkeypatch.setattr(wavefront._Together, "step", lambda self, cost: seen.append(cost) or own(self, cost))
    found = wavefront.affine_paths(pairs, costs)
    assert max(seen) <= wavefront.DENSE < max(fronts)
    for (t, q), (cost, path), least in zip(pairs, found, fronts, strict=True):
        spelled(path, t, q)
        assert cost == least == wavefront.cost_of(path, costs)
    assert found == [wavefront.affine_path(t, q, costs) for t, q in pairs]
    assert [f and f[0] for f in wavefront.affine_paths(pairs, costs, 90)] == [c if c <= 90 else None for c in fronts]


def test_shared_words_by_numbers():
    rng = random.Random(4)
    t = "".join(rng.choices("acgt", k=900))
    q = changed(rng, t + t[:100] + "é" * 30, 0.05, 5)
    for size in (1, 5, 12, 20, 32):
        once = align._once(q, size)
        assert align._shared(t, q, size) == [(i, once[w]) for w, i in align._once(t, size).items() if w in once]


def test_anchors_of_pairs_whole_and_by_chunks(spark, monkeypatch):
    """The same anchors where a pair is worked on whole, which deals no minimizers, as by chunks and joins."""
    rng = random.Random(5)
    t = "".join(rng.choices("ACGT", k=3000))
    turned = t[1000:2000][::-1].translate(str.maketrans("ACGT", "TGCA"))
    q = changed(rng, t[:1000], 0.02, 3).upper() + turned + t[2000:] + t[:300] * 70 + "NN" + t[:50].lower()
    rows = spark.createDataFrame([("a", t, q), ("b", t, t), ("c", t[:20], q), ("d", "", t), ("e", q, t)], "pair string, target string, query string")
    whole = sorted(map(tuple, seeds.anchors_of_pairs(rows).collect()))
    monkeypatch.setattr(seeds, "ALONE", 0)
    assert whole == sorted(map(tuple, seeds.anchors_of_pairs(rows).collect()))
    minis = lambda x: seeds.minimizers(seeds.overlapping(rows.select(F.col("pair").alias("seq_id"), F.col(x).alias("seq"))), most=seeds.MOST).withColumn("pair", F.col("seq_id"))
    assert whole == sorted(map(tuple, seeds.anchors(seeds.seeds(minis("target"), minis("query"), keys=("pair",)), keys=("pair",), long=False).drop("t", "q").collect()))
    assert {r[1] for r in whole} == {"+", "-"}


def test_sides_of_many_pairs_are_dealt(spark, compared):
    """No side is sent whole to the few tasks of the other."""
    own, sql = compared("interval_overlap", events="select i as event_id, i % 50 as user_id, 'x' as event_type from range(300) t(i)", orders="select i as o_orderkey, i % 40 as o_custkey, 'F' as o_orderstatus from range(300) t(i)")
    assert own == sql and own
    plan = entry.queries()["interval_overlap"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
