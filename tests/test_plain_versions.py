"""Queries that SQL does not express, on their own rows against plain versions."""

import pytest

from genoframe.plans import registry
from genoframe.plans.divergence import _matrix
from genoframe.plans.structure import _skewed_blocks
from genoframe.plans.views import view
from genoframe.operators import trees
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SPANS = ("t_start", "t_end", "q_start", "q_end")


def coords(spark):
    return [r.asDict() for r in view(spark, SF, "v_coords").collect()]


def by_keys(rows, *keys):
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    return groups.values()


def plain_clean(rows):
    """Without records that lie in another on both axes; of equal ones the first stays."""
    out = []
    for a in rows:
        inside = [b for b in rows if b is not a and b["t_start"] <= a["t_start"] and a["t_end"] <= b["t_end"] and b["q_start"] <= a["q_start"] and a["q_end"] <= b["q_end"] and a["t_start"] <= a["t_end"] and a["q_start"] <= a["q_end"]]
        if not any(any(a[s] != b[s] for s in SPANS) or b["rid"] < a["rid"] for b in inside):
            out.append(a)
    return out


def plain_trim(rows):
    rows = sorted((dict(r) for r in rows), key=lambda r: (r["t_start"], r["q_start"], r["t_end"], r["q_end"], r["block"], r["rid"]))
    for a in rows:
        hit = [b for b in rows if a["t_start"] < b["t_start"] < a["t_end"] < b["t_end"] and a["q_start"] < b["q_start"] < a["q_end"] < b["q_end"]]
        for b in hit:
            b["t_start"], b["q_start"] = a["t_end"], a["q_end"]
    return rows


def test_polished_intervals(spark):
    distinct = {}
    for r in coords(spark):
        key = tuple(v for k, v in r.items() if k != "rid")
        if key not in distinct or r["rid"] < distinct[key]["rid"]:
            distinct[key] = r
    want = []
    for group in by_keys(distinct.values(), "t", "q", "strand"):
        want += plain_trim(plain_clean(plain_trim(plain_clean(group))))
    found = registry.queries()["polished_intervals"](spark, SF).collect()
    show = lambda r: tuple(str(r[k]) for k in ("rid", "t", "q", "strand", "block", *SPANS))
    assert sorted(show(r) for r in found) == sorted(show(r) for r in want) and len(want) > 100


def test_merged_intervals(spark):
    want = []
    for group in by_keys(coords(spark), "t", "q", "strand", "block"):
        todo = sorted([r["t_start"], r["q_start"], r["t_end"], r["q_end"]] for r in group)
        while todo:
            a = todo.pop(0)
            short = a[2] - a[0] < 15_000 or a[3] - a[1] < 15_000
            hit = next((k for k, b in enumerate(todo) if a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]), None) if short else None
            if hit is None:
                want.append((group[0]["t"], group[0]["q"], group[0]["strand"], group[0]["block"], *a, "fail" if short else "pass"))
            else:
                b = todo[hit]
                todo[hit] = [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])]
    found = registry.queries()["merged_intervals"](spark, SF).collect()
    assert sorted((r.t, r.q, r.strand, r.block, r.t_start, r.q_start, r.t_end, r.q_end, r.status) for r in found) == sorted(want)
    assert len(want) <= len(coords(spark))


def test_triaged_blocks(spark):
    rows = [r.asDict() for r in _skewed_blocks(spark, SF).collect()]
    cover, want, skewed, novelty = {}, {}, [], {}
    for r in rows:
        low, high = sorted((r["ea"] - r["sa"], r["eb"] - r["sb"]))
        r["ratio"] = high / low if low > 0 else float("inf")
        if r["ratio"] > 4:
            skewed.append(r)
        else:
            want[r["id"]] = "clean"
            cover.setdefault(("a", r["ca"]), set()).update(range(r["sa"], r["ea"]))
            cover.setdefault(("b", r["cb"]), set()).update(range(r["sb"], r["eb"]))
    for r in sorted(skewed, key=lambda r: (r["ratio"], r["id"])):
        up, down = cover.setdefault(("a", r["ca"]), set()), cover.setdefault(("b", r["cb"]), set())
        a, b = range(r["sa"], r["ea"]), range(r["sb"], r["eb"])
        bare = min(1 - sum(p in up for p in a) / len(a) if a else 0, 1 - sum(p in down for p in b) / len(b) if b else 0)
        want[r["id"]] = "rescued" if bare >= 0.5 else "dropped"
        novelty[r["id"]] = bare
        if bare >= 0.5:
            up.update(a)
            down.update(b)
    found = registry.queries()["triaged_blocks"](spark, SF).collect()
    assert {r.id: r.verdict for r in found} == want and len(found) == len(rows) and set(want.values()) == {"clean", "rescued", "dropped"}
    assert {r.id: r.novelty for r in found if r.novelty is not None} == pytest.approx(novelty)


@pytest.mark.parametrize("method", ["upgma", "nj"])
def test_trees_keep_distances(spark, method):
    """Leaves of an average-linkage tree meet at half their clusters' mean distance; joined neighbours keep theirs."""
    cells = {(r.i, r.j): r.d for r in _matrix(spark, SF).collect()}
    tree = registry.queries()["average_linkage_tree" if method == "upgma" else "neighbour_joining_tree"](spark, SF).collect()[0].tree
    paths, at, depth, stack = {}, 0, {}, []

    def parsed(text):
        nonlocal at
        if text[at] == "(":
            at += 1
            found = []
            while True:
                own = parsed(text)
                length = 0.0
                if text[at] == ":":
                    end = min(k for k in (text.find(",", at), text.find(")", at)) if k >= 0)
                    length, at = float(text[at + 1 : end]), end
                found.append({n: d + length for n, d in own.items()})
                at += 1
                if text[at - 1] == ")":
                    break
            for i, x in enumerate(found):
                for y in found[i + 1 :]:
                    paths.update({(a, b): da + db for a, da in x.items() for b, db in y.items()})
            return {n: d for x in found for n, d in x.items()}
        end = min(k for k in (text.find(c, at) for c in ":,)") if k >= 0)
        name, at = text[at:end], end
        return {name: 0.0}

    leaves = parsed(tree)
    names = {i for i, _ in cells}
    assert set(leaves) == names
    nearest = min((d, i, j) for (i, j), d in cells.items() if i < j)
    if method == "upgma":
        assert max(leaves.values()) - min(leaves.values()) < 1e-5
        got = paths.get(nearest[1:]) or paths.get(nearest[:0:-1])
        assert abs(got - nearest[0]) < 1e-5
    else:
        # Four leaves: the two pairs that join keep their own distances.
        kept = [abs((paths.get(p) if p in paths else paths[p[::-1]]) - cells[p]) < 1e-5 for p in cells if p[0] < p[1]]
        assert sum(kept) >= 2


def test_time_tree(spark):
    from genoframe.plans.registry import queries

    years = trees.in_years(_matrix(spark, SF), 6.5e-9)
    assert queries()["time_tree"](spark, SF).collect()[0].tree == trees.newick(years).collect()[0].tree
    assert {(r.i, r.j): r.d for r in years.collect()} == {(r.i, r.j): float(round(r.d / 6.5e-9)) for r in _matrix(spark, SF).collect()}
