"""Substitution rates against a plain count, and scaffold numbers."""

import math
import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from genoframe.functions.codons import CODE
from genoframe.operators import kaks
from genoframe.operators.groups import numbered_by_range


def plain(one, two):
    """Counts codon by codon, with every order of the three places."""
    sites = diffs = others = n = 0
    for i in range(0, min(len(one), len(two)) - 2, 3):
        a, b = one[i : i + 3], two[i : i + 3]
        if CODE.get(a, "*") == "*" or CODE.get(b, "*") == "*":
            continue
        n += 1
        for c in (a, b):
            for p in range(3):
                sites += sum(CODE[c[:p] + x + c[p + 1 :]] == CODE[c] for x in "ACGT" if x != c[p]) / 6
        paths = []
        for order in permutations(range(3)):
            walk = [a]
            for p in order:
                walk.append(walk[-1][:p] + b[p] + walk[-1][p + 1 :])
            same = sum(x != y and CODE[x] == CODE[y] for x, y in zip(walk, walk[1:]))
            moves = sum(x != y for x, y in zip(walk, walk[1:]))
            paths.append((any(CODE[x] == "*" for x in walk), same, moves - same))
        paths = [p for p in paths if not p[0]] or paths
        diffs += sum(p[1] for p in paths) / len(paths)
        others += sum(p[2] for p in paths) / len(paths)
    rate = lambda d, s: -0.75 * math.log(1 - 4 * d / s / 3) if s and d / s < 0.75 else None
    return n, sites, diffs, others, rate(others, 3 * n - sites), rate(diffs, sites)


def test_rates(spark):
    rng = random.Random(3)
    cds = lambda n: "".join(rng.choice(kaks.SENSE) for _ in range(n))
    change = lambda s, rate: "".join(rng.choice("ACGT") if rng.random() < rate else x for x in s)
    rows = [(k, s, change(s, rate)) for k, rate in enumerate((0.0, 0.02, 0.05, 0.1)) for s in [cds(300)]]
    rows += [(10, "ATGTTTN", "ATGTTCA"), (11, "ATGNNNTAATTT", "ATGACGTAATTT"), (12, None, "ATG"), (13, "", ""), (14, "AT", "ATG"), (15, "auguuu", "ATGTTC")]
    found = {r.id: r for r in kaks.ka_ks(spark.createDataFrame(rows, "id int, x string, y string"), "id", "x", "y").collect()}
    assert set(found) == {r[0] for r in rows}
    for k, x, y in rows:
        want = plain((x or "").upper().replace("U", "T"), (y or "").upper())
        got = found[k]
        assert (got.codons, got.s_sites, got.s_diffs, got.n_diffs) == pytest.approx(want[:4])
        assert (got.ka, got.ks) == (pytest.approx(want[4]) if want[4] is not None else None, pytest.approx(want[5]) if want[5] is not None else None)


def test_gaps_keep_codons_in_register(spark):
    rng = random.Random(4)
    s = "".join(rng.choice(kaks.SENSE) for _ in range(200))
    longer = s[:300] + "".join(rng.choice(kaks.SENSE) for _ in range(8)) + s[300:]
    (r,) = kaks.ka_ks(spark.createDataFrame([(1, s, longer)], "id int, x string, y string"), "id", "x", "y").collect()
    assert (r.codons, r.ka, r.ks) == (200, 0.0, 0.0)


def test_codon_table():
    assert kaks.synonymous_sites("TTT") == pytest.approx(1 / 3) and kaks.synonymous_sites("ATG") == 0 and kaks.synonymous_sites("GGG") == 1
    assert kaks.differences("TTT", "TTC") == (1, 0) and kaks.differences("TTT", "GTA") == (0.5, 1.5)


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_numbered_by_range(spark, n):
    rows = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("length"), F.col("id").alias("ord")).repartition(5)
    found = numbered_by_range(rows, [F.desc("length"), F.asc("ord")], "number").collect()
    assert [r.number for r in sorted(found, key=lambda r: (-r.length, r.ord))] == list(range(1, n + 1))
