"""Whitening and centroids against plain versions with Python's fractions and integers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from genoframe.llm import centroids, exact, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, dim int, x string, cluster string, component int"
ODD = [
    (900, None), (901, []), (902, [1.0, None, 2.0]), (903, [float("nan"), 1.0, 0.0]), (904, [1.0, float("inf"), 0.0]), (None, [0.5, 0.25, -0.5]),
]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7, 8, "x", "c", 2) for i, v in rows], SCHEMA)


def floors(vector, scale):
    return tuple(math.floor(scale * float(np.float32(c))) for c in vector)


def vectors(n, dim, seed=3, spread=1.0):
    rng = random.Random(seed)
    return [[float(np.float32(rng.gauss(c % 3, spread * (1 + c)))) for c in range(dim)] for _ in range(n)]


def plain_whitening(rows, k):
    """(n, sums, covariance as fractions) of the distinct vectors."""
    fit = sorted(set(rows))
    n, dim = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(dim)]
    cov = [[Fraction(sum((n * v[i] - sums[i]) * (n * v[j] - sums[j]) for v in fit), n**3) for j in range(dim)] for i in range(dim)]
    return fit, n, sums, cov


def test_whitening(spark):
    own = vectors(40, 5)
    rows = [(i, v) for i, v in enumerate(own)] + [(100, own[0]), (101, own[0]), (7, own[7])]
    found = whitening.whitened(table(spark, rows + ODD[:2] + [(902, [1.0, None, 2.0, 0.0, 0.0]), (903, [math.nan] * 5), (904, [math.inf] * 5)])).collect()
    whole = {i: floors(v, 256) for i, v in rows}
    fit, n, sums, cov = plain_whitening(list(whole.values()), 4)
    values, parts = np.linalg.eigh(np.array([[float(c) for c in r] for r in cov]))
    values, parts = values[::-1], parts[:, ::-1]
    assert len(found) == 4 * len(rows) and {r.n for r in found} == {n} == {40}
    by = {}
    for r in found:
        x = whole[r.vec_id]
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert r.explained == pytest.approx(values[r.component - 1] / float(sum(cov[i][i] for i in range(5))), rel=1e-9)
        want = sum((a - s / n) * p for a, s, p in zip(x, sums, parts[:, r.component - 1])) / math.sqrt(values[r.component - 1])
        assert abs(r.whitened) == pytest.approx(abs(want), abs=1e-9)
        assert by.setdefault((r.component, x), r.whitened) == r.whitened
        assert 0 <= r.identity_error < 1e-9
    w = np.array([[by[c, x] for c in (1, 2, 3, 4)] for x in fit])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-9


def test_whitening_of_odd_rows(spark):
    rows = ODD + [(i, [1.0, 2.0]) for i in range(3)] + [(9, [4.0]), (9, [5.0]), (10, [4.0])]
    found = whitening.whitened(table(spark, rows)).collect()
    of = lambda i: sorted((r for r in found if r.vec_id == i), key=lambda r: (r.component, r.deviation))
    assert {r.vec_id for r in found} == {None, 0, 1, 2, 9, 10}
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in of(0)] == [(1, 1, 0, None, None, 0.0), (2, 1, 0, None, None, 0.0)]
    assert [(r.n, r.deviation, abs(r.whitened), r.explained) for r in of(9)] == [(2, 256**2, 1.0, 1.0)] * 2
    assert len(of(None)) == 3
    assert whitening.whitened(table(spark, ODD[:5])).count() == 0
    assert whitening.whitened(table(spark, [])).count() == 0
    assert "vec_id" in whitening.whitened(table(spark, ODD)).columns


def test_whitening_of_flat_and_huge_vectors(spark):
    # Two directions of variance in four components; the others are exactly without.
    rows = [(i, [float(i % 5), float(i % 3), float(i % 5), 7.0]) for i in range(15)]
    found = whitening.whitened(table(spark, rows)).collect()
    assert all((r.whitened is None) == (r.component > 2) and (r.explained == 0.0) == (r.component > 2) for r in found)
    huge = [(0, [1e30, -3e38]), (1, [-1e30, 3e38]), (2, [5.0, 1e16])]
    found = whitening.whitened(table(spark, huge)).collect()
    top, low = 2**63 - 1, -(2**63)
    whole = {0: (top, low), 1: (low, top), 2: (1280, int(np.float32(1e16)) * 256)}
    _, n, sums, cov = plain_whitening(list(whole.values()), 4)
    assert all(r.deviation is None and r.identity_error < 1e-9 and math.isfinite(r.whitened) for r in found)
    trace = float(cov[0][0] + cov[1][1])
    assert sum(r.explained for r in found if r.vec_id == 0) == pytest.approx(1.0) and trace > 1e36
    with pytest.raises(Exception):
        whitening.whitened(table(spark, [(0, [1.0] * (whitening.MOST_DIM + 1))]))


@pytest.mark.parametrize("bits", [3, 17, 18, 40, 62])
def test_scatter_is_exact(bits, monkeypatch):
    monkeypatch.setattr(exact, "BLOCK_ROWS", 7)
    rng = random.Random(bits)
    x = np.array([[rng.randrange(-(2**bits), 2**bits) for _ in range(3)] for _ in range(50)], np.int64)
    for shift in ([0, 0, 0], x[4].tolist()):
        own = exact.Scatter(shift)
        own.add(x[:20])
        own.add(x[20:])
        y = [[int(a) - s for a, s in zip(r, shift)] for r in x]
        want = {(i, -1): sum(r[i] for r in y) for i in range(3)} | {(i, j): sum(r[i] * r[j] for r in y) for i in range(3) for j in range(i, 3)}
        assert {(i, j): v for i, j, v in own.totals()} == want and own.n == 50
        for v in want.values():
            assert sum(limb << (exact.LIMB * place) for place, limb in exact.limbs(v)) == v


def plain_clusters(rows, k, rounds, seed="3"):
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]) if r[0] is not None else ("~", r[1]))
    now = [list(x) for _, x in order[:k]]
    off = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    nearest = lambda x: min((off(x, c), j) for j, c in enumerate(now))
    for _ in range(rounds):
        mine = [[x for _, x in rows if nearest(x)[1] == j] for j in range(len(now))]
        now = [[sum(v[i] for v in m) // len(m) for i in range(len(c))] if m else c for m, c in zip(mine, now)]
    found = [(i, *reversed(nearest(x))) for i, x in rows]
    inertia = {j: sum(d for _, c, d in found if c == j) for j in range(len(now))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return [(i, c, d, inertia[c], sum(inertia.values()), digests[c]) for i, c, d in found]


@pytest.mark.parametrize(("spread", "scale"), [(1.0, 1024), (0.002, 1024), (1e6, 4)])
def test_clusters(spark, spread, scale):
    own = [[c * spread for c in v] for v in vectors(70, 3)] + [[spread, 2 * spread, -spread]] * 9
    rows = [(i * 3, v) for i, v in enumerate(own)] + [(6, own[0]), (None, own[1])]
    found = centroids.clusters(table(spark, rows + ODD[:5]), k=5, rounds=4, dim=3, scale=scale).collect()
    want = plain_clusters([(i, floors(v, scale)) for i, v in rows], 5, 4)
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, found)) == sorted(map(key, want))


def test_clusters_of_few_and_odd_rows(spark):
    assert centroids.clusters(table(spark, []), dim=3).count() == 0
    assert centroids.clusters(table(spark, ODD[:5]), dim=3).count() == 0
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [0.0, 0.0, 0.0])]
    found = [tuple(r) for r in centroids.clusters(table(spark, rows + [(5, [1.0, 2.0])]), dim=3).collect()]
    assert sorted(found) == sorted(plain_clusters([(i, floors(v, 1024)) for i, v in rows], 8, 10))
    huge = [(1, [3e38, 0.0, 0.0]), (2, [-3e38, 0.0, 0.0]), (3, [2e38, 1.0, 0.0])]
    found = {r.vec_id: r for r in centroids.clusters(table(spark, huge), k=2, rounds=2, dim=3).collect()}
    assert found[1].cluster == found[3].cluster != found[2].cluster and found[1].distance == found[3].distance == 512**2


def test_screening_is_never_wrong():
    rng = np.random.default_rng(5)
    for size in (3, 1000, 10**7, 10**13):
        base = rng.integers(-size, size + 1, (6, 64))
        own = centroids.Centroids([list(map(int, c)) for c in base])
        # Half-way points are ties, or nearly so.
        pairs = rng.integers(0, 6, (300, 2))
        x = (base[pairs[:, 0]] + base[pairs[:, 1]]) // 2 + rng.integers(-1, 2, (300, 64))
        x = np.concatenate([x, base, rng.integers(-size, size + 1, (50, 64))])
        low, high = own.intervals(x)
        for r in range(0, len(x), 7):
            for c in range(6):
                score = sum(int(v) ** 2 for v in base[c]) - 2 * sum(int(a) * int(b) for a, b in zip(x[r], base[c]))
                assert low[r, c] <= score <= high[r, c]
        number, again = own.nearest(x)
        want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(row, c)), j) for j, c in enumerate(base))[1] for row in x]
        assert number.tolist() == want and 0 < again < len(x)
