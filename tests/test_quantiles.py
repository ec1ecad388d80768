"""Quantiles by rounds against sorting."""

import random

import pytest

from genoframe.operators import quantiles


@pytest.mark.parametrize(("left", "ranges", "share"), [(1 << 17, 1024, 0.5), (40, 16, 0.995), (20, 64, 0.5), (1, 1024, 1.0)])
def test_quantile(spark, monkeypatch, left, ranges, share):
    monkeypatch.setattr(quantiles, "LEFT", left)
    monkeypatch.setattr(quantiles, "RANGES", ranges)
    rng = random.Random(5)
    groups = {
        "even": [rng.random() for _ in range(300)], "ties": [float(rng.randrange(3)) for _ in range(200)], "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300) for _ in range(150)],
        "same": [2.5] * 100, "one": [7.0], "two": [1.0, 2.0], None: [rng.gauss(0, 1) for _ in range(120)],
    }
    rows = [(k, v) for k, own in groups.items() for v in own] + [("even", None), ("even", float("nan")), ("bare", None)]
    rng.shuffle(rows)
    found = {r.k: r.q for r in quantiles.quantile(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", share).collect()}
    for k, own in groups.items():
        own = sorted(own)
        place = share * (len(own) - 1)
        a, b = own[int(place)], own[min(int(place) + 1, len(own) - 1)]
        assert found[k] == pytest.approx(a + (place - int(place)) * (b - a), rel=1e-12)
    assert set(found) == set(groups)
