"""Peaks against a plain search, sample by sample."""

import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import peaks


def plain(x, distance=1, prominence=None):
    found, i = [], 1
    while i < len(x) - 1:
        j = i
        while j + 1 < len(x) and x[j + 1] == x[i]:
            j += 1
        if x[i - 1] < x[i] and j + 1 < len(x) and x[j + 1] < x[i]:
            found.append((i + j) // 2)
        i = j + 1
    kept = []
    for p in sorted(found, key=lambda p: (-x[p], -p)):
        if all(abs(p - k) >= distance for k in kept):
            kept.append(p)
    out = []
    for p in sorted(kept):
        a = b = p
        while a > 0 and x[a - 1] <= x[p]:
            a -= 1
        while b + 1 < len(x) and x[b + 1] <= x[p]:
            b += 1
        if prominence is None or x[p] - max(min(x[a : p + 1]), min(x[p : b + 1])) >= prominence:
            out.append(p)
    return out


WAVES = [
    [0, 2, 0, 3, 3, 0, 1, 0],
    [0, 2, 1, 3, 0, 0],
    [5, 4, 4, 6, 6, 6, 7, 7],
    [0, 1, 0, 2, 0, 3, 0, 4, 0, 5, 0],  # a chain of rising peaks
    [0, 5, 0, 4, 0, 3, 0, 2, 0, 1, 0],
    [0, 3, 0, 3, 0, 3, 0, 3, 0],
    [1],
    [1, 1, 1, 1],
    [0, 9, 9, 9, 9, 0, 9, 0],
]


@pytest.mark.parametrize("distance,prominence", [(1, None), (3, None), (10, None), (1, 2.0), (3, 1.0), (4, 3.0)])
def test_peaks(spark, distance, prominence):
    rng = random.Random(distance)
    waves = WAVES + [[rng.randint(0, 6) for _ in range(rng.randint(0, 60))] for _ in range(80)]
    rows = [(k, 10 * i + 5, float(v)) for k, w in enumerate(waves) for i, v in enumerate(w)] + [(0, 1, None), (3, 17, None)]
    df = spark.createDataFrame(rows, "k int, t int, v double").repartition(3)
    got = {}
    for r in peaks.peaks(df, ["k"], "t", "v", distance, None if prominence is None else F.lit(prominence)).collect():
        got.setdefault(r.k, []).append(r.at)
        assert waves[r.k][r.at] == r.height
    for k, w in enumerate(waves):
        assert sorted(got.get(k, [])) == plain(w, distance, prominence), (w, got.get(k))


def test_pulse_features(spark):
    import numpy as np

    x = [80.0 + v for v in ([0, 10, 30, 20, 15, 18, 12, 6, 4, 2, 1, 0] * 4)]
    rows = [("a", i, v) for i, v in enumerate(x)] + [("b", i, 70.0) for i in range(30)] + [("c", 0, 1.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = {r.k: r for r in peaks.pulse_features(df, ["k"], "t", "v").collect()}
    a = got["a"]
    assert (a.highest, a.lowest, a.pulse, a.max_rise, a.n_beats, a.interval, a.interval_spread, a.notch_share) == (110, 80, 30, 20, 4, 12, 0, 1)
    assert a.area == pytest.approx(float(np.trapezoid(np.array(x) - 80)))
    assert (got["b"].n_beats, got["b"].pulse, got["b"].highest) == (0, 0, 70)
    assert got["c"].highest == got["c"].area == 0
