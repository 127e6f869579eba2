"""Detectors on a recording in many stretches against the same ones on the whole recording."""

import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import scans
from pulsegrid.operators import timeseries as T

SIZE = 17


@pytest.fixture(scope="module")
def recording(spark):
    """Two series of over 50 stretches with runs, gaps, repeats and nulls, one short one, one with a null key."""
    rng = random.Random(7)
    rows = []
    for key, n in (("a", 900), ("b", 870), ("c", 3), (None, 40)):
        t, v = 0, 100.0
        for _ in range(n):
            t += rng.choice([1, 1, 1, 1, 1, 40])
            kind = rng.random()
            if kind < 0.4:
                v = float(rng.randint(60, 140))
            if key == "b" and 200 < t < 1200:
                v = 77.0
            gone = (key == "a" and 300 < t < 900) or rng.random() < 0.05
            rows.append((key, t, None if gone else v, rng.random() < 0.02))
    df = spark.createDataFrame(rows, "k string, t long, v double, flag boolean").withColumn("ts", F.timestamp_seconds("t"))
    return df.repartition(5).cache()


def same(one, two):
    columns = sorted(one.columns)
    assert columns == sorted(two.columns)
    assert sorted(map(str, one.select(*columns).collect())) == sorted(map(str, two.select(*columns).collect()))


K = ["k"]
CASES = {
    "flatline": lambda d, size: T.flatline(d, K, "ts", "v", 6, size=size),
    "mad_score": lambda d, size: T.mad_score(d, K, "ts", "v", 7, size=size),
    "spikes": lambda d, size: T.spikes(d, K, "ts", "v", 9, 2.0, size=size),
    "robust_smooth": lambda d, size: T.robust_smooth(d, K, "ts", "v", 5, size=size),
    "counter": lambda d, size: T.counter(d, K, "ts", "v", size=size),
    "step_rule": lambda d, size: T.step_rule(d, K, "ts", "v", 20.0, size=size),
    "ratio_rule": lambda d, size: T.ratio_rule(d, K, "ts", "v", 8, 1.2, 0.8, size=size),
    "drop_rule": lambda d, size: T.drop_rule(d, K, "ts", "v", 4, size=size),
    "expand": lambda d, size: T.expand(d, K, "ts", "flag", 23, 5, size=size),
    "flag_long_runs": lambda d, size: T.flag_long_runs(d, K, "ts", F.col("v") > 90, 6, "long", size=size),
    "saturation": lambda d, size: T.saturation(d, K, "ts", "v", 2, size=size),
    "missing_gaps": lambda d, size: T.missing_gaps(d, K, "ts", "v", 30, size=size),
    "runs_of": lambda d, size: T.runs_of(d, K, "ts", F.col("v").isNull(), size=size).drop("run"),
    "longest_unchanged": lambda d, size: T.longest_unchanged(d, K, "ts", "v", size=size),
    "gap_segments": lambda d, size: T.gap_segments(d, K, "ts", "v", 10.0, size=size),
    "missingness": lambda d, size: T.missingness(d, K, "ts", "v", size=size),
    "flat_runs": lambda d, size: T.flat_runs(d, K, "ts", "v", 30.0, size=size),
    "label_segments": lambda d, size: T.label_segments(d, K, "ts", F.when(F.col("v") > 90, "high").otherwise("low"), size=size),
}


@pytest.mark.parametrize("name", CASES)
def test_stretches_give_what_the_whole_series_gives(recording, name):
    same(CASES[name](recording, SIZE), CASES[name](recording, None))


def test_numbers_are_places(recording):
    rows = scans.numbered(recording, K, "ts", SIZE).orderBy("k", "__i").collect()
    by = {}
    for r in rows:
        by.setdefault(r.k, []).append((r["__i"], r.t, r["__stretch"]))
    for places in by.values():
        assert [p[0] for p in places] == list(range(len(places)))
        assert [p[1] for p in places] == sorted(p[1] for p in places)
        assert all(s == i // SIZE for i, _, s in places)
    assert len({s for _, _, s in by["a"]}) > 50


def test_no_task_sorts_a_whole_recording(recording):
    """Every window of the plan that holds samples is dealt by range or stretch, not by recording alone."""
    import re

    plan = T.spikes(recording, K, "ts", "v", 9, size=SIZE)._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[(.*)", plan)
    assert windows
    for w in windows:
        assert "__range" in w or "__stretch" in w, w


def test_empty(recording):
    for name, case in CASES.items():
        assert case(recording.where("false"), SIZE).count() == 0, name
