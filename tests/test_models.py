"""Folds, areas under curves, and models that are stored, promoted and applied."""

import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import models


def test_folds_are_closed_over_units_and_balanced(spark):
    rng = random.Random(1)
    rows = [(u, int(rng.random() < u % 10 / 10)) for u in range(200) for _ in range(rng.randint(1, 30))]
    rows += [(None, 1)] * 5
    out = models.folds(spark.createDataFrame(rows, "unit int, y int"), "unit", "y", 5)
    assert out.count() == len(rows)
    assert out.groupBy("unit").agg(F.countDistinct("fold").alias("k")).where("k > 1").count() == 0
    sizes = out.groupBy("fold").agg(F.count("*").alias("n"), F.avg("y").alias("share")).orderBy("fold").collect()
    mean = sum(r[1] for r in rows) / len(rows)
    assert [r.fold for r in sizes] == [0, 1, 2, 3, 4]
    assert all(abs(r.n - len(rows) / 5) < 0.15 * len(rows) / 5 and abs(r.share - mean) < 0.05 for r in sizes)


def test_auroc_counts_all_pairs(spark):
    rng = random.Random(2)
    rows = [("a", rng.randint(0, 1), float(rng.randint(0, 9))) for _ in range(120)] + [("b", 1, 0.5), ("b", 1, 0.7)] + [("c", 0, 1.0), ("c", 1, 2.0), ("c", 1, None)]
    got = {r.k: r for r in models.auroc(spark.createDataFrame(rows, "k string, y int, s double"), "y", "s", ["k"]).collect()}
    pos, neg = ([s for k, y, s in rows if k == "a" and y == v] for v in (1, 0))
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert got["a"].auroc == pytest.approx(wins / len(pos) / len(neg)) and got["a"].n_positive == len(pos)
    assert got["b"].auroc is None and (got["c"].auroc, got["c"].n) == (1.0, 2)


def test_challengers_must_gain(spark):
    rows = [("a", 1, 0.50), ("a", 2, 0.505), ("a", 3, 0.52), ("a", 4, 0.525), ("b", 2, 0.9), ("b", 1, 0.95), ("c", 1, 0.0)]
    got = models.champions(spark.createDataFrame(rows, "family string, version int, f1 double")).collect()
    assert sorted(map(tuple, got)) == [("a", 3, 0.52), ("b", 1, 0.95), ("c", 1, 0.0)]


def test_models_are_stored_promoted_and_applied(spark, tmp_path):
    rows = [("x", i, float(i), int(i >= 30)) for i in range(60)] + [("y", i, float(i), int(i < 20)) for i in range(60)]
    df = spark.createDataFrame(rows, "family string, window long, v double, label int")
    path = str(tmp_path / "models")
    models.train_families(df, df, "family", ["v"], "label", path, 1, models.tree(0))
    registry = models.train_families(df, df, "family", ["v"], "label", path, 2, models.tree(2))
    again = models.train_families(df, df, "family", ["v"], "label", path, 2, models.tree(0))
    assert again.count() == registry.count() == 4
    assert sorted((r.family, r.version, r.f1) for r in models.champions(registry).collect()) == [("x", 2, 1.0), ("y", 2, 1.0)]
    other = df.unionByName(spark.createDataFrame([("z", 1, 1.0, 0), (None, 1, 1.0, 0)], df.schema))
    got = models.judged(spark, other, "family", path).collect()
    assert len(got) == 122 and all((r.p is None) if r.family in ("z", None) else (r.p >= 0.5) == bool(r.label) for r in got)


def test_cross_validation(spark):
    rng = random.Random(3)
    rows = [(u, float(x := rng.random()), int(x + rng.random() * 0.2 > 0.6)) for u in range(40) for _ in range(10)]
    df = models.folds(spark.createDataFrame(rows, "unit int, x double, label int"), "unit", "label", 4)
    got = models.fold_scores(df, ["x"], "label", 4, models.tree(3)).collect()
    assert sorted(r.fold for r in got) == [0, 1, 2, 3] and sum(r.n for r in got) == 400
    assert all(r.auroc > 0.9 and r.f1 > 0.8 for r in got)
    best = models.searched(df, ["x"], "label", (1, 4), 4)
    assert max(best.avgMetrics) > 0.9


def test_a_threshold_between_quantiles_is_found(spark):
    rng = random.Random(4)
    rows = [(rng.random(), x := rng.gauss(0, 1), int(x > 0.3)) for _ in range(12_000)] + [(None, 9.0, 0)]
    df = spark.createDataFrame(rows, "noise double, x double, label int")
    model = models.fitted(df, ["noise", "x"], "label", models.tree(4, 64))
    assert model.stages[-1].numFeatures == 2 and "not in" not in model.stages[-1].toDebugString  # places are no categories
    got = models.with_probability(model, df)
    assert got.count() == 12_000 and got.where("(p >= 0.5) <> (label = 1)").count() == 0
    assert all(len(s) <= 65 for s in models.candidate_splits(df, ["noise", "x"], "label", 64))
