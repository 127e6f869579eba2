"""Queries on folds, areas under curves, stored models of each family and what they flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.operators import models, windows
from pulsegrid.plans.files import scratch
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import samples

c = F.col
FEATURES = ["mean", "std", "min", "range", "median", "max_change"]


def _windows(df: DataFrame, size: int = 20, step: int = 10) -> DataFrame:
    """Windows with features, a family by user, and label 1 where the mean is high."""
    out = windows.sliding_features(df, ["user_id"], "event_id", "value", size, step)
    return out.withColumn("family", F.concat(F.lit("family"), (c("user_id") % 3).cast("string"))).withColumn("label", (c("mean") > 60).cast("int"))


@query("""
WITH e AS (SELECT user_id, (value > 100)::INT AS label FROM events), u AS (SELECT user_id, count(*) AS n, floor(avg(label) * 10)::INT AS tenth FROM e GROUP BY user_id),
p AS (SELECT *, (row_number() OVER (PARTITION BY tenth ORDER BY n DESC, user_id) - 1 + 5 * (tenth % 2)) % 10 AS at_ FROM u)
SELECT user_id, (CASE WHEN at_ < 5 THEN at_ ELSE 9 - at_ END)::INT AS fold, n FROM p""")
def patient_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = models.folds(samples(spark, sf_dir).withColumn("label", (c("value") > 100).cast("int")), "user_id", "label")
    return df.groupBy("user_id", "fold").agg(F.count("*").alias("n"))


@query("""
WITH e AS (SELECT event_type, (value > 100)::INT AS label, event_id % 97 AS score FROM events),
r AS (SELECT *, rank() OVER (PARTITION BY event_type ORDER BY score) + (count(*) OVER (PARTITION BY event_type, score) - 1) / 2 AS rank FROM e)
SELECT event_type, count(*) AS n, sum(label)::BIGINT AS n_positive, round((sum(rank) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * (count(*) - sum(label))), 9) AS auroc FROM r GROUP BY event_type""")
def areas_under_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).select("event_type", (c("value") > 100).cast("int").alias("label"), (c("event_id") % 97).alias("score"))
    return models.auroc(df, "label", "score", ["event_type"]).withColumn("auroc", F.round("auroc", 9))


@query()
def cross_validated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the next window's mean is higher, by forests on folds of users: a row of scores a fold."""
    later = F.lead("mean").over(Window.partitionBy("user_id").orderBy("window"))
    rows = _windows(samples(spark, sf_dir)).withColumn("label", (later > c("mean")).cast("int")).where("label is not null")
    return models.fold_scores(models.folds(rows, "user_id", "label"), FEATURES, "label")


def _trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, DataFrame]:
    """Two stored versions of each family's model: one that can't tell windows apart, and a tree that can."""
    path = scratch(spark, "models")
    rows = _windows(samples(spark, sf_dir)).persist()
    models.train_families(rows, rows, "family", FEATURES, "label", path, 1, models.tree(0))
    registry = models.train_families(rows, rows, "family", FEATURES, "label", path, 2, models.tree(4))
    return rows, path, registry


_WINDOWS = """
WITH s AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
k AS (SELECT s.*, w FROM s, unnest(range(greatest((floor((i - 20) / 10) + 1)::BIGINT, 0), i // 10 + 1)) AS t(w)),
f AS (SELECT user_id, w, avg(value) AS mean FROM k GROUP BY ALL HAVING count(*) = 20)"""


@query(f"{_WINDOWS} SELECT 'family' || user_id % 3 AS family, 2 AS version, 1.0::DOUBLE AS f1, count(*) AS n, count(*) FILTER (mean > 60) AS n_artifact FROM f GROUP BY ALL")
def promoted_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The champion of each family after two trainings, read back, and how many windows it takes for artifacts."""
    rows, path, registry = _trained(spark, sf_dir)
    found = models.judged(spark, rows, "family", path).groupBy("family").agg(F.count("*").alias("n"), F.count_if(c("p") >= 0.5).alias("n_artifact"))
    return models.champions(registry).join(found, "family")


@query(f"{_WINDOWS} SELECT user_id, event_id, EXISTS (SELECT 1 FROM k JOIN f USING (user_id, w) WHERE k.user_id = s.user_id AND k.i = s.i AND mean > 60) AS artifact FROM s")
def model_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples under windows that the stored model of their family takes for artifacts."""
    rows, path, _ = _trained(spark, sf_dir)
    found = models.judged(spark, rows, "family", path)
    return models.masked(samples(spark, sf_dir), ["user_id"], "event_id", found, 20, 10).select("user_id", "event_id", "artifact")
