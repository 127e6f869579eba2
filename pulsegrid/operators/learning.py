"""Classification and clustering of windows and patients with pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split(df: DataFrame, unit: str, parts: tuple[int, int, int] = (70, 15, 15), label: str | None = None) -> DataFrame:
    """Column ``part`` (train, validate, test) by a hash of the unit, so that all rows of a unit are in one part.

    With a label the hash is taken per label, which keeps its shares.
    """
    key = [F.col(unit)] + ([F.col(label).cast("string")] if label else [])
    h = F.pmod(F.xxhash64(*key), F.lit(100))
    part = F.when(h < parts[0], "train").when(h < parts[0] + parts[1], "validate").otherwise("test")
    return df.withColumn("part", part)


def scores(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: n, accuracy, precision, recall, F1 and Matthews' correlation; under F1 0.8 it is UNRELIABLE."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    c = predicted.agg(
        F.count_if(y & p).cast("double").alias("tp"), F.count_if(~y & p).cast("double").alias("fp"), F.count_if(y & ~p).cast("double").alias("fn"), F.count_if(~y & ~p).cast("double").alias("tn")
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    over = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0))
    f1 = over(2 * tp, 2 * tp + fp + fn)
    return c.select(
        (tp + fp + fn + tn).cast("long").alias("n"),
        over(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        over(tp, tp + fp).alias("precision"),
        over(tp, tp + fn).alias("recall"),
        f1.alias("f1"),
        over(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"),
        F.when(f1 < 0.8, "UNRELIABLE").otherwise("RELIABLE").alias("status"),
    )


def forest(df: DataFrame, features: list[str], label: str, trees: int = 100, depth: int = 12, seed: int = 7):
    """A random forest over the train part; rows with a null feature are left out.

    Rows are kept while it learns, as it reads them for labels, sizes, splits and the trees; they are made once. They are
    joined to a part a core: each part makes statistics of all nodes of a level, however few rows it has.
    """
    stages = [VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip"), RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)]
    rows = df.select(*features, label).coalesce(df.sparkSession.sparkContext.defaultParallelism).persist()
    try:
        return Pipeline(stages=stages).fit(rows)
    finally:
        rows.unpersist()


def boosted(df: DataFrame, features: list[str], label: str, rounds: int = 20, seed: int = 7):
    stages = [VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip"), GBTClassifier(labelCol=label, maxIter=rounds, seed=seed)]
    return Pipeline(stages=stages).fit(df)


def probability(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("p", F.get(vector_to_array("probability"), F.lit(1)))


def promote(champion_f1: float, challenger_f1: float, least: float = 0.01) -> bool:
    return challenger_f1 - champion_f1 > least


def clusters(df: DataFrame, features: list[str] | str, k: int = 5, seed: int = 7):
    """Standardised features, k-means clusters and two principal components; features are columns or one array column."""
    if isinstance(features, str):
        df = df.withColumn("__raw", array_to_vector(F.col(features).cast("array<double>")))
        stages = []
    else:
        stages = [VectorAssembler(inputCols=features, outputCol="__raw", handleInvalid="skip")]
    stages += [
        StandardScaler(inputCol="__raw", outputCol="features", withMean=True),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster"),
        PCA(k=2, inputCol="features", outputCol="__pca"),
    ]
    out = Pipeline(stages=stages).fit(df).transform(df)
    pca = vector_to_array("__pca")
    return out.withColumn("pc1", F.get(pca, F.lit(0))).withColumn("pc2", F.get(pca, F.lit(1))).drop("__raw", "__pca")


def silhouettes(df: DataFrame, features: list[str] | str, ks: tuple[int, ...] = (3, 5, 7, 10), seed: int = 7) -> DataFrame:
    """Silhouette (squared Euclidean) per number of clusters: a few rows."""
    rows = []
    for k in ks:
        found = clusters(df, features, k, seed).withColumn("prediction", F.col("cluster"))
        rows.append((k, float(ClusteringEvaluator().evaluate(found))))
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


def pseudo_label(missing: Column, std: Column, in_norm: Column, pulsatile: bool) -> Column:
    """1 for windows that look like artifacts: over 20 % missing, flat where a pulse is due, under 30 % in the norm."""
    flat = std < 1e-6 if pulsatile else F.lit(False)
    return ((missing > 0.2) | flat | (in_norm < 0.3)).cast("int")


def review_labels(df: DataFrame, decision: str) -> DataFrame:
    """is_artifact from human decisions; unknown ones are left out."""
    rows = df.where(F.col(decision) != "UNKNOWN")
    return rows.withColumn("is_artifact", (~F.col(decision).isin("VALID", "CLINICALLY_ABNORMAL")).cast("int"))


def ventilation(df: DataFrame) -> DataFrame:
    """Columns volume_error (relative error of the minute volume against tidal volume and rate) and order_broken (a peak
    pressure below the end-expiratory one); a missing value breaks nothing."""
    c = F.col
    want = c("vt") * c("rr") / 1000
    out = df.withColumn("volume_error", F.abs(c("mve") - want) / F.nullif(F.abs(want), F.lit(0.0)))
    return out.withColumn("order_broken", F.coalesce(c("pip") < c("peep"), F.lit(False)))


def retraining(labels: DataFrame, key: str, label: str, before: str, least: int = 50) -> DataFrame:
    """Per key the labels but for unknown ones, the artifacts among them, and whether a training is due: ``least`` of them, and
    more than at the last one."""
    out = labels.where(F.col(label) != "UNKNOWN").groupBy(key).agg(F.count("*").alias("n_labels"), F.count_if(F.col(label) == "ARTIFACT").alias("n_artifact"), F.max(before).alias("__before"))
    return out.withColumn("retrain", (F.col("n_labels") >= least) & (F.col("n_labels") > F.col("__before"))).drop("__before")


def unit_features(df: DataFrame, keys: list[str], value: str, least: int = 10) -> DataFrame:
    """mean, sd, low, high, median and share missing of units with ``least`` values at least."""
    out = df.groupBy(*keys).agg(
        F.count(value).alias("__n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.min(value).alias("low"), F.max(value).alias("high"), F.median(value).alias("median"),
        (1 - F.count(value) / F.count("*")).alias("missing"),
    )
    return out.where(F.col("__n") >= least).drop("__n")
