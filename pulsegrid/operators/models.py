"""Models per family of signals: folds, cross-validation, stored versions, promotion, and what they say about samples."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.operators.learning import scores
from pulsegrid.operators.rules import windows_to_samples
from pulsegrid.sources.sinks import append_new, exists

#: Families that are trained or applied at the same time.
PARALLEL = 4
#: What F1 a challenger must gain.
LEAST_GAIN = 0.01


def folds(df: DataFrame, unit: str, label: str, k: int = 5) -> DataFrame:
    """Column ``fold`` (0 to k - 1): all rows of a unit (a patient) are in one fold, and folds have nearly the same shares
    of rows and of label 1.

    Units with like shares of label 1 (in tenths) are dealt together, the largest first, back and forth over the folds.
    """
    units = df.groupBy(unit).agg(F.count("*").alias("__n"), F.avg((F.col(label) == 1).cast("int")).alias("__share"))
    tenth = F.floor(F.coalesce("__share", F.lit(0.0)) * 10)
    place = F.row_number().over(Window.partitionBy(tenth).orderBy(F.desc("__n"), unit)) - 1
    at = F.pmod(place + k * (tenth % 2), F.lit(2 * k))
    units = units.select(F.col(unit).alias("__unit"), F.when(at < k, at).otherwise(2 * k - 1 - at).cast("int").alias("fold"))
    return df.join(units, F.col(unit).eqNullSafe(F.col("__unit"))).drop("__unit")


def auroc(df: DataFrame, label: str, score: str, scope: list[str] | None = None) -> DataFrame:
    """Per scope: n, n_positive and the area under the ROC curve, exactly: the chance that a row of label 1 scores higher
    than one of label 0, ties counting half. Null where one label is missing.

    Rows are counted per score first; what is ordered is the distinct scores.
    """
    scope = scope or []
    counts = df.where(F.col(score).isNotNull()).groupBy(*scope, score).agg(
        F.count_if(F.col(label) == 1).cast("double").alias("__p"), F.count_if(F.col(label) == 0).cast("double").alias("__q")
    )
    w = Window.partitionBy(*(scope or [F.lit(0)])).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__below", F.coalesce(F.sum("__q").over(w), F.lit(0.0)))
    out = counts.groupBy(*scope).agg(F.sum("__p").alias("__p"), F.sum("__q").alias("__q"), F.sum(F.col("__p") * (F.col("__below") + F.col("__q") / 2)).alias("__wins"))
    return out.select(
        *scope, (F.col("__p") + F.col("__q")).cast("long").alias("n"), F.col("__p").cast("long").alias("n_positive"), (F.col("__wins") / F.nullif(F.col("__p") * F.col("__q"), F.lit(0.0))).alias("auroc")
    )


def pipeline(features: list[str], label: str, classifier=None) -> Pipeline:
    """Rows with a null feature are left out."""
    classifier = classifier or RandomForestClassifier(numTrees=50, maxDepth=8, seed=7)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip"), classifier.setLabelCol(label)])


def tree(depth: int, bins: int = 2048) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth, maxBins=bins, seed=7)


def candidate_splits(df: DataFrame, features: list[str], label: str, bins: int) -> list[list[float]]:
    """Where a tree may split each feature, at most ``bins`` - 1 places: quantiles, and in each bin between them whose labels
    lie apart the place between the labels. So a feature that tells labels apart does so however many values it has.

    What is collected are two extremes of each label for each bin.
    """
    half = bins // 2
    quantiles = df.approxQuantile(features, [i / half for i in range(1, half)], 0.1 / bins)
    splits = [[-math.inf, *(sorted(set(q)) or [0.0]), math.inf] for q in quantiles]
    places = [f"__place_{i}" for i in range(len(features))]
    rows = Bucketizer(splitsArray=splits, inputCols=features, outputCols=places, handleInvalid="skip").transform(df)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(p).cast("int").alias("place"), F.col(f).cast("double").alias("v")) for i, (f, p) in enumerate(zip(features, places))]))
    one = F.col(label) == 1
    ends = [g(F.when(c, F.col("x.v"))).alias(n) for n, g, c in (("low0", F.min, ~one), ("high0", F.max, ~one), ("low1", F.min, one), ("high1", F.max, one))]
    for r in rows.select(label, cells.alias("x")).groupBy("x.i", "x.place").agg(*ends).collect():
        if r.low0 is None or r.low1 is None:
            continue
        for under, over in ((r.high0, r.low1), (r.high1, r.low0)):
            if under < over:
                middle = under / 2 + over / 2
                splits[r.i].append(middle if under < middle <= over else over)
    return [sorted(set(s)) for s in splits]


def fitted(df: DataFrame, features: list[str], label: str, classifier=None) -> PipelineModel:
    """The pipeline fitted on ``df``; a tree's splits are among ``candidate_splits``, since its own are quantiles alone."""
    if not isinstance(classifier, DecisionTreeClassifier) or not classifier.getMaxDepth():
        return pipeline(features, label, classifier).fit(df)
    places = [f"__place_{f}" for f in features]
    splits = candidate_splits(df, features, label, classifier.getMaxBins())
    bucketizer = Bucketizer(splitsArray=splits, inputCols=features, outputCols=places, handleInvalid="skip")
    # The bucketizer calls its places categories; sums are numbers in their order.
    numbers = [f"__at_{i}" for i in range(len(features))]
    ordered = SQLTransformer(statement=f"SELECT *, {', '.join(f'`{p}` + 0D AS {n}' for p, n in zip(places, numbers))} FROM __THIS__")
    return Pipeline(stages=[bucketizer, ordered, *pipeline(numbers, label, classifier).getStages()]).fit(df)


def with_probability(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("p", F.get(vector_to_array("probability"), F.lit(1)))


def fold_scores(df: DataFrame, features: list[str], label: str, k: int = 5, classifier=None) -> DataFrame:
    """Each fold's scores by a model of the other folds (column ``fold``): fold, n, n_positive, auroc, f1, mcc. k rows."""
    df = df.persist()

    def one(i: int) -> DataFrame:
        model = pipeline(features, label, classifier.copy() if classifier else None).fit(df.where(F.col("fold") != i))
        found = with_probability(model, df.where(F.col("fold") == i))
        return auroc(found, label, "p").crossJoin(F.broadcast(scores(found, label).select("f1", "mcc"))).select(F.lit(i).alias("fold"), "*")  # one row each

    with ThreadPoolExecutor(PARALLEL) as pool:
        parts = list(pool.map(one, range(k)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def searched(df: DataFrame, features: list[str], label: str, depths: tuple[int, ...] = (4, 8, 12), k: int = 5) -> CrossValidatorModel:
    """The forest of the depth with the best mean AUROC over the given folds (column ``fold``), fitted on all rows."""
    forest = RandomForestClassifier(numTrees=50, seed=7)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).build()
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    return CrossValidator(estimator=pipeline(features, label, forest), estimatorParamMaps=grid, evaluator=evaluator, numFolds=k, foldCol="fold", parallelism=PARALLEL).fit(df)


def train_families(train: DataFrame, test: DataFrame, family: str, features: list[str], label: str, path: str, version: int, classifier=None) -> DataFrame:
    """Fits, stores and scores a model for each family (their number is that of a dictionary, not of the data), several at a
    time. What is there already under a version isn't written again. Returns the registry: family, version, n, f1, auroc."""
    spark = train.sparkSession
    names = sorted(r[0] for r in train.where(F.col(family).isNotNull()).select(family).distinct().collect())

    def one(name: str) -> DataFrame:
        at = f"{path}/{name}/{version}"
        if not exists(spark, f"{at}/metadata"):
            fitted(train.where(F.col(family) == name), features, label, classifier.copy() if classifier else None).write().overwrite().save(at)
        found = with_probability(PipelineModel.load(at), test.where(F.col(family) == name))
        row = scores(found, label).select("n", "f1").crossJoin(F.broadcast(auroc(found, label, "p").select("auroc")))  # one row each
        return row.select(F.lit(name).alias("family"), F.lit(version).alias("version"), "n", "f1", "auroc")

    with ThreadPoolExecutor(PARALLEL) as pool:
        rows = [r.first().asDict() for r in pool.map(one, names)]
    append_new(spark.createDataFrame(rows, "family string, version int, n long, f1 double, auroc double"), f"{path}/registry", ["family", "version"])
    return spark.read.parquet(f"{path}/registry")


def champions(registry: DataFrame, least_gain: float = LEAST_GAIN) -> DataFrame:
    """family, version, f1 of the model in use: versions in turn, each promoted if its F1 exceeds the champion's by more
    than ``least_gain``. A family's versions, a few numbers, are folded in one row."""
    turn = F.array_sort(F.collect_list(F.struct("version", "f1")))
    best = F.aggregate(
        F.slice("vs", F.lit(2), F.greatest(F.size("vs") - 1, F.lit(0))),
        F.get("vs", F.lit(0)),
        lambda champion, v: F.when(v["f1"] - champion["f1"] > least_gain, v).otherwise(champion),
    )
    return registry.groupBy("family").agg(turn.alias("vs")).select("family", best.alias("b")).select("family", "b.version", "b.f1")


def judged(spark: SparkSession, windows: DataFrame, family: str, path: str) -> DataFrame:
    """Windows with ``p`` by the champion of their family, loaded by name; null for families without a model."""
    chosen = champions(spark.read.parquet(f"{path}/registry")).collect()  # one row a family
    names = [r.family for r in chosen]
    out = windows.where(~F.coalesce(F.col(family).isin(names), F.lit(False))).withColumn("p", F.lit(None).cast("double"))
    for r in chosen:
        model = PipelineModel.load(f"{path}/{r.family}/{r.version}")
        out = out.unionByName(with_probability(model, windows.where(F.col(family) == r.family)).select(*out.columns))
    return out


def masked(df: DataFrame, keys: list[str], order: str, judged_windows: DataFrame, size: int, step: int, threshold: float = 0.5, flag: str = "artifact") -> DataFrame:
    """Samples with ``flag``: some window over them has a probability of at least ``threshold``."""
    hit: Column = F.coalesce(F.col("p") >= threshold, F.lit(False))
    return windows_to_samples(df, keys, order, judged_windows.withColumn(flag, hit), size, step, flag)
