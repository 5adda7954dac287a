"""Model training on Spark ML: estimators, tuning, scoring and importances."""

import json
import random
from math import prod
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.operators.sampling import class_counts, tune_sample
from lendframe.operators.scoring import score_columns
from lendframe.staging import VECTORS_PER_FILE, discard, staged

WEIGHT = "class_weight"
VALIDATION = "validation"
_FOLD = "_fold"


def with_validation(df: DataFrame, share: float = 0.1, key: str = "application_id", seed: int = 42) -> DataFrame:
    """Marks a share of the rows, told by a hash of their key: boosting stops when these rows gain no more."""
    return df.withColumn(VALIDATION, F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000)) < int(share * 10_000))


def class_weights(df: DataFrame, label: str = S.TARGET_CLASS) -> dict:
    """Balanced weights n / (2 * n_class)."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    return {k: total / (len(counts) * n) for k, n in counts.items()}


def weighted(df: DataFrame, label: str = S.TARGET_CLASS, weights: dict | None = None) -> DataFrame:
    weights = weights or class_weights(df, label)
    w = F.lit(1.0)
    for k, x in weights.items():
        w = F.when(F.col(label) == F.lit(k), F.lit(float(x))).otherwise(w)
    return df.withColumn(WEIGHT, w)


class ClassWeigher(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns balanced class weights, so that a pipeline carries them with its model."""

    labelCol = Param(Params._dummy(), "labelCol", "class column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol: str = S.TARGET_CLASS):
        super().__init__()
        self._setDefault(labelCol=S.TARGET_CLASS)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ClassWeigherModel":
        label = self.getOrDefault(self.labelCol)
        weights = {str(k): w for k, w in class_weights(df, label).items()}
        return ClassWeigherModel()._set(labelCol=label, weights=json.dumps(weights))


class ClassWeigherModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the weight of a row's class; rows without a label weigh one."""

    labelCol = Param(Params._dummy(), "labelCol", "class column", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "weight per class as JSON", TypeConverters.toString)

    def _transform(self, df: DataFrame) -> DataFrame:
        label, w = self.getOrDefault(self.labelCol), F.lit(1.0)
        if label in df.columns:
            for k, x in json.loads(self.getOrDefault(self.weights)).items():
                w = F.when(F.col(label).cast("string") == k, F.lit(float(x))).otherwise(w)
        return df.withColumn(WEIGHT, w)


def _weighed(stages, label) -> Pipeline:
    return Pipeline(stages=[ClassWeigher(labelCol=label), *stages])


def fit_stages(stages: list, df: DataFrame, written: int = 1) -> PipelineModel:
    """Fits a pipeline whose first ``written`` stages shuffle their rows: what they make is written once, and the passes of
    the stages after them read it."""
    head = Pipeline(stages=stages[:written]).fit(df)
    rows = staged(head.transform(df), "stages", rows_per_file=VECTORS_PER_FILE)
    tail = Pipeline(stages=stages[written:]).fit(rows)
    discard(rows)
    return PipelineModel([*head.stages, *tail.stages])


def logistic_regression(label=S.TARGET_CLASS, features="features", iterations=1000, reg=0.0) -> Pipeline:
    return _weighed([
        StandardScaler(inputCol=features, outputCol="scaled", withMean=True, withStd=True),
        LogisticRegression(featuresCol="scaled", labelCol=label, weightCol=WEIGHT,
                           maxIter=iterations, regParam=reg),
    ], label)


def random_forest(label=S.TARGET_CLASS, features="features", trees=20, depth=8, seed=42) -> Pipeline:
    return _weighed([RandomForestClassifier(
        featuresCol=features, labelCol=label, weightCol=WEIGHT, numTrees=trees, maxDepth=depth,
        seed=seed)], label)


def boosted_trees(label=S.TARGET_CLASS, features="features", rounds=20, depth=5, seed=42) -> Pipeline:
    return _weighed([GBTClassifier(
        featuresCol=features, labelCol=label, weightCol=WEIGHT, maxIter=rounds, maxDepth=depth,
        seed=seed)], label)


def early_stopped(estimator, rounds: int = 100, least_gain: float = 0.01):
    """A boosted estimator that takes at most ``rounds`` trees and stops once the rows marked by ``with_validation``
    gain less than that share of their error."""
    return estimator.copy({estimator.maxIter: rounds, estimator.validationIndicatorCol: VALIDATION, estimator.validationTol: least_gain})


def forest_regressor(target=S.TARGET_AMOUNT, features="features", trees=20, depth=8, seed=42):
    return RandomForestRegressor(featuresCol=features, labelCol=target, numTrees=trees,
                                 maxDepth=depth, seed=seed)


def boosted_regressor(target=S.TARGET_AMOUNT, features="features", rounds=20, depth=5, seed=42):
    return GBTRegressor(featuresCol=features, labelCol=target, maxIter=rounds, maxDepth=depth, seed=seed)


CLASSIFIERS = {
    "logistic_regression": logistic_regression,
    "random_forest": random_forest,
    "boosted_trees": boosted_trees,
}
REGRESSORS = {"random_forest": forest_regressor, "boosted_trees": boosted_regressor}


def probability() -> Column:
    return vector_to_array("probability")[1]


def scored_with_models(df: DataFrame, classifier, regressor, keep=tuple(S.KEY_COLUMNS)) -> DataFrame:
    """Both models applied to encoded rows, then zones, labels and bounded amounts."""
    rows = classifier.transform(df).withColumn("_p", probability()).drop(
        "probability", "rawPrediction", "prediction")
    rows = regressor.transform(rows)
    return rows.select(*keep, *score_columns(F.col("_p"), F.col("prediction")))


def draw_settings(estimator, ranges: dict, trials: int, seed: int = 42) -> list[dict]:
    """Random parameter maps, none twice: ``ranges`` gives a list of choices per parameter name. All there are, if fewer."""
    names = sorted(ranges)
    settings = prod(len(ranges[n]) for n in names)
    drawn = []
    for number in random.Random(seed).sample(range(settings), min(trials, settings)):
        one = {}
        for n in names:
            number, k = divmod(number, len(ranges[n]))
            one[estimator.getParam(n)] = ranges[n][k]
        drawn.append(one)
    return drawn


def in_folds(df: DataFrame, folds: int, seed: int) -> DataFrame:
    """Each row with the number of its fold."""
    number = sum(((F.col("_u") >= F.lit(i / folds)).cast("int") for i in range(1, folds)), F.lit(0))
    return df.withColumn("_u", F.rand(seed)).withColumn(_FOLD, number).drop("_u")


def tune(train: DataFrame, estimator, ranges: dict, trials: int = 3, folds: int = 3,
         sample: int | None = None, regression: bool = False, parallelism: int = 1, seed: int = 42):
    """Cross-validate drawn settings, refit the best on all rows.

    Settings are compared on all rows; classifiers, if ``sample`` is given, on at most so many, stratified by
    their label. The rows are kept once for all folds. Each of ``parallelism`` fits at a time holds its own
    form of them. Returns (model, best settings, mean metric).
    """
    label = estimator.getLabelCol()
    rows = train if regression else weighted(train, label)
    sampled = sample is not None and not regression
    kept = in_folds(tune_sample(rows, sample, by=label, seed=seed) if sampled else rows, folds, seed).persist()
    evaluator = (RegressionEvaluator(labelCol=label, metricName="rmse") if regression
                 else BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"))
    maps = draw_settings(estimator, ranges, trials, seed)

    def metric(task: tuple[int, int]) -> float:
        fold, setting = task
        model = estimator.copy(maps[setting]).fit(kept.filter(F.col(_FOLD) != fold).drop(_FOLD))
        return evaluator.evaluate(model.transform(kept.filter(F.col(_FOLD) == fold).drop(_FOLD)))

    tasks = [(fold, setting) for fold in range(folds) for setting in range(len(maps))]
    with ThreadPool(max(1, parallelism)) as pool:
        metrics = dict(zip(tasks, pool.map(inheritable_thread_target(train.sparkSession)(metric), tasks, 1)))
    means = [sum(metrics[fold, i] for fold in range(folds)) / folds for i in range(len(maps))]
    better = min if regression else max
    best = better(range(len(maps)), key=lambda i: means[i])
    settings = {p.name: v for p, v in maps[best].items()}
    model = estimator.copy(maps[best]).fit(rows if sampled else kept.drop(_FOLD))
    kept.unpersist()
    return model, settings, means[best]


def importances(model: PipelineModel, names: list[str], k: int = 20) -> list[tuple[str, float]]:
    """Top features of the last stage: tree importances, or absolute coefficients."""
    last = model.stages[-1]
    values = (last.featureImportances if hasattr(last, "featureImportances") else last.coefficients)
    pairs = sorted(((n, abs(float(v))) for n, v in zip(names, values.toArray())),
                   key=lambda x: (-x[1], x[0]))
    return pairs[:k]


def importance_frame(spark, pairs: list[tuple[str, float]]) -> DataFrame:
    return spark.createDataFrame(pairs, "feature string, importance double")
