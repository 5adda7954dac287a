"""Settings are compared on all rows, as a plain cross-validation does."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from lendframe import staging
from lendframe.plans import training as M


def points(spark, n):
    rows = spark.range(n).selectExpr("id AS application_id", "CAST(pmod(hash(id), 100) AS DOUBLE) AS a", "CAST(pmod(hash(id, 1), 100) AS DOUBLE) AS b")
    rows = rows.withColumn("y", F.col("a") * 2 + F.col("b")).withColumn("emi_eligibility", (F.col("a") + F.col("b") / 2 > 70).cast("int"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)


def test_settings_are_compared_on_all_rows(spark, monkeypatch):
    """No sample unless asked for, and the folds and figures of a cross-validation."""
    def sampled(*args, **options):
        raise AssertionError("a sample was taken")

    monkeypatch.setattr(M, "tune_sample", sampled)
    train, ranges = staging.staged(points(spark, 400), "points"), {"maxDepth": [1, 3], "minInstancesPerNode": [1, 30]}
    tree = DecisionTreeClassifier(labelCol="emi_eligibility", weightCol=M.WEIGHT, seed=1)
    model, settings, score = M.tune(train, tree, ranges, trials=3, folds=3)
    maps, rows = M.draw_settings(tree, ranges, 3), M.weighted(train, "emi_eligibility")
    plain = CrossValidator(estimator=tree, estimatorParamMaps=maps, numFolds=3, seed=42, evaluator=M.BinaryClassificationEvaluator(
        labelCol="emi_eligibility", metricName="areaUnderROC")).fit(rows)
    assert score == pytest.approx(max(plain.avgMetrics), abs=1e-12)
    assert settings == {p.name: v for p, v in maps[plain.avgMetrics.index(max(plain.avgMetrics))].items()}
    assert model.depth <= settings["maxDepth"] and not spark._jsparkSession.sharedState().cacheManager().lookupCachedData(rows._jdf).isDefined()
    with pytest.raises(AssertionError, match="a sample was taken"):
        M.tune(train, tree, ranges, trials=1, folds=2, sample=100)
