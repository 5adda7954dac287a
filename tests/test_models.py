import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lendframe.operators import evaluation as E
from lendframe.operators import leakage, sampling
from lendframe.plans import training as M


def scored(spark, labels, scores):
    return spark.createDataFrame([("m", int(y), float(s)) for y, s in zip(labels, scores)],
                                 "model string, label int, score double")


def test_auc_counts_ties_half(spark):
    rng = np.random.RandomState(0)
    labels, scores = rng.randint(0, 2, 300), np.round(rng.rand(300), 1)
    pos, neg = scores[labels == 1], scores[labels == 0]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert E.auc(scored(spark, labels, scores)).first()["auc"] == pytest.approx(want, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    assert E.auc(scored(spark, [1, 1], [0.2, 0.4])).first()["auc"] is None


def test_roc_ends_at_one(spark):
    rows = sorted(E.roc_points(scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.7, 0.1])).collect(),
                  key=lambda r: -r["threshold"])
    assert [(r["fpr"], r["tpr"]) for r in rows] == [(0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_classifier_without_hits_scores_zero(spark):
    r = E.eval_classifier(scored(spark, [1, 0, 0], [0.1, 0.2, 0.3])).first()
    assert (r["f1"], r["precision"], r["recall"]) == (0.0, 0.0, 0.0)


def test_regressor_metrics(spark):
    df = spark.createDataFrame([("m", 100.0, 110.0), ("m", 200.0, 190.0), ("m", 300.0, 300.0)],
                               "model string, actual double, predicted double")
    r = E.eval_regressor(df).first()
    assert r["mae"] == pytest.approx(20 / 3, abs=1e-4) and r["r2"] == pytest.approx(0.99, abs=1e-6)
    assert r["mape"] == pytest.approx(5.0, abs=1e-4) and r["passed"]


def test_champions(spark):
    runs = spark.createDataFrame([("lightgbm", 0.9, 0.8), ("xgboost", 0.9, 0.8), ("other", 0.9, 0.8),
                                  ("random_forest", 0.9, 0.7)], "model string, auc double, f1 double")
    assert E.champion_classifier(runs, E.SPEED_PREFERENCE).first()["model"] == "lightgbm"
    assert E.champion_classifier(runs.filter("model in ('other', 'xgboost')"),
                                 E.SPEED_PREFERENCE).first()["model"] == "xgboost"


def test_rollback_moves_the_alias(spark):
    moves = spark.createDataFrame([("n", "champion", 1, 1), ("n", "champion", 2, 2), ("n", "champion", 1, 3)],
                                  "registered_name string, alias string, version int, assigned_at int")
    assert E.current_aliases(moves).first()["version"] == 1


def test_split_is_exact_per_class(spark):
    df = spark.range(1003).select(F.col("id").alias("application_id"),
                                  (F.col("id") % 5 == 0).cast("int").alias("emi_eligibility"))
    train, test = sampling.stratified_split(df)
    assert test.count() == 201 and train.count() == 802
    assert test.filter("emi_eligibility = 1").count() == 40
    assert train.join(test, "application_id").count() == 0
    again = sampling.stratified_split(df.repartition(7))[1]
    assert again.join(test, "application_id").count() == 201


def test_largest_remainders():
    assert sampling.proportional_quotas({0: 7, 1: 3}, 5) == {0: 4, 1: 1}
    assert sampling.proportional_quotas({0: 10, 1: 5, 2: 5}, 7) == {0: 3, 1: 2, 2: 2}


def test_sample_takes_small_classes_whole(spark):
    df = spark.range(100).select(F.col("id").alias("application_id"),
                                 (F.col("id") < 8).cast("int").alias("emi_eligibility"))
    counts = {r[0]: r[1] for r in sampling.class_sample(df, 20).groupBy("emi_eligibility").count().collect()}
    assert counts == {0: 20, 1: 8}


def test_permutation_keeps_label_counts(spark):
    df = spark.range(400).select(F.col("id").alias("application_id"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    dealt = sampling.permute_labels(df, "y", 3)
    assert dealt.count() == 400 and dealt.filter("y = 1").count() == 100
    moved = dealt.join(df.withColumnRenamed("y", "old"), "application_id").filter("y <> old").count()
    assert 100 < moved < 200


def test_overlap_counts_pairs_and_matches_nulls(spark):
    train = spark.createDataFrame([(1, None), (1, None), (2, 5), (3, 6)], "a int, b int")
    test = spark.createDataFrame([(1, None), (2, 5), (2, 5), (9, 9)], "a int, b int")
    r = leakage.overlap(train, test).first()
    assert (r["overlap_rows"], r["train_rows"], r["test_rows"], r["passed"]) == (4, 4, 4, False)
    assert leakage.overlap(train.filter("a = 3"), test).first()["passed"]


def points(spark, n, seed, signal):
    rng = np.random.RandomState(seed)
    x, y = rng.randn(n, 2), rng.randint(0, 2, n)
    x[:, 0] += signal * y
    rows = [(i, float(a), float(b), int(k)) for i, ((a, b), k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "application_id long, a double, b double, emi_eligibility int").withColumn(
        "features", array_to_vector(F.array("a", "b")))


def test_shuffled_labels_give_no_signal(spark):
    r = leakage.shuffled_target(points(spark, 400, 1, 3.0), points(spark, 400, 2, 0.0), runs=2, tolerance=0.15).first()
    assert r["n_runs"] == 2 and r["passed"]


def test_labels_are_dealt_without_the_vectors(spark, monkeypatch):
    """Only ids and labels are ranked; the vectors are written and joined once, whatever the number of runs."""
    ranked, written, permute, keep = [], [], leakage.permute_labels, leakage.staged
    monkeypatch.setattr(leakage, "permute_labels", lambda df, *args: ranked.append(df.columns) or permute(df, *args))
    monkeypatch.setattr(leakage, "staged", lambda df, *args, **options: written.append(df.count()) or keep(df, *args, **options))
    train = points(spark, 60, 1, 3.0)
    # ids that repeat or are null are rows of their own
    train = train.withColumn("application_id", F.when(F.col("application_id") > 5, F.col("application_id") % 40))
    r = leakage.shuffled_target(train, points(spark, 60, 2, 0.0), runs=3, iterations=5).first()
    assert r["n_runs"] == 3 and len(r["all_runs"]) == 3
    assert len(ranked) == 3 and all("features" not in columns for columns in ranked)
    assert written == [60, 60]


def test_later_stages_read_what_the_first_ones_wrote(spark):
    from pyspark.ml import Estimator, Model, Transformer
    from pyspark.ml.feature import VectorAssembler

    class Shuffle(Transformer):
        def _transform(self, df):
            return df.dropDuplicates()

    class Probe(Estimator):
        def _fit(self, df):
            seen.append((df.count(), "Exchange" in df._jdf.queryExecution().executedPlan().toString()))
            return Same()

    class Same(Model):
        def _transform(self, df):
            return df

    seen, rows = [], points(spark, 50, 1, 3.0).select("a", "b")
    stages = [Shuffle(), VectorAssembler(inputCols=["a", "b"], outputCol="v"), Probe(), Probe()]
    model = M.fit_stages(stages, rows.unionAll(rows))
    assert seen == [(50, False), (50, False)]
    assert len(model.stages) == 4 and model.transform(rows).count() == 50


def test_models_learn_and_tune(spark):
    from pyspark.ml.classification import RandomForestClassifier

    train, test = points(spark, 400, 1, 3.0), points(spark, 200, 2, 3.0)
    model = M.logistic_regression(iterations=20).fit(train)
    result = E.auc(model.transform(test).select(F.lit("m").alias("model"), F.col("emi_eligibility").alias("label"),
                                                M.probability().alias("score"))).first()
    assert result["auc"] > 0.9
    assert [n for n, _ in M.importances(model, ["a", "b"], 1)] == ["a"]
    forest = RandomForestClassifier(labelCol="emi_eligibility", weightCol=M.WEIGHT, numTrees=3, seed=1)
    best, settings, score = M.tune(train, forest, {"maxDepth": [2, 3]}, trials=2, folds=2, sample=100)
    assert settings["maxDepth"] in (2, 3) and score > 0.8
    assert M.class_weights(train)[0] == pytest.approx(400 / (2 * train.filter("emi_eligibility = 0").count()))


def test_alias_texts(spark):
    from lendframe.operators import evaluation

    assert evaluation.parse_alias("models:/emi@x@champion") == ("emi@x", "champion")
    for bad in ("models:/emi", "emi@champion", "models:/@a", "models:/a@"):
        with pytest.raises(ValueError):
            evaluation.parse_alias(bad)
    rows = spark.createDataFrame([("emi", "champion", 1, 10), ("emi", "champion", 3, 20), ("emi", "old", 1, 30)],
                                 "registered_name string, alias string, version int, assigned_at int")
    assert evaluation.resolve_alias(rows, "models:/emi@champion") == 3 and evaluation.resolve_alias(rows, "models:/no@champion") is None


def test_settings_are_drawn_without_repetition():
    from pyspark.ml.regression import GBTRegressor

    boosted = GBTRegressor()
    ranges = {"maxDepth": [2, 3, 4], "stepSize": [0.1, 0.2]}
    drawn = M.draw_settings(boosted, ranges, 6)
    assert len({tuple(sorted((p.name, v) for p, v in d.items())) for d in drawn}) == 6
    assert len(M.draw_settings(boosted, ranges, 50)) == 6
    assert drawn[:3] == M.draw_settings(boosted, ranges, 3)


def test_boosting_stops_early(spark):
    """Nothing is to be learned beyond one split, so the marked rows soon gain nothing."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rows = spark.range(600).selectExpr("id AS application_id", "CAST(id % 2 AS DOUBLE) AS a", "10.0 * (id % 2) + pmod(hash(id), 100) / 100.0 AS y")
    data = M.with_validation(VectorAssembler(inputCols=["a"], outputCol="features").transform(rows), share=0.3).cache()
    marked = data.filter(M.VALIDATION).count()
    assert 120 < marked < 240
    model = M.early_stopped(GBTRegressor(labelCol="y", maxDepth=2, seed=1), rounds=40).fit(data)
    assert model.getNumTrees < 10
    assert GBTRegressor(labelCol="y", maxDepth=2, maxIter=12, seed=1).fit(data).getNumTrees == 12
    data.unpersist()
