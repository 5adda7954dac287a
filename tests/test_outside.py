"""Outside models on workers: columns by the model's own names, loaded once a worker."""

import os
import pickle

import numpy as np
import pandas as pd
import pytest

from lendframe import schema as S
from lendframe.plans import outside
from lendframe.staging import staging_path


class Counting:
    """Says in which process it was unpickled, and how often that was."""

    loads = 0
    feature_name_ = ["a", "kind_x"]

    def __setstate__(self, state):
        type(self).loads += 1

    def __getstate__(self):
        return {"n": 1}

    def predict(self, x):
        return np.full(len(x), float(type(self).loads))

    def predict_proba(self, x):
        return np.column_stack([np.zeros(len(x)), np.full(len(x), float(os.getpid()))])


def saved(spark, model):
    path = staging_path(spark, "model")
    outside.save_model(spark, model, path)
    return outside.load_model(spark, path)


def test_loaded_once_a_worker(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    raw = cloudpickle.dumps(Counting())
    model = outside.SavedModel(spark, raw, "counting")
    rows = spark.range(4000, numPartitions=16).selectExpr("id", "id * 1.0 AS a", "'x' AS kind")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        found = outside.applied(rows, {"pid": (model, outside.probability), "loads": (model, outside.amount)}, keep=["id"]).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == 4000 and found.id.nunique() == 4000
    # 16 tasks of five batches each, on no more than a few workers
    assert found.pid.nunique() <= 8
    assert (found.loads == 1).all()


def test_columns_follow_the_contract(spark):
    rows = spark.createDataFrame(
        [(1, 2.0, "Male", "Rented", True, 7.0), (2, float("nan"), None, "Own", False, float("inf")), (3, None, "Female", "Rented", None, -1.0)],
        "application_id long, age double, gender string, house_type string, credit_score_missing boolean, extra double")
    names = ["house_type_Rented", "age", "gender_Male", "never_seen", "credit_score_missing", "extra"]
    x = rows.select(*outside.contract_columns(rows, names)).toPandas().to_numpy()
    assert x.tolist() == [[1, 2, 1, 0, 1, 7], [0, 0, 0, 0, 0, 0], [1, 0, 0, 0, 0, -1]]
    assert outside.missing_columns(rows, names) == ["never_seen"]


def test_scores_equal_the_model_applied_to_the_whole_table(spark, sample):
    weights = {"credit_score": 0.01, "gender_Male": 0.5, "house_type_Rented": -0.25, "absent": 9.0}
    classifier, regressor = outside.LinearModel(weights, -6.0), outside.LinearModel({"bank_balance": 0.05})
    from lendframe.plans.cleaner import clean

    rows = clean(sample)
    found = outside.score_outside(rows, saved(spark, classifier), saved(spark, regressor)).toPandas().set_index("application_id").sort_index()
    table = rows.toPandas().set_index("application_id").sort_index()
    x = pd.DataFrame({"credit_score": table.credit_score, "gender_Male": (table.gender == "Male") * 1.0,
                      "house_type_Rented": (table.house_type == "Rented") * 1.0, "absent": 0.0})
    assert np.allclose(found.clf_proba, classifier.predict_proba(x)[:, 1].round(6), atol=1e-6)
    assert np.allclose(found.predicted_emi, np.clip(table.bank_balance * 0.05, S.EMI_MIN, S.EMI_MAX), atol=0.01)
    assert len(found) == len(table)


def test_empty_table_unnamed_columns_and_broken_files(spark, sample):
    from lendframe.plans.cleaner import clean

    model = saved(spark, outside.LinearModel({"age": 1.0}))
    none = clean(sample).filter("false")
    assert outside.score_outside(none, model, model).collect() == []
    with pytest.raises(ValueError, match="names no columns"):
        outside.column_names(object())
    path = staging_path(spark, "model")
    spark.createDataFrame([("x", bytearray(pickle.dumps(1)))], "digest string, model binary").write.parquet(path)
    with pytest.raises(ValueError, match="no whole model"):
        outside.load_model(spark, path)
