"""Overlap between train and test rows, and the shuffled-label check."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.operators.evaluation import auc
from lendframe.operators.sampling import permute_labels
from lendframe.plans.training import logistic_regression
from lendframe.staging import VECTORS_PER_FILE, discard, release, staged


def overlap(train: DataFrame, test: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pairs of equal rows (null equals null), without making the pairs.

    Both sides are counted per distinct row in one shuffle; a kind of row present
    n1 and n2 times stands for n1 * n2 pairs.
    """
    columns = columns or [c for c in train.columns if c in test.columns]
    both = train.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        test.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    kinds = both.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    pairs = F.coalesce(F.sum(F.col("_a") * F.col("_b")), F.lit(0))
    out = kinds.agg(pairs.alias("overlap_rows"),
                    F.coalesce(F.sum("_a"), F.lit(0)).alias("train_rows"),
                    F.coalesce(F.sum("_b"), F.lit(0)).alias("test_rows"))
    return out.withColumn("cols_compared", F.lit(len(columns))).withColumn(
        "passed", F.col("overlap_rows") == 0).withColumn("verdict", F.when(
            F.col("passed"), "PASS").otherwise("FAIL"))


def shuffled_target(train: DataFrame, test: DataFrame, label: str = S.TARGET_CLASS,
                    features: str = "features", runs: int = 5, tolerance: float = 0.05,
                    seed: int = 42, iterations: int = 500) -> DataFrame:
    """AUC on the true test labels of models fitted to permuted train labels.

    Labels are dealt to the numbers of rows; the vectors meet the labels of all runs in one join.
    """
    rows = staged(train.select("application_id", label, features).withColumn("_row", F.monotonically_increasing_id()),
                  "labelled", rows_per_file=VECTORS_PER_FILE)
    dealt = None
    for run in range(runs):
        one = permute_labels(rows.select("_row", "application_id", label), label, seed + run).select(
            "_row", F.col(label).alias(f"_label{run}"))
        dealt = one if dealt is None else dealt.join(one, "_row")
    dealt = staged(rows.select("_row", features).join(dealt, "_row").drop("_row"), "permuted", rows_per_file=VECTORS_PER_FILE)
    discard(rows)
    del rows, one
    # what dealt the labels is larger than the vectors
    release(train.sparkSession)
    test, scored = test.select(label, features), None
    for run in range(runs):
        model = logistic_regression(label, features, iterations=iterations).fit(
            dealt.select(features, F.col(f"_label{run}").alias(label)))
        one = model.transform(test).select(
            F.lit(run).alias("run"), F.col(label).alias("label"),
            vector_to_array("probability")[1].alias("score"))
        scored = one if scored is None else scored.unionByName(one)
    discard(dealt)
    # one row per run: the inputs are read again by nothing after this
    per_run = [(r["run"], r["auc"]) for r in auc(scored, by=("run",)).select("run", "auc").collect()]
    found = train.sparkSession.createDataFrame(per_run, "run int, auc double")
    passed = F.abs(F.avg("auc") - 0.5) <= tolerance
    return found.agg(
        F.round(F.avg("auc"), 6).alias("mean_shuffled_auc"),
        F.round(F.stddev_pop("auc"), 6).alias("std"), F.count(F.lit(1)).alias("n_runs"),
        F.transform(F.array_sort(F.collect_list(F.struct("run", "auc"))), lambda x: F.round(x["auc"], 6)).alias("all_runs"),
        F.lit(0.5).alias("expected"), F.lit(float(tolerance)).alias("tolerance"), passed.alias("passed"),
        F.when(passed, "PASS").otherwise("FAIL").alias("verdict"))
