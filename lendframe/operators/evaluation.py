"""Classifier and regressor metrics, ROC, champions, registry and gates."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.functions import expr as X
from lendframe.operators.ranks import running_counts
from lendframe.operators.scoring import ZONES


def score_counts(scored: DataFrame, by=("model",), label="label", score="score") -> DataFrame:
    """Positives and negatives per distinct score: all that ROC and AUC need."""
    return scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(
        *by, score).agg(F.count_if(F.col(label) == 1).alias("pos"),
                        F.count_if(F.col(label) == 0).alias("neg"))


def auc(scored: DataFrame, by=("model",), label="label", score="score") -> DataFrame:
    """Area under ROC by ranks; tied scores count half."""
    by = list(by)
    run = running_counts(score_counts(scored, by, label, score), by, score, ["pos", "neg"])
    won = F.col("pos") * (F.col("neg_upto") - F.col("neg") + F.col("neg") / 2)
    return run.groupBy(*by).agg(
        (F.sum(won) / F.nullif(F.max("pos_total") * F.max("neg_total").cast("double"), F.lit(0.0)))
        .alias("auc"))


def roc_points(scored: DataFrame, by=("model",), label="label", score="score") -> DataFrame:
    """False and true positive rate at each distinct threshold."""
    by = list(by)
    run = running_counts(score_counts(scored, by, label, score), by, score, ["pos", "neg"])
    above = {c: F.col(f"{c}_total") - F.col(f"{c}_upto") + F.col(c) for c in ("pos", "neg")}
    return run.select(*by, F.col(score).alias("threshold"),
                      F.round(above["neg"] / F.nullif(F.col("neg_total"), F.lit(0)), 6).alias("fpr"),
                      F.round(above["pos"] / F.nullif(F.col("pos_total"), F.lit(0)), 6).alias("tpr"))


def _cells(label="label", score="score", threshold=0.5) -> dict[str, Column]:
    hit, pos = F.col(score) >= threshold, F.col(label) == 1
    return {"tp": hit & pos, "fp": hit & ~pos, "fn": ~hit & pos, "tn": ~hit & ~pos}


def _or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def eval_classifier(scored: DataFrame, by=("model",), label="label", score="score") -> DataFrame:
    """AUC, F1, precision, recall, accuracy, confusion cells and zone counts per model."""
    by = list(by)
    rows = scored.filter(F.col(label).isNotNull())
    counts = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(t).alias(c) for c, t in _cells(label, score).items()],
        *[F.count_if(X.zone(score) == z).alias(z) for z in ZONES])
    precision = _or_zero(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _or_zero(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _or_zero(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    # one row of counts and one of AUC per model, laid side by side
    both = counts.unionByName(auc(rows, by, label, score), allowMissingColumns=True)
    parts = [c for c in both.columns if c not in by]
    return both.groupBy(*by).agg(*[F.max(c).alias(c) for c in parts]).select(
        *by, "n", F.round("auc", 6).alias("auc"), F.round(f1, 6).alias("f1"),
        F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"),
        F.round(_or_zero(F.col("tp") + F.col("tn"), F.col("n")), 6).alias("accuracy"),
        "tp", "fp", "fn", "tn", *ZONES)


def confusion(scored: DataFrame, label="label", score="score") -> DataFrame:
    counts = scored.groupBy(
        F.col(label).alias("actual"), (F.col(score) >= 0.5).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("row_pct", X.share(
        F.col("rows"), F.sum("rows").over(Window.partitionBy("actual")), 4))


def eval_regressor(scored: DataFrame, by=("model",), actual="actual", predicted="predicted") -> DataFrame:
    """RMSE, MAE, R2 and MAPE. R2 takes its spread from the variance, in one pass."""
    by = list(by)
    miss = F.col(actual) - F.col(predicted)
    rows = scored.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(miss * miss).alias("_mse"),
        F.avg(F.abs(miss)).alias("_mae"), F.var_pop(actual).alias("_var"),
        F.avg(F.abs(X.ratio(miss, F.col(actual)))).alias("_mape"))
    r2 = 1 - X.ratio("_mse", "_var")
    return sums.select(
        *by, "n", F.round(F.sqrt("_mse"), 4).alias("rmse"), F.round("_mae", 4).alias("mae"),
        F.round(r2, 6).alias("r2"), F.round(F.col("_mape") * 100, 4).alias("mape"),
        ((r2 > 0.75) & (F.col("_mape") * 100 < 20)).alias("passed"))


def naive_baseline(df: DataFrame, label: str = S.TARGET_CLASS) -> DataFrame:
    """Percentages reached by always predicting the majority class."""
    one = df.agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    total = F.col("_p") + F.col("_n")
    up = F.col("_p") > F.col("_n")
    precision = F.when(up, X.ratio("_p", total)).otherwise(F.lit(0.0))
    recall = F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))
    f1 = F.coalesce(X.ratio(2 * precision * recall, precision + recall), F.lit(0.0))
    return one.select(
        F.round(X.ratio(F.greatest("_p", "_n"), total) * 100, 4).alias("accuracy"),
        F.round(f1 * 100, 4).alias("f1"), F.round(precision * 100, 4).alias("precision"),
        F.round(recall * 100, 4).alias("recall"))


# --- runs and registry ------------------------------------------------------
# --- fixed values: order of preference among equally good classifiers -------
SPEED_PREFERENCE = [
    "lightgbm", "xgboost", "random_forest", "extra_trees", "logistic_regression",
]


def speed_rank(preference: list[str], name: str = "model") -> Column:
    """Place in the preference list; names outside it come after all others."""
    rank = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col(name))
    return F.when(rank > 0, rank).otherwise(F.lit(100))


def champion_classifier(runs: DataFrame, preference: list[str]) -> DataFrame:
    best = F.struct("auc", "f1", (-speed_rank(preference)).alias("p"))
    return runs.agg(F.max_by("model", best).alias("model"), F.max_by("auc", best).alias("auc"),
                    F.max_by("f1", best).alias("f1"))


def champion_regressor(runs: DataFrame) -> DataFrame:
    best = F.struct("rmse", "model")
    return runs.agg(F.min_by("model", best).alias("model"), F.min("rmse").alias("rmse"))


def leaderboard(runs: DataFrame, metric: str, ascending: bool = False) -> DataFrame:
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    return runs.select("model", metric).orderBy(order, "model")


def threshold_gates(classifier: DataFrame, amounts: DataFrame, min_auc: float = 0.9763,
                    max_rmse: float = 2000.0) -> DataFrame:
    """Promotion checks: AUC floor, RMSE ceiling, amounts in range, all zones seen.

    ``classifier`` holds one evaluation row, ``amounts`` actual and predicted amounts.
    """
    seen = classifier.select(
        (F.col("auc") >= min_auc).alias("auc_ok"),
        ((F.col("auto_approve") > 0) & (F.col("human_review") > 0) & (F.col("auto_reject") > 0))
        .alias("zones_ok"))
    miss = F.col("actual") - F.col("predicted")
    sane = amounts.agg(
        (F.sqrt(F.avg(miss * miss)) <= max_rmse).alias("rmse_ok"),
        F.bool_and(F.col("predicted").between(S.EMI_MIN, S.EMI_MAX)).alias("emi_ok"),
    )
    gates = ["auc_ok", "zones_ok", "rmse_ok", "emi_ok"]
    # two one-row frames side by side
    both = seen.unionByName(sane, allowMissingColumns=True).agg(*[F.max(g).alias(g) for g in gates])
    return both.select(
        *gates, (F.col("auc_ok") & F.col("zones_ok") & F.col("rmse_ok") & F.col("emi_ok")).alias("promote"))


def register_versions(runs: DataFrame, registered: str, order: str) -> DataFrame:
    """A version row per run in the order given; a registry holds few rows per name."""
    return runs.withColumn("registered_name", F.lit(registered)).withColumn(
        "version", F.row_number().over(Window.partitionBy("registered_name").orderBy(order)))


def parse_alias(uri: str) -> tuple[str, str]:
    """``models:/NAME@ALIAS`` to (name, alias); names may hold the sign themselves."""
    name, at, alias = uri.removeprefix("models:/").rpartition("@")
    if not uri.startswith("models:/") or not at or not name or not alias:
        raise ValueError(f"not a model alias: {uri}")
    return name, alias


def resolve_alias(assignments: DataFrame, uri: str) -> int | None:
    """The version that an alias text points to now."""
    name, alias = parse_alias(uri)
    found = current_aliases(assignments.filter((F.col("registered_name") == name) & (F.col("alias") == alias))).first()
    return found["version"] if found else None


def current_aliases(assignments: DataFrame) -> DataFrame:
    """The version each alias points to: its latest assignment. Rollback appends one."""
    return assignments.groupBy("registered_name", "alias").agg(
        F.max_by("version", "assigned_at").alias("version"))
