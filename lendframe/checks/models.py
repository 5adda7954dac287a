"""Evaluation, champions, registry, training, leakage and drift."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.checks import sql_parts as Q
from lendframe.checks.registry import check
from lendframe.operators import drift, evaluation as E, leakage, profiling, scoring
from lendframe.plans import training as M
from lendframe.staging import VECTORS_PER_FILE, staged, staging_path

# runs are rule sets evaluated on the applications, so the table grows with them
_RULE_SETS = {
    "strict": (700, 0.5, 30000), "standard": (650, 0.6, 20000), "loose": (600, 0.8, 15000),
    "credit_only": (650, 2.0, 0),
}
_PREFERENCE = ["loose", "standard", "credit_only", "strict"]
_AMOUNTS = {
    "salary_share": ("monthly_salary * 0.3", lambda: F.col("monthly_salary") * 0.3),
    "requested": ("requested_amount / requested_tenure",
                  lambda: F.try_divide("requested_amount", "requested_tenure")),
    "disposable": ("greatest(monthly_salary * 0.5 - current_emi_amount, 500)",
                   lambda: F.greatest(F.col("monthly_salary") * 0.5 - F.col("current_emi_amount"), F.lit(500.0))),
}

_SCORES = "scores AS (" + Q.union_all([
    f"SELECT '{name}' AS model, application_id, emi_eligibility AS label, CAST({Q.rule_probability(*limits)} AS DOUBLE) AS score FROM clean"
    for name, limits in _RULE_SETS.items()]) + ")"
_AUC = """aucs AS (SELECT model, (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
  / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc
  FROM (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
    + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS rk FROM scores) GROUP BY model)"""
_EVAL = f"""evals AS (SELECT model, n, round(auc, 6) AS auc, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round((tp + tn) / n, 6) AS accuracy, tp, fp, fn, tn, auto_approve, human_review, auto_reject
  FROM (SELECT model, count(*) AS n, count(*) FILTER (score >= .5 AND label = 1) AS tp,
    count(*) FILTER (score >= .5 AND label = 0) AS fp, count(*) FILTER (score < .5 AND label = 1) AS fn,
    count(*) FILTER (score < .5 AND label = 0) AS tn, {', '.join(
        f"count(*) FILTER ({Q.zone('score')} = '{z}') AS {z}" for z in scoring.ZONES)}
    FROM scores GROUP BY model) JOIN aucs USING (model))"""
_AMOUNT_ROWS = "amounts AS (" + Q.union_all([
    f"SELECT '{name}' AS model, application_id, max_monthly_emi AS actual, {sql} AS predicted FROM clean"
    for name, (sql, _) in _AMOUNTS.items()]) + ")"
_REG = """regs AS (SELECT model, count(*) AS n, round(sqrt(avg(pow(actual - predicted, 2))), 4) AS rmse,
  round(avg(abs(actual - predicted)), 4) AS mae, round(1 - avg(pow(actual - predicted, 2)) / var_pop(actual), 6) AS r2,
  round(avg(abs((actual - predicted) / nullif(actual, 0))) * 100, 4) AS mape,
  1 - avg(pow(actual - predicted, 2)) / var_pop(actual) > 0.75 AND
    avg(abs((actual - predicted) / nullif(actual, 0))) * 100 < 20 AS passed
  FROM amounts WHERE predicted IS NOT NULL GROUP BY model)"""


def _scores(t) -> DataFrame:
    cells = F.array(*[
        F.struct(F.lit(name).alias("model"), scoring.rule_probability(
            credit_floor=c, expense_ceiling=e, salary_floor=s).alias("score"))
        for name, (c, e, s) in _RULE_SETS.items()])
    return t.clean.select("application_id", F.col(S.TARGET_CLASS).alias("label"), F.inline(cells))


def _amounts(t) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(name).alias("model"), build().alias("predicted"))
                      for name, (_, build) in _AMOUNTS.items()])
    return t.clean.select("application_id", F.col(S.TARGET_AMOUNT).alias("actual"), F.inline(cells))


@check("auc_rank", Q.query("clean", "SELECT model, round(auc, 8) AS auc FROM aucs", _SCORES, _AUC))
def auc_rank(t):
    return E.auc(_scores(t)).withColumn("auc", F.round("auc", 8))


@check("auc_continuous", Q.query("clean", "SELECT model, round(auc, 8) AS auc FROM aucs", """
scores AS (SELECT 'salary' AS model, emi_eligibility AS label, monthly_salary AS score FROM clean
  UNION ALL SELECT 'credit', emi_eligibility, credit_score FROM clean)""", _AUC))
def auc_continuous(t):
    rows = t.clean.select(F.col(S.TARGET_CLASS).alias("label"), F.col("monthly_salary").alias("salary"),
                          F.col("credit_score").alias("credit")).unpivot(["label"], ["salary", "credit"], "model", "score")
    return E.auc(rows).withColumn("auc", F.round("auc", 8))


@check("roc_points", Q.query("clean", """
SELECT model, threshold, round(sum(neg) OVER w / sum(neg) OVER p, 6) AS fpr, round(sum(pos) OVER w / sum(pos) OVER p, 6) AS tpr
FROM (SELECT 'credit' AS model, credit_score AS threshold, count(*) FILTER (emi_eligibility = 1) AS pos,
  count(*) FILTER (emi_eligibility = 0) AS neg FROM clean GROUP BY credit_score)
WINDOW w AS (PARTITION BY model ORDER BY threshold DESC), p AS (PARTITION BY model)"""))
def roc_points(t):
    return E.roc_points(t.clean.select(F.lit("credit").alias("model"), F.col(S.TARGET_CLASS).alias("label"),
                                       F.col("credit_score").alias("score")))


@check("eval_classifier", Q.query("clean", "SELECT * FROM evals", _SCORES, _AUC, _EVAL))
def eval_classifier(t):
    return E.eval_classifier(_scores(t))


@check("confusion", Q.query("clean", """
SELECT label AS actual, CAST(score >= 0.5 AS INTEGER) AS predicted, count(*) AS "rows",
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY label), 4) AS row_pct
FROM scores WHERE model = 'standard' GROUP BY 1, 2""", _SCORES))
def confusion(t):
    return E.confusion(_scores(t).filter("model = 'standard'"))


@check("eval_regressor", Q.query("clean", "SELECT * FROM regs", _AMOUNT_ROWS, _REG))
def eval_regressor(t):
    return E.eval_regressor(_amounts(t))


_RESIDUALS = "residual AS (SELECT actual - predicted AS x FROM amounts WHERE model = 'salary_share')"


@check("residuals", Q.query("clean", """
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / 60), 6) AS from_value,
  round(lo + (b.bin + 1) * ((hi - lo) / 60), 6) AS to_value, count(r.x) AS "rows"
FROM range(60) b(bin) CROSS JOIN (SELECT min(x) AS lo, max(x) AS hi FROM residual) e
LEFT JOIN residual r ON least(floor((r.x - lo) / ((hi - lo) / 60)), 59) = b.bin
GROUP BY b.bin, lo, hi""", _AMOUNT_ROWS, _RESIDUALS))
def residuals(t):
    rows = _amounts(t).filter("model = 'salary_share'").select((F.col("actual") - F.col("predicted")).alias("x"))
    return profiling.histogram(rows, "x", 60)


@check("champion_classifier", Q.query("clean", f"""
SELECT model, auc, f1 FROM evals ORDER BY auc DESC, f1 DESC, list_position({_PREFERENCE}, model) LIMIT 1""",
                                      _SCORES, _AUC, _EVAL))
def champion_classifier(t):
    return E.champion_classifier(E.eval_classifier(_scores(t)), _PREFERENCE)


@check("champion_regressor", Q.query("clean", "SELECT model, rmse FROM regs ORDER BY rmse, model LIMIT 1", _AMOUNT_ROWS, _REG))
def champion_regressor(t):
    return E.champion_regressor(E.eval_regressor(_amounts(t)))


@check("run_leaderboard", Q.query("clean", "SELECT model, auc FROM evals ORDER BY auc DESC, model", _SCORES, _AUC, _EVAL))
def run_leaderboard(t):
    return E.leaderboard(E.eval_classifier(_scores(t)), "auc")


@check("experiment_runs", Q.query("clean", """
SELECT model, CAST(credit AS VARCHAR) AS credit_floor, round(auc, 6) AS auc, CAST(n AS VARCHAR) AS train_rows
FROM evals JOIN (VALUES """ + ", ".join(f"('{m}', {c})" for m, (c, _, _) in _RULE_SETS.items()) + """) v(model, credit)
USING (model)""", _SCORES, _AUC, _EVAL))
def experiment_runs(t):
    """Runs with metrics, parameters and tags as maps; null parameters are dropped."""
    floors = F.create_map(*[F.lit(x) for m, (c, _, _) in _RULE_SETS.items() for x in (m, c)])
    runs = E.eval_classifier(_scores(t)).select(
        "model", F.create_map(F.lit("auc"), "auc", F.lit("f1"), "f1").alias("metrics"),
        F.map_filter(F.transform_values(F.create_map(
            F.lit("credit_floor"), floors[F.col("model")], F.lit("cv_folds"), F.lit(None).cast("int")),
            lambda k, v: v.cast("string")), lambda k, v: v.isNotNull()).alias("params"),
        F.create_map(F.lit("train_rows"), F.col("n").cast("string")).alias("tags"))
    return runs.select("model", F.col("params")["credit_floor"].alias("credit_floor"),
                       F.col("metrics")["auc"].alias("auc"), F.col("tags")["train_rows"].alias("train_rows"))


# versions are registered worst first; the alias moves to each, then back by one
_VERSIONS = """versions AS (SELECT model, row_number() OVER (ORDER BY auc, model) AS version, count(*) OVER () AS n FROM evals),
assigned AS (SELECT version, version AS assigned_at FROM versions
  UNION ALL SELECT version, n + 1 FROM versions WHERE version = n - 1)"""


@check("register_champion", Q.query("clean", """
SELECT 'emi_eligibility_classifier' AS registered_name, 'champion' AS alias, model, CAST(v.version AS INTEGER) AS version
FROM versions v JOIN (SELECT arg_max(version, assigned_at) AS version FROM assigned) a ON v.version = a.version""",
                                    _SCORES, _AUC, _EVAL, _VERSIONS))
def register_champion(t):
    runs = E.eval_classifier(_scores(t)).select("model", "auc", F.struct("auc", "model").alias("order"))
    versions = staged(E.register_versions(runs, "emi_eligibility_classifier", "order").drop("order"), "registry")
    moved = versions.select("registered_name", F.lit("champion").alias("alias"), "version",
                            F.col("version").alias("assigned_at"))
    newest = versions.agg(F.max("version")).first()[0]
    back = moved.filter(F.col("version") == newest - 1).withColumn("assigned_at", F.lit(newest + 1))
    return E.current_aliases(moved.unionByName(back)).join(
        versions.select("registered_name", "version", "model"), ["registered_name", "version"])


@check("threshold_gates", Q.query("clean", """
SELECT *, auc_ok AND zones_ok AND rmse_ok AND emi_ok AS promote FROM (
  SELECT auc >= 0.9763 AS auc_ok, auto_approve > 0 AND human_review > 0 AND auto_reject > 0 AS zones_ok
  FROM evals WHERE model = 'standard') CROSS JOIN (
  SELECT sqrt(avg(pow(actual - predicted, 2))) <= 2000 AS rmse_ok, bool_and(predicted BETWEEN 500 AND 34750) AS emi_ok
  FROM amounts WHERE model = 'salary_share')""", _SCORES, _AUC, _EVAL, _AMOUNT_ROWS))
def threshold_gates(t):
    return E.threshold_gates(E.eval_classifier(_scores(t)).filter("model = 'standard'"),
                             _amounts(t).filter("model = 'salary_share'"))


# --- drift ------------------------------------------------------------------
_SHIFTED = """reference_rows AS (SELECT * FROM features WHERE application_id % 2 = 0),
current_rows AS (SELECT * REPLACE (requested_amount * 1.5 AS requested_amount) FROM features WHERE application_id % 2 = 1)"""


def _halves(t):
    reference = t.features.filter("application_id % 2 = 0")
    current = t.features.filter("application_id % 2 = 1").withColumn(
        "requested_amount", F.col("requested_amount") * 1.5)
    return reference, current


def _side_counts(c):
    return f"""(SELECT v, sum(r) AS r, sum(c) AS c FROM (SELECT {c} AS v, 1 AS r, 0 AS c FROM reference_rows
    UNION ALL SELECT {c}, 0, 1 FROM current_rows) WHERE v IS NOT NULL GROUP BY v)"""


def _half_js(x):
    return f"CASE WHEN {x} > 0 THEN {x} * ln({x} / ((pp + qq) / 2)) ELSE 0 END"


_JS = f"({_half_js('pp')} + {_half_js('qq')})"


def _numeric_drift_sql(c):
    return f"""SELECT "column", 'num' AS kind, CASE WHEN n_values <= 5 THEN 'jensenshannon' ELSE 'wasserstein' END AS test,
  n_values, round(CASE WHEN n_values <= 5 THEN js ELSE w END, 6) AS score FROM (
  SELECT '{c}' AS "column", count(*) AS n_values, sqrt(greatest(sum({_JS}) / 2, 0)) AS js,
    coalesce(sum(abs(rc / rt - cc / ct) * (nxt - v)), 0) / greatest((SELECT stddev_pop({c}) FROM reference_rows), 0.001) AS w
  FROM (SELECT v, sum(r) OVER (ORDER BY v) AS rc, sum(c) OVER (ORDER BY v) AS cc, sum(r) OVER () AS rt, sum(c) OVER () AS ct,
      lead(v) OVER (ORDER BY v) AS nxt, r / sum(r) OVER () AS pp, c / sum(c) OVER () AS qq FROM {_side_counts(c)}))"""


def _category_drift_sql(c):
    return f"""SELECT '{c}' AS "column", 'cat' AS kind, 'jensenshannon' AS test, count(*) AS n_values,
  round(sqrt(greatest(sum({_JS}) / 2, 0)), 6) AS score
  FROM (SELECT r / sum(r) OVER () AS pp, c / sum(c) OVER () AS qq FROM {_side_counts(c)})"""


def _drift_sql(columns):
    """Distances by plain window functions over every value of every column."""
    parts = [_numeric_drift_sql(c) if c in S.NUMERIC_COLUMNS or c in S.ENGINEERED_NUMERIC
             else _category_drift_sql(c) for c in columns]
    return ("SELECT *, CAST(0.1 AS DOUBLE) AS threshold, score >= 0.1 AS drifted FROM ("
            + Q.union_all(parts) + ")")


@check("drift_column", Q.query("features", _drift_sql(S.REQUEST_COLUMNS), _SHIFTED))
def drift_column(t):
    return drift.drift_columns(*_halves(t), S.REQUEST_COLUMNS)


@check("drift_stored_profile", Q.query("features", _drift_sql(S.REQUEST_COLUMNS), _SHIFTED))
def drift_stored_profile(t):
    """The reference as a table of counts, written in two parts, merged and read back; the night scans its own batch only."""
    reference, current = _halves(t)
    early = F.col("application_id") % 3 == 0
    paths = [staging_path(t.spark, "profile") for _ in range(2)]
    for rows, path in zip((reference.filter(early), reference.filter(~early)), paths):
        drift.Profile.of(rows, S.REQUEST_COLUMNS).write(path)
    first, second = (drift.Profile.read(t.spark, path) for path in paths)
    return drift.drift_columns(first.merged(second), current, S.REQUEST_COLUMNS)


_SUMMARY = """SELECT round(avg(CAST(drifted AS INTEGER)), 4) AS share_drifted,
  coalesce(string_agg("column", ',' ORDER BY "column") FILTER (drifted), '') AS drifted_columns,
  avg(CAST(drifted AS INTEGER)) >= 0.5 AS drift_detected"""


@check("drift_dataset", Q.query("features", f"{_SUMMARY} FROM ({_drift_sql(S.REQUEST_COLUMNS)})", _SHIFTED))
def drift_dataset(t):
    summary = drift.drift_summary(drift.drift_columns(*_halves(t), S.REQUEST_COLUMNS))
    return summary.withColumn("drifted_columns", F.array_join("drifted_columns", ","))


@check("drift_layers", Q.query("features", f"""
{_SUMMARY}, 1 AS layer FROM ({_drift_sql(S.REQUEST_COLUMNS)})
UNION ALL {_SUMMARY}, 2 AS layer FROM ({_drift_sql(S.DRIFT_ENGINEERED)})""", _SHIFTED))
def drift_layers(t):
    return drift.drift_layers(*_halves(t)).withColumn("drifted_columns", F.array_join("drifted_columns", ","))


@check("drift_guard", Q.query("features", f"""
SELECT l1.drift_detected OR l2.drift_detected AS drift_detected, l1.drift_detected AS layer1_drift,
  l1.drifted_columns AS layer1_columns, l2.drift_detected AS layer2_drift, l2.drifted_columns AS layer2_columns,
  FALSE AS skipped, '' AS skip_reason
FROM ({_SUMMARY} FROM ({_drift_sql(S.REQUEST_COLUMNS)})) l1 CROSS JOIN ({_SUMMARY} FROM ({_drift_sql(S.DRIFT_ENGINEERED)})) l2
UNION ALL SELECT FALSE, FALSE, '', FALSE, '', TRUE, 'missing'""", _SHIFTED))
def drift_guard(t):
    """One normal report, and one whose current table is missing."""
    reference, current = _halves(t)
    fine = drift.guarded_drift(t.spark, lambda: reference, lambda: current)
    gone = drift.guarded_drift(
        t.spark, lambda: reference, lambda: t.spark.read.parquet(staging_path(t.spark, "absent")))
    both = fine.unionByName(gone.withColumn("skip_reason", F.lit("missing")))
    return both.withColumns({c: F.array_join(c, ",") for c in ("layer1_columns", "layer2_columns")})


@check("drift_null_column", Q.query("features", f"""{_drift_sql(["age", "bank_balance", "gender"])}
UNION ALL SELECT 'credit_score', 'num', 'wasserstein', count(DISTINCT credit_score), NULL, CAST(0.1 AS DOUBLE), TRUE FROM reference_rows
UNION ALL SELECT 'house_type', 'cat', 'jensenshannon', count(DISTINCT house_type), NULL, CAST(0.1 AS DOUBLE), TRUE FROM reference_rows
""", _SHIFTED))
def drift_null_column(t):
    """Two columns without any value in the current table."""
    reference, current = _halves(t)
    current = current.withColumns({c: F.lit(None).cast(current.schema[c].dataType) for c in ("credit_score", "house_type")})
    return drift.drift_columns(reference, current, ["age", "bank_balance", "gender", "credit_score", "house_type"])


@check("drift_no_layers", Q.query("features", """
SELECT FALSE AS drift_detected, FALSE AS layer1_drift, '' AS layer1_columns, FALSE AS layer2_drift, '' AS layer2_columns,
  FALSE AS skipped, '' AS skip_reason, (SELECT count(*) FROM reference_rows) AS rows_read""", _SHIFTED))
def drift_no_layers(t):
    """Too few shared columns for either layer: no drift, not skipped."""
    reference, current = (side.select("age", "gender", "credit_score") for side in _halves(t))
    report = drift.guarded_drift(t.spark, lambda: reference, lambda: current)
    return report.withColumns({c: F.array_join(c, ",") for c in ("layer1_columns", "layer2_columns")}).withColumn(
        "rows_read", F.lit(reference.count()).cast("long"))


@check("ecdf_distance", Q.query("features", """
SELECT round(max(abs(rc / rt - cc / ct)), 8) AS ks, round(sum(abs(rc / rt - cc / ct) * (nxt - v)), 4) AS wasserstein
FROM (SELECT v, sum(r) OVER (ORDER BY v) AS rc, sum(c) OVER (ORDER BY v) AS cc, sum(r) OVER () AS rt, sum(c) OVER () AS ct,
    lead(v) OVER (ORDER BY v) AS nxt
  FROM (SELECT v, sum(r) AS r, sum(c) AS c FROM (SELECT requested_amount AS v, 1 AS r, 0 AS c FROM reference_rows
    UNION ALL SELECT requested_amount, 0, 1 FROM current_rows) GROUP BY v))""", _SHIFTED))
def ecdf_distance(t):
    reference, current = _halves(t)
    stats = drift.numeric_distances(reference, current, ["requested_amount"])
    return stats.select(F.round("ks", 8).alias("ks"), F.round(
        F.col("wasserstein") * F.greatest("sd", F.lit(0.001)), 4).alias("wasserstein"))


@check("drift_small_reference")
def drift_small_reference(t):
    """The p-value tests: Kolmogorov-Smirnov, chi-square and two-share Z."""
    return drift.drift_columns(*_halves(t), [*S.REQUEST_COLUMNS, "credit_score_missing"],
                               large_reference=1 << 62)


_STATISTICS = [("bank_balance", True, False), ("age", True, False), ("credit_score_missing", True, True),
               ("gender", False, True), ("house_type", False, True), ("existing_loans", False, True)]


def _statistics_sql(c, number, few):
    share = "(r + c) / (rt + ct)"
    return f"""SELECT '{c}' AS "column", count(*) AS n_values,
  {'round(max(abs(rc / rt - cc / ct)), 8)' if number else 'CAST(NULL AS DOUBLE)'} AS ks,
  {"round(CAST(sum(CASE WHEN r > 0 THEN pow(c - r * ct / rt, 2) / (r * ct / rt) WHEN c > 0 THEN CAST('inf' AS DOUBLE) END) AS DOUBLE), 6)" if few else 'CAST(NULL AS DOUBLE)'} AS chi_square,
  CASE WHEN count(*) = 2 THEN round(coalesce(sqrt(sum(pow(r / rt - c / ct, 2)) / nullif((1 - sum(pow({share}, 2))) * (1 / any_value(rt) + 1 / any_value(ct)), 0)), 0), 6) END AS z
  FROM (SELECT r, c, sum(r) OVER (ORDER BY v) AS rc, sum(c) OVER (ORDER BY v) AS cc, sum(r) OVER () AS rt, sum(c) OVER () AS ct
    FROM {_side_counts(c)})"""


@check("drift_statistics", Q.query("features", Q.union_all([_statistics_sql(*x) for x in _STATISTICS]), _SHIFTED))
def drift_statistics(t):
    """Statistics of the small-reference tests."""
    return drift.drift_statistics(*_halves(t), [c for c, _, _ in _STATISTICS])


# --- models -----------------------------------------------------------------
def _classifier_rows(t, name, **settings) -> DataFrame:
    encoder, train, test = t.encoded
    model = M.CLASSIFIERS[name](**settings).fit(train)
    scored = model.transform(test).select(
        F.lit(name).alias("model"), F.col(S.TARGET_CLASS).alias("label"), M.probability().alias("score"))
    return E.eval_classifier(scored)


@check("train_logreg")
def train_logreg(t):
    return _classifier_rows(t, "logistic_regression")


@check("train_forest")
def train_forest(t):
    return _classifier_rows(t, "random_forest")


@check("train_boosted")
def train_boosted(t):
    return _classifier_rows(t, "boosted_trees")


def _regressor_rows(t, name, **settings) -> DataFrame:
    encoder, train, test = t.encoded
    model = M.REGRESSORS[name](**settings).fit(train)
    return E.eval_regressor(model.transform(test).select(
        F.lit(name).alias("model"), F.col(S.TARGET_AMOUNT).alias("actual"), F.col("prediction").alias("predicted")))


@check("train_forest_regressor")
def train_forest_regressor(t):
    return _regressor_rows(t, "random_forest")


@check("train_boosted_regressor")
def train_boosted_regressor(t):
    return _regressor_rows(t, "boosted_trees")


@check("tune")
def tune(t):
    from pyspark.ml.classification import RandomForestClassifier

    encoder, train, test = t.encoded
    forest = RandomForestClassifier(labelCol=S.TARGET_CLASS, weightCol=M.WEIGHT, numTrees=20, seed=42)
    model, settings, score = M.tune(train, forest, {"maxDepth": [3, 5, 7], "minInstancesPerNode": [1, 10, 50]},
                                    trials=3, folds=3)
    scored = model.transform(test).select(
        F.lit(",".join(f"{k}={v}" for k, v in sorted(settings.items()))).alias("model"),
        F.col(S.TARGET_CLASS).alias("label"), M.probability().alias("score"))
    return E.eval_classifier(scored).withColumn("cv_auc", F.lit(score))


@check("tune_logistic")
def tune_logistic(t):
    from pyspark.ml.classification import LogisticRegression

    _, train, test = t.encoded
    model, settings, score = M.tune(train, LogisticRegression(labelCol=S.TARGET_CLASS, weightCol=M.WEIGHT, maxIter=1000),
                                    {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]})
    scored = model.transform(test).select(
        F.lit(",".join(f"{k}={v}" for k, v in sorted(settings.items()))).alias("model"),
        F.col(S.TARGET_CLASS).alias("label"), M.probability().alias("score"))
    return E.eval_classifier(scored).withColumn("cv_auc", F.lit(score))


@check("tune_regressor")
def tune_regressor(t):
    """Compared on all rows, by the error of the amount."""
    _, train, test = t.encoded
    model, settings, score = M.tune(train, M.forest_regressor(), {"maxDepth": [4, 6, 8], "minInstancesPerNode": [1, 20]}, regression=True)
    return E.eval_regressor(model.transform(test).select(
        F.lit(",".join(f"{k}={v}" for k, v in sorted(settings.items()))).alias("model"),
        F.col(S.TARGET_AMOUNT).alias("actual"), F.col("prediction").alias("predicted"))).withColumn("cv_rmse", F.lit(score))


@check("save_load_pipeline", Q.query("clean", """
SELECT application_id, clf_proba, clf_label, conf_zone, predicted_emi, TRUE AS same_probability FROM scored""", Q.SCORED))
def save_load_pipeline(t):
    """Raw rows through two saved and loaded artefacts: cleaning and rules, whose scores are compared; and cleaning, features, encoding,
    class weights and a model, whose probabilities must be those of the model in memory."""
    from pyspark.ml import Pipeline, PipelineModel

    from lendframe.plans.cleaner import LoanCleaner
    from lendframe.plans.encoder import LoanEncoder
    from lendframe.plans.features import FeatureBuilder
    from lendframe.plans.rules import RuleScorer

    def loaded(fitted):
        path = staging_path(t.spark, "artefact")
        fitted.write().save(path)
        return fitted, PipelineModel.load(path)

    _, rules = loaded(Pipeline(stages=[LoanCleaner(training=True), RuleScorer()]).fit(t.applicants))
    fitted, model = loaded(M.fit_stages([LoanCleaner(training=True), FeatureBuilder(), LoanEncoder(), *M.logistic_regression().getStages()], t.applicants))
    # each model's columns are written, so that the joins move nothing else
    p, q = (staged(m.transform(t.applicants).select("application_id", M.probability().alias(name)), name) for m, name in ((fitted, "p"), (model, "q")))
    same = p.join(q, "application_id").select("application_id", (F.abs(F.col("p") - F.col("q")) < 1e-12).alias("same_probability"))
    scored = rules.transform(t.applicants).select("application_id", "clf_proba", "clf_label", "conf_zone", "predicted_emi")
    return staged(scored, "scored").join(same, "application_id")


@check("topk_importance")
def topk_importance(t):
    encoder, train, _ = t.encoded
    model = M.random_forest().fit(train)
    return M.importance_frame(t.spark, M.importances(model, encoder.feature_names(), 20))


@check("topk_coefficients")
def topk_coefficients(t):
    encoder, train, _ = t.encoded
    model = M.logistic_regression().fit(train)
    return M.importance_frame(t.spark, M.importances(model, encoder.feature_names(), 15))


@check("score_rows_models")
def score_rows_models(t):
    """Whole cleaned table scored by saved and reloaded models."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import GBTRegressionModel

    encoder, train, _ = t.encoded
    classifier_path, regressor_path = staging_path(t.spark, "classifier"), staging_path(t.spark, "regressor")
    M.logistic_regression().fit(train).write().save(classifier_path)
    M.boosted_regressor().fit(train).write().save(regressor_path)
    # vectors are written, so that scoring does not evaluate all features in one stage
    rows = staged(encoder.transform(t.features).select(*S.KEY_COLUMNS, "features"), "encoded", rows_per_file=VECTORS_PER_FILE)
    return M.scored_with_models(rows, PipelineModel.load(classifier_path), GBTRegressionModel.load(regressor_path))


_BOOSTED = {"maxDepth": [2, 4, 6], "stepSize": [0.1, 0.3], "subsamplingRate": [0.7, 1.0]}


def _named(settings: dict):
    return F.lit(",".join(f"{k}={v}" for k, v in sorted(settings.items()))).alias("model")


@check("tune_boosted")
def tune_boosted(t):
    """Boosted classifiers with early stopping: settings drawn without repetition, trees of the best one."""
    from pyspark.ml.classification import GBTClassifier

    _, train, test = t.encoded
    boosted = M.early_stopped(GBTClassifier(labelCol=S.TARGET_CLASS, weightCol=M.WEIGHT, seed=42), rounds=30)
    model, settings, score = M.tune(M.with_validation(train), boosted, _BOOSTED, trials=2, folds=2)
    scored = model.transform(test).select(_named(settings), F.col(S.TARGET_CLASS).alias("label"), M.probability().alias("score"))
    return E.eval_classifier(scored).withColumns({"cv_auc": F.lit(score), "trees": F.lit(model.getNumTrees)})


@check("tune_boosted_regressor")
def tune_boosted_regressor(t):
    """The same for the amount, compared on all rows."""
    from pyspark.ml.regression import GBTRegressor

    _, train, test = t.encoded
    boosted = M.early_stopped(GBTRegressor(labelCol=S.TARGET_AMOUNT, seed=42), rounds=30)
    model, settings, score = M.tune(M.with_validation(train), boosted, _BOOSTED, trials=2, folds=2, regression=True)
    return E.eval_regressor(model.transform(test).select(
        _named(settings), F.col(S.TARGET_AMOUNT).alias("actual"), F.col("prediction").alias("predicted"))).withColumns(
        {"cv_rmse": F.lit(score), "trees": F.lit(model.getNumTrees)})


_OUTSIDE = {"credit_score": 0.012, "monthly_salary": 0.00001, "requested_amount": -0.000004, "gender_Male": 0.3,
            "house_type_Rented": -0.4, "education_Unknown": -0.2, "bank_balance_missing": -0.1, "no_such_column": 5.0}
# such weights that no amount ends on half a cent
_OUTSIDE_AMOUNT = {"monthly_salary": 0.201370719, "bank_balance": 0.010130717}
_OUTSIDE_SQL = """CAST(credit_score AS DOUBLE) * 0.012 + monthly_salary * 0.00001 + requested_amount * -0.000004 + CAST(gender = 'Male' AS DOUBLE) * 0.3
  + CAST(house_type = 'Rented' AS DOUBLE) * -0.4 + CAST(education = 'Unknown' AS DOUBLE) * -0.2 + bank_balance_missing * -0.1 - 8.0"""


@check("score_outside_model", Q.query("clean", f"""
SELECT application_id, round(p, 6) AS clf_proba, CAST(p >= 0.5 AS INTEGER) AS clf_label,
  CASE WHEN p > {S.AUTO_APPROVE} THEN 'auto_approve' WHEN p >= {S.AUTO_REJECT} THEN 'human_review' ELSE 'auto_reject' END AS conf_zone,
  round(least(greatest(a, {S.EMI_MIN}), {S.EMI_MAX}), 2) AS predicted_emi
FROM (SELECT application_id, 1 / (1 + exp(-({_OUTSIDE_SQL}))) AS p, monthly_salary * 0.201370719 + bank_balance * 0.010130717 + 100 AS a FROM clean)"""))
def score_outside_model(t):
    """Whole cleaned table scored by two pickled models on the workers, by the names that the models give."""
    from lendframe.plans import outside

    saved = []
    for name, model in (("classifier", outside.LinearModel(_OUTSIDE, -8.0)), ("regressor", outside.LinearModel(_OUTSIDE_AMOUNT, 100.0))):
        path = staging_path(t.spark, f"outside-{name}")
        outside.save_model(t.spark, model, path)
        saved.append(outside.load_model(t.spark, path))
    return outside.score_outside(t.clean, *saved, keep=["application_id"])


@check("shuffled_target")
def shuffled_target(t):
    _, train, test = t.encoded
    return leakage.shuffled_target(train, test, runs=5)
