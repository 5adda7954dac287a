"""Scans, sources, sinks and request shapes."""

from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.checks import sql_parts as Q
from lendframe.checks.registry import check, rounded, sql_rounded
from lendframe.functions import expr as X
from lendframe.operators import cleaning, profiling, sampling, scoring
from lendframe.operators.evaluation import eval_classifier
from lendframe.sources import files
from lendframe.staging import staged, staging_path

_SCAN = ["age", "gender", "marital_status", "education", "monthly_salary", "company_type",
         "emi_eligibility"]
_TOKENS = Q.texts(S.CSV_NULL_TOKENS)


def _csv(t, columns):
    path = staging_path(t.spark, "applicants") + ".csv"
    t.applicants.select("application_id", *columns).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def _token_sql(c):
    return f"CASE WHEN {c} NOT IN {_TOKENS} THEN {c} END AS {c}"


@check("scan_validated", Q.query("applicants", f"""
SELECT application_id, {', '.join(_token_sql(c) for c in _SCAN)}, requested_amount, credit_score
FROM applicants"""))
def scan_validated(t):
    df = files.scan_validated(t.spark, _csv(t, S.EXPECTED_COLUMNS))
    return df.select(X.to_number("application_id").cast("long").alias("application_id"), *_SCAN,
                     X.to_number("requested_amount").alias("requested_amount"),
                     X.to_number("credit_score").alias("credit_score"))


@check("scan_batch", Q.query("applicants", f"""
SELECT application_id, {', '.join(_token_sql(c) for c in _SCAN[:-1])}, bank_balance FROM applicants"""))
def scan_batch(t):
    df = files.scan_batch(t.spark, _csv(t, S.REQUEST_COLUMNS))
    return df.select(X.to_number("application_id").cast("long").alias("application_id"), *_SCAN[:-1],
                     X.to_number("bank_balance").alias("bank_balance"))


@check("scan_null_tokens", Q.query("applicants", f"""
SELECT application_id, {', '.join(_token_sql(c) for c in _SCAN)} FROM applicants"""))
def scan_null_tokens(t):
    return files.null_tokens_to_null(t.applicants).select("application_id", *_SCAN)


@check("normalize_columns", Q.query("applicants", """
SELECT application_id, age, gender, monthly_salary FROM applicants"""))
def normalize_columns(t):
    messy = t.applicants.select(
        F.col("application_id").alias(" Application_ID"), F.col("age").alias(" Age "),
        F.col("gender").alias("GENDER"), F.col("monthly_salary").alias("Monthly_Salary  "))
    return cleaning.normalize_columns(messy)


_PRESENT = [c for c in S.EXPECTED_COLUMNS if c != "emi_scenario"]


@check("expected_columns", Q.query("applicants", Q.union_all(
    [f"SELECT '{c}' AS \"column\", TRUE AS found, count({c}) AS present FROM applicants" for c in _PRESENT]
    + ["SELECT 'emi_scenario', FALSE, NULL"])))
def expected_columns(t):
    df = t.applicants.drop("emi_scenario")
    one = df.agg(*[F.count(c).alias(c) for c in _PRESENT])
    have = one.unpivot([], _PRESENT, "column", "present").select(
        "column", F.lit(True).alias("found"), "present")
    gone = one.select(F.explode(F.array(*[F.lit(c) for c in profiling.missing_columns(df)])).alias("column"),
                      F.lit(False).alias("found"), F.lit(None).cast("long").alias("present"))
    return have.unionByName(gone)


@check("row_count_gate", Q.query("applicants", """
SELECT count(*) = 0 AS empty, count(*) >= 1000 AS enough, count(*) <= 500 AS within, 30 AS columns
FROM applicants"""))
def row_count_gate(t):
    gate = profiling.row_count_gate(t.applicants, S.MIN_TRAINING_ROWS, S.MAX_UPLOAD_ROWS)
    return t.spark.range(1).select(*[F.lit(v).alias(k) for k, v in gate.items()])


@check("load_summary", Q.query("applicants", Q.union_all([
    f"""SELECT '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS nulls,
    round((count(*) - count({c})) * 100.0 / count(*), 1) AS null_pct FROM applicants"""
    for c in S.EXPECTED_COLUMNS])))
def load_summary(t):
    return profiling.load_summary(t.applicants.select(*S.EXPECTED_COLUMNS)).drop("type")


_CUSTOMER = ["customer_id", "age", "gender", "monthly_salary", "house_type", "credit_score",
             "requested_amount", "requested_tenure"]
_CAPPED = ["monthly_salary", "requested_amount"]


@check("explode_requests", Q.query("clean", f"""
SELECT application_id // 500 AS request_id,
  CAST(row_number() OVER (PARTITION BY application_id // 500 ORDER BY application_id) - 1 AS INTEGER) AS position,
  {Q.cols(c for c in _CUSTOMER if c not in _CAPPED)}, {sql_rounded(_CAPPED, 4)} FROM clean"""))
def explode_requests(t):
    rows = scoring.explode_requests(scoring.batch_requests(t.clean))
    return rounded(rows.select("request_id", "position", *_CUSTOMER), _CAPPED, 4)


_RANGES = [
    ("age", "age IS NULL OR age < 18 OR age > 100"),
    *[(c, f"{c} IS NULL OR {c} < {low}") for c, low in scoring.REQUEST_FLOORS.items()],
    *[(c, f"{c} IS NULL OR {c} <= 0") for c in S.CRITICAL_COLUMNS],
    *[(c, f"{c} IS NULL") for c in S.CATEGORICAL_COLUMNS],
]
_RANGES = sorted(_RANGES, key=lambda r: S.REQUEST_COLUMNS.index(r[0]))


@check("validate_requests", Q.query("prepared", f"""
SELECT application_id, {Q.strip('marital_status')} AS marital_status,
  coalesce(concat_ws(',', {', '.join(f"CASE WHEN {test} THEN '{c}' END" for c, test in _RANGES)}), '') AS problems,
  NOT ({' OR '.join(f'({test})' for _, test in _RANGES)}) AS valid
FROM prepared"""))
def validate_requests(t):
    return scoring.validate_requests(t.prepared).select(
        "application_id", "marital_status", F.array_join("problems", ",").alias("problems"), "valid")


_SCORE_SQL = "SELECT application_id, customer_id, clf_proba, clf_label, conf_zone, predicted_emi"


@check("sink_predictions", Q.query("clean", _SCORE_SQL + """,
  '2024-01-31' AS batch_date, 'scheduled__2024-01-31T02_00_00_00_00' AS run_id FROM scored""", Q.SCORED))
def sink_predictions(t):
    root = staging_path(t.spark, "predictions")
    files.write_predictions(t.scored, root, "2024-01-31", "scheduled__2024-01-31T02:00:00+00:00")
    return t.spark.read.parquet(root).withColumn("batch_date", F.col("batch_date").cast("string"))


@check("sink_unlabeled", Q.query("flagged", f"""
SELECT application_id, age, monthly_salary, credit_score_missing, emi_eligibility FROM flagged
WHERE emi_eligibility IS NULL OR emi_eligibility NOT IN {Q.LABELS}"""))
def sink_unlabeled(t):
    flagged = cleaning.missing_flags(t.prepared, t.stats.flag_gates)
    side = files.write_table(cleaning.split_labeled(flagged)[1], staging_path(t.spark, "unlabeled"))
    return side.select("application_id", "age", "monthly_salary", "credit_score_missing", "emi_eligibility")


@check("sink_staging", Q.query("prepared", "SELECT application_id, age, monthly_salary FROM prepared"))
def sink_staging(t):
    return staged(t.prepared, "staging").select("application_id", "age", "monthly_salary")


SPLIT_SQL = f"""quota AS (SELECT emi_eligibility, count(*) AS n, sum(count(*)) OVER () AS total FROM clean GROUP BY 1),
quota2 AS (SELECT *, ceil(total * 0.2) AS tests, n * ceil(total * 0.2) / total AS exact FROM quota),
quota3 AS (SELECT emi_eligibility, floor(exact) + CASE WHEN row_number() OVER (
    ORDER BY exact - floor(exact) DESC, emi_eligibility) <= tests - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS take
  FROM quota2),
split AS (SELECT c.*, CASE WHEN row_number() OVER (PARTITION BY c.emi_eligibility ORDER BY
    {Q.seeded('application_id', 42)}) <= take THEN 'test' ELSE 'train' END AS part
  FROM clean c JOIN quota3 q ON c.emi_eligibility = q.emi_eligibility)"""


@check("sink_train_test", Q.query("clean", """
SELECT part, count(*) AS "rows", CAST(sum(emi_eligibility) AS BIGINT) AS positives,
  CAST(sum(application_id) AS BIGINT) AS ids FROM split GROUP BY part""", SPLIT_SQL))
def sink_train_test(t):
    out = None
    for part, rows in zip(("train", "test"), t.split):
        one = files.write_table(rows, staging_path(t.spark, part)).agg(
            F.lit(part).alias("part"), F.count(F.lit(1)).alias("rows"),
            F.sum(S.TARGET_CLASS).alias("positives"), F.sum("application_id").alias("ids"))
        out = one if out is None else out.unionByName(one)
    return out


@check("sink_metrics", Q.query("clean", f"""
SELECT 'rules' AS model, count(*) AS n, sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END)::BIGINT AS tp,
  sum(CASE WHEN {Q.zone('p')} = 'auto_approve' THEN 1 ELSE 0 END)::BIGINT AS auto_approve
FROM (SELECT {Q.rule_probability()} AS p, emi_eligibility AS y FROM clean)"""))
def sink_metrics(t):
    rows = t.clean.select(F.lit("rules").alias("model"), F.col(S.TARGET_CLASS).alias("label"),
                          scoring.rule_probability().alias("score"))
    saved = files.write_table(eval_classifier(rows), staging_path(t.spark, "metrics"), "json")
    return saved.select("model", "n", "tp", "auto_approve")


@check("split_labels_sink_counts", Q.query("deduped", f"""
SELECT coalesce(emi_eligibility IN {Q.LABELS}, FALSE) AS labeled, count(*) AS "rows" FROM deduped GROUP BY 1"""))
def split_labels_sink_counts(t):
    labeled, rest = cleaning.split_labeled(t.prepared)
    return labeled.withColumn("labeled", F.lit(True)).unionByName(
        rest.withColumn("labeled", F.lit(False))).groupBy("labeled").agg(F.count(F.lit(1)).alias("rows"))


_RESPONSE = Q.query("clean", """
SELECT customer_id, conf_zone, clf_proba, CASE WHEN clf_label = 1 THEN 'Eligible' ELSE 'Not Eligible' END AS clf_label,
  predicted_emi, FALSE AS cache_hit, latency_ms FROM (SELECT *, round_even(425.0::DOUBLE / count(*) OVER (
    PARTITION BY application_id // 500), 2) AS latency_ms FROM scored)""", Q.SCORED)


def _responses(t):
    return scoring.batch_response(t.scored, scoring.id_span("application_id", 500), 425.0)


@check("results_frame", _RESPONSE)
def results_frame(t):
    return scoring.results_frame(_responses(t))


@check("batch_response", Q.query("clean", """
SELECT application_id // 500 AS request_id, count(*) AS total_scored,
  count(*) FILTER (conf_zone = 'auto_approve') AS auto_approve,
  count(*) FILTER (conf_zone = 'human_review') AS human_review,
  count(*) FILTER (conf_zone = 'auto_reject') AS auto_reject, 425.0::DOUBLE AS total_latency_ms,
  string_agg(customer_id || ':' || conf_zone, ',' ORDER BY application_id) AS predictions
FROM scored GROUP BY 1""", Q.SCORED))
def batch_response(t):
    return _responses(t).withColumn("predictions", F.array_join(F.transform(
        "predictions", lambda p: F.concat_ws(":", p["customer_id"], p["conf_zone"])), ","))


@check("run_id_and_date", Q.query("applicants", """
SELECT application_id, translate(concat('run:', customer_id, '+00/', age), ':+/', '___') AS run_id,
  strftime(applied_at, '%Y-%m-%d') AS batch_date FROM applicants"""))
def run_id_and_date(t):
    path = F.concat(F.lit("in/features_"), F.date_format("applied_at", "yyyy-MM-dd"), F.lit(".csv"))
    return t.applicants.select(
        "application_id",
        files.safe_run_id(F.concat(F.lit("run:"), "customer_id", F.lit("+00/"), "age")).alias("run_id"),
        files.batch_date(path).cast("string").alias("batch_date"))
