"""Cleaning steps, audits and reports."""

from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.checks import sql_parts as Q
from lendframe.checks.registry import check, rounded, sql_rounded
from lendframe.functions import expr as X
from lendframe.operators import cleaning as C
from lendframe.operators import profiling
from lendframe.plans.cleaner import clean

_RAW = [c for c in S.EXPECTED_COLUMNS]
_NO_TARGET = [c for c in S.NUMERIC_COLUMNS if c != S.TARGET_AMOUNT]
_COPIES = ("copied AS (SELECT * FROM applicants UNION ALL SELECT * FROM applicants "
           "WHERE customer_id LIKE '%0')")


@check("dedup_exact", Q.query("applicants", f"""
SELECT DISTINCT application_id, customer_id, {Q.cols(_RAW)} FROM copied""", _COPIES))
def dedup_exact(t):
    return C.drop_exact_duplicates(t.copies).select(*S.KEY_COLUMNS, *_RAW)


@check("clean_currency", Q.query("deduped", f"""
SELECT application_id, {Q.currency('age')} AS age, {Q.currency('monthly_salary')} AS monthly_salary FROM deduped"""))
def clean_currency(t):
    return C.clean_currency(t.applicants).select("application_id", "age", "monthly_salary")


@check("coerce_numeric", Q.query("prepared", f"SELECT application_id, {Q.cols(S.NUMERIC_COLUMNS)} FROM prepared"))
def coerce_numeric(t):
    return C.coerce_numbers(C.clean_currency(t.applicants)).select("application_id", *S.NUMERIC_COLUMNS)


@check("dirty_value_report", Q.query("applicants", Q.union_all([f"""
SELECT '{c}' AS "column", {c} AS value, count(*) AS "rows" FROM applicants
WHERE {c} IS NOT NULL AND {Q.number(Q.currency(c))} IS NULL GROUP BY {c}""" for c in ("age", "monthly_salary")])))
def dirty_value_report(t):
    return profiling.dirty_values(t.applicants)


@check("missing_flags", Q.query("flagged", f"SELECT application_id, {Q.cols(S.FLAG_COLUMNS)} FROM flagged"))
def missing_flags(t):
    return C.missing_flags(t.prepared, t.stats.flag_gates).select("application_id", *S.FLAG_COLUMNS)


@check("split_unlabeled", Q.query("deduped", f"""
SELECT application_id, emi_eligibility, coalesce(emi_eligibility IN {Q.LABELS}, FALSE) AS labeled FROM deduped"""))
def split_unlabeled(t):
    return t.prepared.select("application_id", "emi_eligibility", C.is_labeled().alias("labeled"))


@check("drop_critical_nulls", Q.query("deduped", """
SELECT application_id, requested_amount, requested_tenure FROM deduped
WHERE requested_amount IS NOT NULL AND requested_tenure IS NOT NULL"""))
def drop_critical_nulls(t):
    return C.drop_critical_nulls(t.prepared).select("application_id", *S.CRITICAL_COLUMNS)


def _filled(name, columns):
    @check(name, Q.query("filled", f"SELECT application_id, {Q.cols(columns)} FROM filled"))
    def fill(t):
        return t.filled.select("application_id", *columns)


_filled("fill_rent", ["house_type", "monthly_rent"])
_filled("fill_constant", ["credit_score", "education", *S.ZERO_FILL_COLUMNS])
_filled("fill_group_median", ["bank_balance", "groceries_utilities"])
_filled("fill_median", ["age", "family_size", "monthly_salary"])


@check("strip_categoricals", Q.query("stripped", f"""
SELECT application_id, {Q.cols(S.CATEGORICAL_COLUMNS + ['emi_eligibility'])} FROM stripped"""))
def strip_categoricals(t):
    columns = [*S.CATEGORICAL_COLUMNS, S.TARGET_CLASS]
    return t.filled.select("application_id", *[C.trimmed_text(c).alias(c) for c in columns])


@check("map_values", Q.query("mapped", f"SELECT application_id, {Q.cols(S.VALUE_MAPS)} FROM mapped"))
def map_values(t):
    return t.filled.select("application_id", *[
        X.mapped(C.trimmed_text(c), m).alias(c) for c, m in S.VALUE_MAPS.items()])


@check("title_case", Q.query("titled", f"SELECT application_id, {Q.cols(S.TITLE_COLUMNS)} FROM titled"))
def title_case(t):
    return t.filled.select("application_id", *[C.mapped_text(c).alias(c) for c in S.TITLE_COLUMNS])


@check("map_effect", Q.query("mapped", Q.union_all([f"""
SELECT '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM stripped) AS before,
  (SELECT count(DISTINCT {c}) FROM mapped) AS after""" for c in S.VALUE_MAPS])))
def map_effect(t):
    return profiling.map_effect(t.filled)


@check("fix_null_strings", Q.query("named", f"SELECT application_id, {Q.cols(S.CATEGORICAL_COLUMNS)} FROM named"))
def fix_null_strings(t):
    return t.named.select("application_id", *S.CATEGORICAL_COLUMNS)


_BOUNDED = list(S.DOMAIN_BOUNDS)


@check("clip_rules", Q.query("clipped", f"""
SELECT application_id, CAST(age AS INTEGER) AS age, CAST(family_size AS INTEGER) AS family_size,
  CAST(dependents AS INTEGER) AS dependents, credit_score, years_of_employment, requested_tenure FROM clipped"""))
def clip_rules(t):
    return t.ruled.select("application_id", *_BOUNDED)


@check("clip_violations", Q.query("named", Q.union_all([f"""
SELECT '{c}' AS "column", count(*) FILTER ({c} < {low} OR {c} > {high}) AS violations FROM named"""
    for c, (low, high) in S.DOMAIN_BOUNDS.items()])))
def clip_violations(t):
    return profiling.rule_violations(t.named)


@check("clip_nonneg", Q.query("non_negative", f"SELECT application_id, {Q.cols(S.NON_NEGATIVE_COLUMNS)} FROM non_negative"))
def clip_nonneg(t):
    return t.ruled.select("application_id", *S.NON_NEGATIVE_COLUMNS)


@check("repair_salary", Q.query("salaried", "SELECT application_id, monthly_salary FROM salaried"))
def repair_salary(t):
    return t.ruled.select("application_id", "monthly_salary")


@check("final_types", Q.query("ruled", f"SELECT application_id, {Q.cols(S.INTEGER_COLUMNS)} FROM ruled"))
def final_types(t):
    return t.ruled.select("application_id", *S.INTEGER_COLUMNS)


@check("cap_outliers", Q.query("capped", f"SELECT application_id, {sql_rounded(S.CAP_COLUMNS, 4)} FROM capped"))
def cap_outliers(t):
    return rounded(C.cap_outliers(t.ruled, t.stats.caps).select("application_id", *S.CAP_COLUMNS), S.CAP_COLUMNS, 4)


@check("cap_report", Q.query("caps", Q.union_all([f"""
SELECT '{c}' AS "column", round(any_value(lo_{c}), 4) AS p01, round(any_value(hi_{c}), 4) AS p99,
  count(*) FILTER ({c} < lo_{c}) AS below, count(*) FILTER ({c} > hi_{c}) AS above
FROM ruled CROSS JOIN caps""" for c in S.CAP_COLUMNS])))
def cap_report(t):
    return rounded(profiling.cap_report(t.ruled, t.stats.caps), ["p01", "p99"], 4)


@check("encode_target", Q.query("clean", """
SELECT application_id, emi_eligibility, round(count(*) OVER (PARTITION BY emi_eligibility) * 100.0
  / count(*) OVER (), 1) AS class_pct FROM clean"""))
def encode_target(t):
    rows = C.encode_target(C.standardize_categories(t.filled, t.stats.modes)).select(
        "application_id", S.TARGET_CLASS)
    shares = profiling.audit_target(rows).select(F.col("target").alias(S.TARGET_CLASS),
                                                 F.col("pct").alias("class_pct"))
    return rows.join(F.broadcast(shares), S.TARGET_CLASS)


_DOUBLES = [c for c in S.NUMERIC_COLUMNS if c not in S.INTEGER_COLUMNS]


def _row_sql(training):
    doubles = [c for c in _DOUBLES if training or c != S.TARGET_AMOUNT]
    target = f"{S.TARGET_CLASS}, " if training else ""
    return Q.query("clean", f"""
SELECT application_id, customer_id, {target}{Q.cols(S.INTEGER_COLUMNS + S.CATEGORICAL_COLUMNS + S.FLAG_COLUMNS)},
  {sql_rounded(doubles, 4)} FROM clean""", training=training)


@check("clean_training", _row_sql(True))
def clean_training(t):
    return rounded(clean(t.applicants, training=True).drop("applied_at"), _DOUBLES, 4)


@check("clean_inference", _row_sql(False))
def clean_inference(t):
    return rounded(clean(t.applicants, training=False).drop("applied_at"),
                   [c for c in _DOUBLES if c != S.TARGET_AMOUNT], 4)


@check("filter_out_of_range", Q.query("prepared", """
SELECT application_id, credit_score FROM prepared WHERE credit_score < 300 OR credit_score > 900"""))
def filter_out_of_range(t):
    return t.prepared.filter("credit_score < 300 or credit_score > 900").select("application_id", "credit_score")


@check("filter_class", Q.query("clean", """
SELECT application_id, emi_eligibility, max_monthly_emi FROM clean WHERE emi_eligibility = 1"""))
def filter_class(t):
    return t.clean.filter(F.col(S.TARGET_CLASS) == 1).select("application_id", S.TARGET_CLASS, S.TARGET_AMOUNT)


@check("filter_null_target", Q.query("deduped", """
SELECT application_id, age, monthly_salary, credit_score, emi_eligibility FROM deduped WHERE emi_eligibility IS NULL"""))
def filter_null_target(t):
    return t.applicants.filter(F.col(S.TARGET_CLASS).isNull()).select(
        "application_id", "age", "monthly_salary", "credit_score", S.TARGET_CLASS)


_NUMBERS = ["application_id", *_NO_TARGET, *S.FLAG_COLUMNS]


@check("select_numeric", Q.query("clean", Q.union_all([
    f"SELECT '{c}' AS \"column\", count({c}) AS present FROM clean" for c in _NUMBERS])))
def select_numeric(t):
    return profiling.numeric_column_names(t.clean)


_LABELS = [*S.CATEGORICAL_COLUMNS, S.TARGET_CLASS]


def _counts_sql(table, columns):
    return Q.union_all([f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {table} GROUP BY {c}"
                        for c in columns])


@check("audit_labels", Q.query("prepared", f"""
SELECT col AS "column", value, n AS "rows", round(n * 100.0 / sum(n) OVER (PARTITION BY col), 1) AS pct,
  CASE WHEN col = 'gender' AND value IN ('M', 'F', 'm', 'f') THEN 'abbreviation'
       WHEN lower(coalesce(value, 'nan')) IN {Q.texts(S.SUSPICIOUS_LABELS)} THEN 'suspicious' ELSE 'ok' END AS note
FROM ({_counts_sql('prepared', _LABELS)})"""))
def audit_labels(t):
    return profiling.audit_labels(t.prepared, _LABELS)


@check("audit_ranges", Q.query("prepared", Q.union_all([f"""
SELECT '{c}' AS "column", {f'count(*) FILTER ({c} < {low})' if low is not None else 'CAST(0 AS BIGINT)'} AS below_bound,
  {f'count(*) FILTER ({c} > {high})' if high is not None else 'CAST(0 AS BIGINT)'} AS above_bound,
  min({c}) AS min_value, max({c}) AS max_value FROM prepared""" for c, (low, high) in S.AUDIT_BOUNDS.items()])))
def audit_ranges(t):
    return profiling.audit_ranges(t.prepared)


@check("audit_hidden_nulls", Q.query("deduped", f"""
SELECT col AS "column", value, n AS "rows" FROM ({_counts_sql('deduped', S.CATEGORICAL_COLUMNS)})
WHERE value IN {Q.texts(S.HIDDEN_NULLS)}"""))
def audit_hidden_nulls(t):
    return profiling.audit_hidden_nulls(t.prepared, S.CATEGORICAL_COLUMNS)


@check("audit_flags", Q.query("clean", Q.union_all([f"""
SELECT '{c}' AS "column", min({c})::BIGINT AS lowest, max({c})::BIGINT AS highest, sum({c})::BIGINT AS flagged,
  bool_and({c} IN (0, 1)) AS valid FROM clean""" for c in S.FLAG_COLUMNS])))
def audit_flags(t):
    return profiling.audit_flags(t.clean)


@check("audit_target", Q.query("clean", """
SELECT emi_eligibility AS target, count(*) AS "rows", round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct,
  emi_eligibility IN (0, 1) AS expected FROM clean GROUP BY emi_eligibility"""))
def audit_target(t):
    return profiling.audit_target(t.clean)


@check("audit_duplicates", Q.query("applicants", """
SELECT (SELECT count(*) FROM copied) AS "rows", (SELECT count(*) FROM (SELECT DISTINCT * FROM copied)) AS distinct_rows,
  (SELECT count(*) FROM copied) - (SELECT count(*) FROM (SELECT DISTINCT * FROM copied)) AS duplicates""", _COPIES))
def audit_duplicates(t):
    return profiling.audit_duplicates(t.copies)


_AUDITED = [*S.NUMERIC_COLUMNS, *S.CATEGORICAL_COLUMNS]


@check("audit_profile", Q.query("prepared", Q.union_all([f"""
SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values FROM prepared"""
    for c in _AUDITED])))
def audit_profile(t):
    return profiling.audit_profile(t.prepared.select(*_AUDITED)).drop("type")


_ALLOWED = " OR ".join(f"(col = '{c}' AND value IN {Q.texts(v)})" for c, v in S.ALLOWED_VALUES.items())


@check("validate_categories", Q.query("filled", f"""
SELECT col AS "column", value, n AS "rows" FROM ({_counts_sql('filled', S.ALLOWED_VALUES)})
WHERE NOT coalesce({_ALLOWED}, FALSE)"""))
def validate_categories(t):
    return profiling.unexpected_values(t.filled)


@check("value_difference", Q.query("deduped", f"""
SELECT col AS "column", value FROM ({_counts_sql('deduped', S.ALLOWED_VALUES)})
WHERE NOT coalesce({_ALLOWED}, FALSE)"""))
def value_difference(t):
    return profiling.unexpected_values(t.applicants).select("column", "value")


@check("final_null_check", Q.query("clean", f"""
SELECT "column", nulls, sum(nulls) OVER ()::BIGINT AS total_nulls FROM ({Q.union_all([
    f'''SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM clean''' for c in S.EXPECTED_COLUMNS])})"""))
def final_null_check(t):
    return profiling.final_null_check(t.clean.select(*S.EXPECTED_COLUMNS))


def _snapshot(table, columns, name):
    nulls = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in columns)
    return (f"(SELECT count(*) FROM {table}) AS {name}_rows, (SELECT sum({nulls}) FROM {table})::BIGINT AS {name}_nulls, "
            f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {Q.cols(columns)} FROM {table})) "
            f"AS {name}_duplicates")


@check("cleaning_report", Q.query("clean", f"""
SELECT {_snapshot('copied', S.KEY_COLUMNS + _RAW, 'raw')},
  {_snapshot('clean', S.KEY_COLUMNS + _RAW + S.FLAG_COLUMNS, 'clean')},
  (SELECT round(sum(emi_eligibility) * 100.0 / count(*), 2) FROM clean) AS eligible_pct,
  (SELECT count(*) FROM copied) - (SELECT count(*) FROM clean) AS rows_removed,
  '{','.join(S.FLAG_COLUMNS)}' AS new_columns""", _COPIES))
def cleaning_report(t):
    raw = t.copies.select(*S.KEY_COLUMNS, *_RAW)
    return profiling.cleaning_report(raw, t.clean.select(*S.KEY_COLUMNS, *_RAW, *S.FLAG_COLUMNS))


@check("null_map", Q.query("deduped", f"""
SELECT * FROM ({Q.union_all([f'''SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM deduped''' for c in _RAW])})
WHERE nulls > 0"""))
def null_map(t):
    return profiling.null_map(t.applicants, _RAW)


_COUNTED = ["age", "gender", "marital_status", "education", "employment_type", "company_type", "house_type",
            "family_size", "dependents", "existing_loans", "emi_scenario", "emi_eligibility"]


@check("value_counts", Q.query("deduped", f"""
SELECT col AS "column", value, n AS "rows" FROM ({_counts_sql('deduped', _COUNTED)})"""))
def value_counts(t):
    return profiling.value_counts(t.applicants, _COUNTED)
