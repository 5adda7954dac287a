"""Summaries, statistics, correlations, samples, sorts."""

from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.checks import sql_parts as Q
from lendframe.checks.loading import SPLIT_SQL
from lendframe.checks.registry import check
from lendframe.operators import profiling as P
from lendframe.operators import sampling

_MEANS = ["credit_score", "monthly_salary", "bank_balance", "age", "years_of_employment", "max_monthly_emi"]


@check("class_balance", Q.query("clean", """
SELECT n0 AS not_eligible, n1 AS eligible, n AS total, round(n0 * 100.0 / n, 1) AS not_eligible_pct,
  round(n1 * 100.0 / n, 1) AS eligible_pct, round(n0 / n1, 4) AS imbalance_ratio,
  n1 * 100.0 / n < 20 OR n1 * 100.0 / n > 80 AS imbalanced
FROM (SELECT count(*) FILTER (emi_eligibility = 0) AS n0, count(*) FILTER (emi_eligibility = 1) AS n1,
  count(*) AS n FROM clean)"""))
def class_balance(t):
    return P.class_balance(t.clean)


@check("class_ratio", Q.query("clean", """
SELECT n0, n1, round(n0 / n1, 4) AS class_ratio, round((n0 + n1) / (2.0 * n0), 6) AS weight0,
  round((n0 + n1) / (2.0 * n1), 6) AS weight1
FROM (SELECT count(*) FILTER (emi_eligibility = 0) AS n0, count(*) FILTER (emi_eligibility = 1) AS n1 FROM clean)"""))
def class_ratio(t):
    return P.class_ratio(t.clean)


_SCENARIO = """
SELECT emi_scenario, count(emi_eligibility) AS total, sum(emi_eligibility)::BIGINT AS eligible,
  round(avg(max_monthly_emi), 4) AS avg_emi, round(median(requested_amount), 4) AS median_req,
  round(sum(emi_eligibility) * 100.0 / count(emi_eligibility), 1) AS approval_pct,
  replace(replace(emi_scenario, ' EMI', ''), ' Emi', '') AS short_name
FROM clean GROUP BY emi_scenario"""


@check("scenario_summary", Q.query("clean", _SCENARIO))
def scenario_summary(t):
    return P.scenario_summary(t.clean)


@check("sorted_bars", Q.query("clean", f"SELECT emi_scenario, approval_pct FROM ({_SCENARIO}) ORDER BY approval_pct, emi_scenario"))
def sorted_bars(t):
    return P.scenario_summary(t.clean).select("emi_scenario", "approval_pct").orderBy("approval_pct", "emi_scenario")


@check("approval_by_category", Q.query("clean", Q.union_all([f"""
SELECT '{c}' AS "column", {c} AS value, round(avg(emi_eligibility), 6) AS approval_rate,
  count(emi_eligibility) AS "rows", round(avg(emi_eligibility) * 100, 4) AS approval_pct FROM clean GROUP BY {c}"""
    for c in S.APPROVAL_CATEGORIES])))
def approval_by_category(t):
    return P.approval_by_category(t.clean)


@check("crosstab_pct", Q.query("clean", """
SELECT existing_loans AS value, round(count(*) FILTER (emi_eligibility = 0) * 100.0 / count(*), 4) AS not_eligible_pct,
  round(count(*) FILTER (emi_eligibility = 1) * 100.0 / count(*), 4) AS eligible_pct
FROM clean GROUP BY existing_loans"""))
def crosstab_pct(t):
    return P.crosstab_pct(t.clean, "existing_loans").orderBy("eligible_pct", "value")


@check("approval_by_bracket", Q.query("clean", f"""
SELECT {Q.bracket('monthly_salary')} AS salary_bracket, round(avg(emi_eligibility), 6) AS approval_rate,
  count(emi_eligibility) AS "rows", round(avg(emi_eligibility) * 100, 4) AS approval_pct
FROM clean WHERE monthly_salary > 0 GROUP BY 1"""))
def approval_by_bracket(t):
    return P.approval_by_bracket(t.clean)


@check("class_means", Q.query("clean", Q.union_all([f"""
SELECT emi_eligibility AS target, '{c}' AS "column", round(avg({c}), 4) AS mean, round(median({c}), 4) AS median
FROM clean GROUP BY emi_eligibility""" for c in _MEANS])))
def class_means(t):
    return P.class_means(t.clean, _MEANS)


@check("describe_target", Q.query("clean", """
SELECT min(max_monthly_emi) AS min, max(max_monthly_emi) AS max, round(avg(max_monthly_emi), 4) AS mean,
  round(median(max_monthly_emi), 4) AS median FROM clean"""))
def describe_target(t):
    return P.describe_target(t.clean)


@check("distribution_stats", Q.query("clean", Q.union_all([f"""
SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(median({c}), 4) AS median,
  round(skewness({c}), 6) AS skew, round(count(*) FILTER ({c} = 0) * 100.0 / count(*), 4) AS zero_pct,
  count(*) FILTER ({c} = 0) * 100.0 / count(*) > 20 AS zero_heavy FROM clean""" for c in S.DISTRIBUTION_COLUMNS])))
def distribution_stats(t):
    return P.distribution_stats(t.clean)


def _histogram_sql(column, bins):
    return f"""
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / {bins}), 6) AS from_value,
  round(lo + (b.bin + 1) * ((hi - lo) / {bins}), 6) AS to_value, count(c.x) AS "rows"
FROM range({bins}) b(bin) CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM clean) e
LEFT JOIN (SELECT {column} AS x FROM clean) c
  ON least(floor((c.x - lo) / ((hi - lo) / {bins})), {bins - 1}) = b.bin
GROUP BY b.bin, lo, hi"""


@check("histogram", Q.query("clean", _histogram_sql("monthly_salary", 40)))
def histogram(t):
    return P.histogram(t.clean, "monthly_salary", 40)


@check("histogram_amount", Q.query("clean", _histogram_sql("max_monthly_emi", 50)))
def histogram_amount(t):
    return P.histogram(t.clean, S.TARGET_AMOUNT, 50)


_SAMPLED = f"""sampled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY emi_eligibility
  ORDER BY {Q.seeded('application_id', 42)}) AS rn FROM clean) WHERE rn <= 2000)"""


@check("class_sample", Q.query("clean", "SELECT application_id, emi_eligibility FROM sampled", _SAMPLED))
def class_sample(t):
    return sampling.class_sample(t.clean, 2000).select("application_id", S.TARGET_CLASS)


@check("density", Q.query("clean", """
SELECT s.target, CAST(g.point AS INTEGER) AS point, round(300.0 + g.point * (600.0 / 59), 4) AS at,
  round(sum(exp(-pow((300.0 + g.point * (600.0 / 59) - s.x) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 8) AS density
FROM (SELECT emi_eligibility AS target, credit_score AS x, count(*) OVER w AS n,
    stddev_samp(credit_score) OVER w * pow(count(*) OVER w, -0.2) AS h FROM clean
    WINDOW w AS (PARTITION BY emi_eligibility)) s CROSS JOIN range(60) g(point)
GROUP BY s.target, g.point"""))
def density(t):
    return P.density(t.clean, "credit_score", 300.0, 900.0, 60).withColumn("density", F.round("density", 8))


_LIMITS = [0.005, 0.99, 0.995, 0.999]


@check("quantiles", Q.query("clean", Q.union_all([f"""
SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability, round(quantile_cont({c}, {p}), 4) AS quantile FROM clean"""
    for c in S.SIGNIFICANCE_COLUMNS + [S.TARGET_AMOUNT] for p in _LIMITS])))
def quantiles(t):
    return P.quantiles(t.clean, S.SIGNIFICANCE_COLUMNS + [S.TARGET_AMOUNT], _LIMITS)


_PAIRS = [(a, b) for i, a in enumerate(S.CORRELATION_COLUMNS) for b in S.CORRELATION_COLUMNS[:i]]


@check("correlation_matrix", Q.query("clean", Q.union_all([
    f"SELECT '{a}' AS row_name, '{b}' AS column_name, round(corr({a}, {b}), 6) AS r FROM clean" for a, b in _PAIRS])))
def correlation_matrix(t):
    return P.correlation_matrix(t.clean)


def _target_sql(columns, table):
    return Q.union_all([f"""SELECT '{c}' AS "column", round(corr({c}, emi_eligibility), 6) AS r,
  CASE WHEN corr({c}, emi_eligibility) >= 0 THEN '+' ELSE '-' END AS sign FROM {table}""" for c in columns])


_TARGETED = [c for c in S.CORRELATION_COLUMNS if c != S.TARGET_CLASS]
_FEATURED = [c for c in S.NUMERIC_COLUMNS if c != S.TARGET_AMOUNT] + S.FLAG_COLUMNS + S.ENGINEERED_NUMERIC


@check("target_correlation", Q.query("clean", _target_sql(_TARGETED, "clean") + "\nORDER BY r, \"column\""))
def target_correlation(t):
    return P.target_correlation(t.clean, _TARGETED).orderBy("r", "column")


def _top_sql(columns, table, k):
    return f'SELECT * FROM ({_target_sql(columns, table)}) ORDER BY abs(r) DESC NULLS LAST, "column" LIMIT {k}'


@check("topk_correlation", Q.query("clean", _top_sql(_TARGETED, "clean", 5)))
def topk_correlation(t):
    return P.top_correlation(P.target_correlation(t.clean, _TARGETED), 5)


@check("topk_correlation_features", Q.query("features", _top_sql(_FEATURED, "features", 10)))
def topk_correlation_features(t):
    return P.top_correlation(P.target_correlation(t.features, _FEATURED), 10)


@check("topk_new_features", Q.query("features", _top_sql(S.ENGINEERED_NUMERIC, "features", 6)))
def topk_new_features(t):
    return P.top_correlation(P.target_correlation(t.features, S.ENGINEERED_NUMERIC), 6)


_T = """SELECT '{c}' AS "column", m1, m0, n0 + n1 - 2 AS degrees,
  (m1 - m0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)) AS t FROM (SELECT
  avg({c}) FILTER (emi_eligibility = 1) AS m1, avg({c}) FILTER (emi_eligibility = 0) AS m0,
  count({c}) FILTER (emi_eligibility = 1) AS n1, count({c}) FILTER (emi_eligibility = 0) AS n0,
  var_samp({c}) FILTER (emi_eligibility = 1) AS v1, var_samp({c}) FILTER (emi_eligibility = 0) AS v0 FROM clean)"""


@check("ttest", Q.query("clean", f"""
SELECT "column", round(m1, 4) AS eligible_mean, round(m0, 4) AS not_eligible_mean, round(t, 6) AS t, degrees
FROM ({Q.union_all([_T.format(c=c) for c in S.SIGNIFICANCE_COLUMNS])})"""))
def ttest(t):
    return P.t_test(t.clean).drop("p", "significant")


@check("ttest_significance")
def ttest_significance(t):
    return P.t_test(t.clean).select("column", "t", "p", "significant")


@check("stratified_split", Q.query("clean", "SELECT application_id, emi_eligibility, part FROM split", SPLIT_SQL))
def stratified_split(t):
    train, test = sampling.stratified_split(t.clean)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).select(
        "application_id", S.TARGET_CLASS, "part")


@check("tune_sample", Q.query("clean", f"""
SELECT application_id, emi_eligibility FROM (SELECT *, row_number() OVER (PARTITION BY emi_eligibility
  ORDER BY {Q.seeded('application_id', 42)}) AS rn FROM clean) c JOIN quota3 q USING (emi_eligibility)
WHERE rn <= take""", SPLIT_SQL.replace("ceil(total * 0.2)", "1000")))
def tune_sample(t):
    return sampling.tune_sample(t.clean, 1000).select("application_id", S.TARGET_CLASS)


@check("head_tail", Q.query("deduped", """
(SELECT 'head' AS part, application_id, age, emi_eligibility FROM deduped ORDER BY application_id LIMIT 30)
UNION ALL (SELECT 'tail', application_id, age, emi_eligibility FROM deduped ORDER BY application_id DESC LIMIT 5)"""))
def head_tail(t):
    rows = t.applicants.select("application_id", "age", "emi_eligibility")
    return rows.orderBy("application_id").limit(30).withColumn("part", F.lit("head")).unionByName(
        rows.orderBy(F.desc("application_id")).limit(5).withColumn("part", F.lit("tail")))


@check("union_all", Q.query("applicants", """
SELECT customer_id, count(*) AS "rows" FROM (SELECT * FROM applicants UNION ALL SELECT * FROM applicants)
GROUP BY customer_id"""))
def union_all(t):
    return t.applicants.unionByName(t.applicants).groupBy("customer_id").agg(F.count(F.lit(1)).alias("rows"))


@check("column_sets", Q.query("clean", Q.union_all(
    [f"SELECT '{c}' AS \"column\", 'shared' AS kind, count({c}) AS present FROM clean" for c in S.EXPECTED_COLUMNS]
    + [f"SELECT '{c}', 'new', count({c}) FROM clean" for c in S.FLAG_COLUMNS])))
def column_sets(t):
    """Columns of the cleaned table that the raw one has, and those added."""
    names = [c for c in t.clean.columns if c not in (*S.KEY_COLUMNS, "applied_at")]
    raw = set(t.applicants.columns)
    one = t.clean.agg(*[F.count(c).alias(c) for c in names])
    return one.unpivot([], names, "column", "present").withColumn(
        "kind", F.when(F.col("column").isin([c for c in names if c in raw]), "shared").otherwise("new"))


@check("subgroup_rates", Q.query("clean", f"""
SELECT *, round(approval_rate / max(approval_rate) OVER (PARTITION BY "column"), 4) AS ratio_to_best FROM ({Q.union_all([f'''
SELECT '{c}' AS "column", {c} AS value, round(avg(emi_eligibility), 6) AS approval_rate, count(*) AS "rows"
FROM clean GROUP BY {c}''' for c in ("gender", "marital_status")])})"""))
def subgroup_rates(t):
    from lendframe.operators.drift import subgroup_rates as rates

    return rates(t.clean)


@check("naive_baseline", Q.query("clean", """
SELECT round(greatest(p, n) * 100.0 / (p + n), 4) AS accuracy, 0.0::DOUBLE AS f1, 0.0::DOUBLE AS precision,
  0.0::DOUBLE AS recall FROM (SELECT count(*) FILTER (emi_eligibility = 1) AS p,
  count(*) FILTER (emi_eligibility = 0) AS n FROM clean)"""))
def naive_baseline(t):
    from lendframe.operators.evaluation import naive_baseline as naive

    return naive(t.clean)
