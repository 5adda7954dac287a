"""Rule score, decision zones, score rows, summaries and response shapes."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.functions import expr as X
from lendframe.operators.ranks import quantile_map

# the middle level is ours: only its zone is known from the published counts
PROBA_ELIGIBLE, PROBA_REVIEW, PROBA_REJECT = 0.90, 0.60, 0.10
CREDIT_FLOOR, EXPENSE_CEILING, SALARY_FLOOR = 650, 0.60, 20000
ZONES = ["auto_approve", "human_review", "auto_reject"]


def raw_expense_ratio() -> Column:
    ratio = X.ratio(X.row_sum(S.EXPENSE_COLUMNS), F.col("monthly_salary"))
    return F.coalesce(X.clip(ratio, 0.0, 2.0), F.lit(1.0))


def rules_passed(credit_floor=CREDIT_FLOOR, expense_ceiling=EXPENSE_CEILING,
                 salary_floor=SALARY_FLOOR) -> Column:
    rules = [
        F.col("credit_score") >= credit_floor,
        raw_expense_ratio() <= expense_ceiling,
        F.col("monthly_salary") >= salary_floor,
    ]
    return sum((F.coalesce(r, F.lit(False)).cast("int") for r in rules[1:]),
               F.coalesce(rules[0], F.lit(False)).cast("int"))


def rule_probability(**limits) -> Column:
    passed = rules_passed(**limits)
    return (F.when(passed == 3, F.lit(PROBA_ELIGIBLE))
            .when(passed == 2, F.lit(PROBA_REVIEW)).otherwise(F.lit(PROBA_REJECT)))


def rule_amount() -> Column:
    """Stand-in for the amount model where a query is to be checked without one."""
    return F.col("monthly_salary") * F.lit(0.3)


def score_columns(probability: Column, amount: Column) -> list[Column]:
    """Zones and labels use the unrounded probability."""
    return [
        F.bround(probability, 6).alias("clf_proba"),
        (probability >= 0.5).cast("int").alias("clf_label"),
        X.zone(probability).alias("conf_zone"),
        F.bround(X.clip(amount, S.EMI_MIN, S.EMI_MAX), 2).alias("predicted_emi"),
    ]


def score_with_rules(df: DataFrame, keep=tuple(S.KEY_COLUMNS)) -> DataFrame:
    return df.select(*keep, *score_columns(rule_probability(), rule_amount()))


def zone_counts(scored: DataFrame) -> DataFrame:
    counts = scored.groupBy("conf_zone").agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn(
        "pct", X.share(F.col("rows"), F.sum("rows").over(Window.partitionBy()), 2))


def zone_summary(scored: DataFrame) -> DataFrame:
    """Three counts, total and percentages to one decimal, as one row."""
    one = scored.agg(
        *[F.count_if(F.col("conf_zone") == z).alias(z) for z in ZONES],
        F.count(F.lit(1)).alias("total"))
    return one.select("*", *[X.share(F.col(z), F.col("total"), 1).alias(f"{z}_pct") for z in ZONES])


def batch_summary(scored: DataFrame) -> DataFrame:
    """One row per batch; the median comes from the rank passes, not from one task."""
    median = quantile_map(scored, {
        "emi": F.when(F.col("clf_label") == 1, F.col("predicted_emi"))}).get(("emi", 0.5))
    return scored.agg(
        F.count(F.lit(1)).alias("total_scored"),
        *[F.count_if(F.col("conf_zone") == z).alias(z) for z in ZONES],
        F.bround(F.avg("clf_label") * 100, 2).alias("eligible_pct"),
    ).withColumn("median_emi_inr", F.bround(F.lit(median).cast("double"), 2))


def confidence_label(p: Column | str) -> Column:
    p = X.col(p)
    return (F.when(p > S.AUTO_APPROVE, "Very High")
            .when(p >= S.AUTO_REJECT, "Moderate").otherwise("Low"))


def label_text(label: Column | str) -> Column:
    return F.when(X.col(label) == 1, "Eligible").when(X.col(label) == 0, "Not Eligible")


# --- requests and responses -------------------------------------------------
REQUEST_FLOORS = {
    "monthly_salary": 0, "years_of_employment": 0, "monthly_rent": 0, "family_size": 1,
    "dependents": 0, "school_fees": 0, "college_fees": 0, "travel_expenses": 0,
    "groceries_utilities": 0, "other_monthly_expenses": 0, "current_emi_amount": 0,
}


def request_problems() -> Column:
    """Codes of the constraints a request breaks, in column order."""
    def bad(ok: Column, code: str) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), F.lit(code))

    checks = {"age": bad(F.col("age").between(18, 100), "age")}
    for c, low in REQUEST_FLOORS.items():
        checks[c] = bad(F.col(c) >= low, c)
    for c in S.CRITICAL_COLUMNS:
        checks[c] = bad(F.col(c) > 0, c)
    for c in S.CATEGORICAL_COLUMNS:
        checks[c] = bad(F.col(c).isNotNull(), c)
    return F.array_compact(F.array(*[checks[c] for c in S.REQUEST_COLUMNS if c in checks]))


def validate_requests(df: DataFrame) -> DataFrame:
    """Requests with stripped texts, ``problems`` and ``valid``; nothing is dropped."""
    df = df.withColumns({c: X.strip(c) for c in S.CATEGORICAL_COLUMNS})
    return df.withColumn("problems", request_problems()).withColumn(
        "valid", F.size("problems") == 0)


def id_span(column: str, size: int) -> Column:
    """Number of the span of ``size`` ids that an id falls in, by whole-number division."""
    return F.expr(f"({column} - pmod({column}, {int(size)})) div {int(size)}")


def at_most(size: int) -> Column:
    """Rows of a group, which fails if ids repeat and so fill it beyond its size."""
    n = F.count(F.lit(1))
    return F.when(n <= size, n).otherwise(F.raise_error(F.lit(f"a request of more than {size} customers: ids repeat")).cast("long"))


def batch_requests(df: DataFrame, size: int = S.MAX_UPLOAD_ROWS) -> DataFrame:
    """JSON requests of at most ``size`` customers: a group is a span of unique ids."""
    customer = F.struct("customer_id", *S.REQUEST_COLUMNS)
    return (
        df.groupBy(id_span("application_id", size).alias("request_id"))
        .agg(F.transform(
            F.sort_array(F.collect_list(F.struct("application_id", customer.alias("c")))),
            lambda x: x["c"]).alias("customers"), at_most(size).alias("_n"))
        .filter("_n > 0").select("request_id", F.to_json(F.struct("customers")).alias("body"))
    )


def explode_requests(requests: DataFrame) -> DataFrame:
    """One row per customer of each JSON body, with its position in the request."""
    customers = F.from_json(
        "body", f"customers array<{S.REQUEST_SCHEMA.simpleString()}>")["customers"]
    return requests.select("request_id", F.posexplode(customers).alias("position", "c")).select(
        "request_id", "position", "c.*")


def batch_response(scored: DataFrame, request: Column, total_ms: float) -> DataFrame:
    """Nested response per request of at most 500 customers, in id order."""
    rows = scored.withColumn("request_id", request)
    return rows.groupBy("request_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "application_id", "customer_id", "clf_proba", "clf_label", "conf_zone",
            "predicted_emi", F.lit(False).alias("cache_hit")))).alias("_rows"),
        at_most(S.MAX_UPLOAD_ROWS).alias("total_scored"),
        *[F.count_if(F.col("conf_zone") == z).alias(z) for z in ZONES],
    ).withColumn("total_latency_ms", F.lit(float(total_ms))).withColumn(
        "latency_ms", F.bround(F.col("total_latency_ms") / F.col("total_scored"), 2)
    ).withColumn("predictions", F.transform("_rows", lambda x: F.struct(
        x["customer_id"].alias("customer_id"), x["clf_proba"].alias("clf_proba"),
        x["clf_label"].alias("clf_label"), x["conf_zone"].alias("conf_zone"),
        x["predicted_emi"].alias("predicted_emi"), x["cache_hit"].alias("cache_hit"),
        F.col("latency_ms").alias("latency_ms")))).drop("_rows", "latency_ms")


RESULT_COLUMNS = [
    "customer_id", "conf_zone", "clf_proba", "clf_label", "predicted_emi", "cache_hit", "latency_ms",
]


def results_frame(responses: DataFrame) -> DataFrame:
    """Flat rows of nested responses, label as text, fixed order of what is there."""
    flat = responses.select(F.inline("predictions"))
    if "clf_label" in flat.columns:
        flat = flat.withColumn("clf_label", label_text("clf_label"))
    return flat.select(*[c for c in RESULT_COLUMNS if c in flat.columns])
