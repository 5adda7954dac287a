import math

import pytest
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.operators import cache, scoring
from lendframe.plans.cleaner import clean
from lendframe.plans.encoder import LoanEncoder, encode, vocabulary
from lendframe.plans.features import FeatureBuilder, FeatureBuilderModel, add_features


@pytest.fixture(scope="module")
def cleaned(sample):
    return clean(sample).persist()


def one(table, fallback=1000.0, **extra):
    df = table(extra).withColumn("age", F.col("age").cast("int")).withColumn(
        "monthly_salary", F.col("monthly_salary").cast("double"))
    return add_features(df, fallback).first()


def test_all_names_are_added_and_originals_kept(cleaned):
    out = FeatureBuilder().fit(cleaned).transform(cleaned)
    assert out.columns[-21:] == S.ENGINEERED_FEATURES
    assert out.columns[:-21] == cleaned.columns


def test_transform_before_fit_fails(cleaned):
    with pytest.raises(KeyError):
        FeatureBuilderModel().transform(cleaned)


def test_ratio_is_bounded(cleaned):
    low, high = add_features(cleaned, 1.0).agg(F.min("expense_ratio"), F.max("expense_ratio")).first()
    assert 0 <= low <= high <= 2


def test_zero_salary_and_tenure(table):
    r = one(table, monthly_salary="0", requested_tenure=0.0)
    assert (r["expense_ratio"], r["emi_burden_ratio"], r["requested_emi_monthly"]) == (1.0, 0.0, 0.0)
    assert (r["requested_emi_ratio"], r["savings_ratio"], r["loan_to_income_ratio"]) == (1.0, 0.0, 0.0)
    assert r["disposable_income"] == -8000.0 and r["low_expense_burden"] == 0


def test_no_expenses_use_the_fallback(table):
    none = {c: 0.0 for c in S.EXPENSE_COLUMNS}
    assert one(table, 4000.0, **none)["emergency_months"] == 5.0
    assert one(table, 0.0, **none)["emergency_months"] == 24.0
    assert one(table, 0.0, emergency_fund=0.0, **none)["emergency_months"] == 0.0


def test_nulls(table):
    r = one(table, credit_score=None, bank_balance=None, emergency_fund=None, house_type=None)
    assert r["credit_score_band"] is None and r["credit_score_ord"] == 0 and r["high_credit"] == 0
    assert r["loan_to_balance_ratio"] == 50.0 and r["is_renter"] == 0 and r["has_emergency_fund"] == 0
    assert r["log_bank_balance"] == 0.0


def test_band_and_flag_differ_between_whole_scores(table):
    r = one(table, credit_score=749.5)
    assert r["credit_score_band"] == "Excellent" and r["high_credit"] == 0


def test_formulas(table):
    r = one(table, house_type="Rented", monthly_rent=10000.0, current_emi_amount=2000.0, credit_score=720.0)
    assert math.isclose(r["expense_ratio"], 20000 / 50000)
    assert math.isclose(r["total_emi_ratio"], (2000 + 300000 / 36) / 50000)
    assert math.isclose(r["loan_to_income_ratio"], 0.5)
    assert math.isclose(r["employment_stability"], 5 / 12)
    assert r["is_renter"] == 1 and r["low_expense_burden"] == 1


def test_align_adds_missing_and_drops_extra_columns(spark):
    df = spark.createDataFrame([(30, "Male"), (35, "Female")], "age int, gender string")
    out = encode(df, {"gender": ["Female", "Male"]}, ["age", "gender_Male", "gender_Other"])
    assert out.columns == ["age", "gender_Male", "gender_Other"]
    assert [tuple(r) for r in out.collect()] == [(30, 1, 0), (35, 0, 0)]


def test_single_row_keeps_its_dummies(cleaned):
    encoder = LoanEncoder().fit(add_features(cleaned, 1.0))
    one_row = add_features(cleaned.filter("gender = 'Male'").limit(1), 1.0)
    got = encoder.encode(one_row).first()
    assert got["gender_Male"] == 1
    assert list(got.asDict()) == encoder.feature_names()


def test_first_level_and_unseen_levels_give_zeros(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "g string")
    vocab = vocabulary(df, ["g"])
    assert vocab == {"g": ["a", "b", "c"]}
    out = encode(spark.createDataFrame([("a",), ("z",), (None,), ("c",)], "g string"), vocab, ["g_b", "g_c"])
    assert [tuple(r) for r in out.collect()] == [(0, 0), (0, 0), (0, 0), (0, 1)]


def test_columns_of_too_many_levels_are_named(spark):
    from pyspark.ml import Pipeline

    from lendframe.plans.encoder import sparse_stages

    rows = spark.range(5).select(F.col("id").cast("string").alias("g"), F.lit("a").alias("h"))
    with pytest.raises(ValueError, match="levels in g$"):
        vocabulary(rows, ["g", "h"], max_levels=3)
    vectors = Pipeline(stages=sparse_stages(["g", "h"])).fit(rows).transform(rows).collect()
    assert all(r.sparse_levels.numNonzeros() == 2 for r in vectors)


def test_infinities_become_zero(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (None,), (2.0,)], "x double")
    assert [r[0] for r in encode(df, {}, ["x"]).collect()] == [0.0, 0.0, 0.0, 2.0]


# --- scoring ----------------------------------------------------------------
def test_rules_at_the_extremes(table):
    good = table(dict(credit_score=750.0, monthly_salary="60000")).withColumn(
        "monthly_salary", F.col("monthly_salary").cast("double"))
    bad = table(dict(credit_score=400.0, monthly_salary="9000")).withColumn(
        "monthly_salary", F.col("monthly_salary").cast("double"))
    assert good.select(scoring.rule_probability()).first()[0] == scoring.PROBA_ELIGIBLE
    assert bad.select(scoring.rule_probability()).first()[0] == scoring.PROBA_REJECT


def test_summary_counts_add_up(cleaned):
    r = scoring.zone_summary(scoring.score_with_rules(cleaned)).first()
    assert r["auto_approve"] + r["human_review"] + r["auto_reject"] == r["total"] == 10


def test_amounts_are_bounded_and_zones_use_the_exact_probability(spark):
    df = spark.createDataFrame([(0.8500004, -5.0), (0.85, 1e9), (0.3999999, 7000.005)], "p double, a double")
    out = df.select(*scoring.score_columns(F.col("p"), F.col("a"))).collect()
    assert [r["conf_zone"] for r in out] == ["auto_approve", "human_review", "auto_reject"]
    assert [r["clf_proba"] for r in out] == [0.85, 0.85, 0.4]
    assert [r["predicted_emi"] for r in out][:2] == [500.0, 34750.0]


def test_request_constraints(table):
    df = table(dict(age="17"), dict(age="101", requested_amount=0.0), dict(gender=None, family_size=0.0),
               dict(credit_score=None, bank_balance=None, emergency_fund=None), dict(gender=" Male "))
    typed = df.withColumns({c: F.col(c).cast("double") for c in ("age", "monthly_salary")})
    out = {r["application_id"]: r for r in scoring.validate_requests(typed).collect()}
    assert out[1]["problems"] == ["age"] and out[2]["problems"] == ["age", "requested_amount"]
    assert out[3]["problems"] == ["gender", "family_size"]
    assert out[4]["valid"] and out[5]["valid"] and out[5]["gender"] == "Male"


def test_request_and_response_round_trip(cleaned):
    requests = scoring.batch_requests(cleaned, size=4)
    assert requests.count() == 3
    back = scoring.explode_requests(requests)
    assert sorted(r["customer_id"] for r in back.collect()) == sorted(
        r["customer_id"] for r in cleaned.collect())
    response = scoring.batch_response(scoring.score_with_rules(cleaned), F.floor(F.col("application_id") / 4), 12.0)
    flat = scoring.results_frame(response)
    assert flat.columns == scoring.RESULT_COLUMNS and flat.count() == 10
    assert {r["clf_label"] for r in flat.collect()} <= {"Eligible", "Not Eligible"}


# --- cache table ------------------------------------------------------------
def at(text="2024-01-01 00:00:00"):
    return F.lit(text).cast("timestamp")


def test_store_lookup_expiry_and_delete(cleaned):
    store = cache.batch_write(cleaned, ["age", "monthly_salary"], written_at=at())
    alive = cache.lookup(cleaned, store, at("2024-01-01 23:59:59"))
    assert alive.filter("cache_hit").count() == 10
    ended = cache.lookup(cleaned, store, at("2024-01-02 00:00:00"))
    assert ended.filter("cache_hit").count() == 0
    gone = cleaned.filter("application_id <= 3")
    assert cache.invalidate(store, gone).count() == 7
    assert cache.uncached(cleaned, cache.invalidate(store, gone), at()).count() == 3


def test_blank_ids_are_errors_and_later_rows_win(table):
    df = table(dict(customer_id="A", age="1"), dict(customer_id="A", age="2"), dict(customer_id="  "),
               dict(customer_id=None))
    store = cache.batch_write(df, ["age"], written_at=at()).collect()
    assert [r["payload"] for r in store] == ['{"age":"2"}']
    assert tuple(cache.write_counts(df).first()) == (2, 2)


def test_key_never_holds_the_plain_id(spark):
    import hashlib

    key = spark.range(1).select(cache.cache_key(F.lit("CUST-1"))).first()[0]
    assert key == "emi:features:" + hashlib.sha256(b"CUST-1").hexdigest()[:16]


def test_content_key_ignores_column_order(cleaned):
    a = cleaned.select(cache.content_key(cleaned, ["age", "gender"])).collect()
    b = cleaned.select(cache.content_key(cleaned, ["gender", "age"])).collect()
    assert a == b
