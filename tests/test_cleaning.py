import pytest
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.operators import cleaning as C
from lendframe.operators import profiling as P
from lendframe.plans.cleaner import LoanCleaner, LoanCleanerModel, clean


def rows(df, *columns):
    got = {r["application_id"]: r for r in df.collect()}
    if len(columns) == 1:
        return {k: r[columns[0]] for k, r in got.items()}
    return {k: tuple(r[c] for c in columns) for k, r in got.items()}


def test_copies_are_removed(sample):
    assert clean(sample.unionByName(sample)).count() == sample.count()


def test_copies_with_nulls_are_equal(table):
    df = table(dict(credit_score=None), dict(credit_score=None, application_id=1, customer_id="CUST-1"))
    assert C.prepare(df).count() == 1


def test_unkeyed_table_is_deduplicated_after_cleaning(table):
    """Spelling variants that become equal are copies by then."""
    df = table(dict(gender="M"), dict(gender="Male"), dict(gender="F"), keyed=False)
    assert clean(df).count() == 2


def test_keyed_rows_that_become_equal_stay(table):
    assert clean(table(dict(gender="M"), dict(gender="Male"))).count() == 2


def test_flag_needs_a_null_in_the_raw_column(table):
    """A bad number is flagged only where the column also had a true null."""
    text = table({}, {}).withColumn("credit_score", F.when(F.col("application_id") == 1, "oops").otherwise("700"))
    assert rows(clean(text), "credit_score_missing", "credit_score") == {1: (0, 300.0), 2: (0, 700.0)}
    nulls = text.unionByName(text.withColumn("credit_score", F.lit(None).cast("string")).withColumn(
        "application_id", F.col("application_id") + 10))
    assert rows(clean(nulls), "credit_score_missing") == {1: 1, 2: 0, 11: 1, 12: 1}


def test_all_flags_exist_always(sample):
    out = clean(sample)
    assert set(S.FLAG_COLUMNS) <= set(out.columns)
    assert out.agg(*[F.sum(c) for c in S.FLAG_COLUMNS]).first() == (0,) * 5


def test_padded_and_unknown_labels_leave(table):
    df = table(dict(emi_eligibility=" Eligible "), dict(emi_eligibility="High_Risk"),
               dict(emi_eligibility=None), dict(emi_eligibility="Not eligible"), {})
    assert rows(clean(df), S.TARGET_CLASS) == {4: 0, 5: 1}
    assert set(rows(C.split_labeled(df)[1], S.TARGET_CLASS)) == {1, 2, 3}


def test_inference_keeps_unlabelled_rows_and_drops_targets(table):
    out = clean(table(dict(emi_eligibility="High_Risk"), {}), training=False)
    assert out.count() == 2
    assert S.TARGET_CLASS not in out.columns and S.TARGET_AMOUNT not in out.columns


def test_rows_without_amount_or_tenure_leave(table):
    df = table(dict(requested_amount=None), dict(requested_tenure=None), {})
    assert set(rows(clean(df), "age")) == {3}


def test_rent_by_house(table):
    df = table(dict(house_type="Own", monthly_rent=None), dict(house_type="oWn", monthly_rent=None),
               dict(house_type="RENTED", monthly_rent=None), dict(house_type="Rented", monthly_rent=6000.0),
               dict(house_type="rented", monthly_rent=8000.0), dict(house_type=None, monthly_rent=None))
    stats = C.measure(C.prepare(df))
    filled = rows(C.fill_missing(C.training_rows(C.prepare(df), True), stats), "monthly_rent")
    assert filled == {1: 0.0, 2: 0.0, 3: 7000.0, 4: 6000.0, 5: 8000.0, 6: 0.0}


def test_rent_without_renters_is_zero(table):
    df = table(dict(house_type="Rented", monthly_rent=None), {})
    assert rows(clean(df), "monthly_rent")[1] == 0.0


def test_bracket_fill_erases_known_values_outside_brackets(table):
    """With a null somewhere, rows of no bracket get the global median even if known."""
    df = table(dict(monthly_salary="bad", bank_balance=999999.0), dict(monthly_salary="0", bank_balance=888888.0),
               dict(monthly_salary="30000", bank_balance=100.0), dict(monthly_salary="30000", bank_balance=300.0),
               dict(monthly_salary="30000", bank_balance=None), dict(monthly_salary="90000", bank_balance=None))
    prepared = C.prepare(df)
    filled = rows(C.fill_missing(C.training_rows(prepared, True), C.measure(prepared)), "bank_balance")
    # bracket medians give 100, 300, 200; the last bracket knows nothing
    assert filled == {1: 200.0, 2: 200.0, 3: 100.0, 4: 300.0, 5: 200.0, 6: 200.0}


def test_bracket_fill_is_skipped_without_nulls(table):
    df = table(dict(monthly_salary="bad", bank_balance=999.0), dict(bank_balance=5.0))
    prepared = C.prepare(df)
    assert rows(C.fill_missing(prepared, C.measure(prepared)), "bank_balance") == {1: 999.0, 2: 5.0}


def test_mode_tie_takes_the_smaller_text(table):
    df = table(dict(company_type="nan"), dict(company_type="Startup"), dict(company_type="Mnc"), dict(company_type=None))
    assert rows(clean(df), "company_type") == {1: "Mnc", 2: "Startup", 3: "Mnc", 4: "Mnc"}


def test_null_texts_of_gender_education_and_loans(table):
    df = table(dict(gender="NA", education=None, existing_loans="None"), dict(existing_loans="y", education="-"))
    assert rows(clean(df), "gender", "education", "existing_loans") == {
        1: ("Unknown", "Unknown", "Yes"), 2: ("Male", "Unknown", "Yes")}


def test_spelling_maps(table):
    df = table(dict(gender="M", employment_type="self employed", company_type="midsize",
                    emi_scenario="e-commerce shopping emi", marital_status=" SINGLE ", house_type="FAMILY"),
               dict(gender="f", education="post-graduate"))
    out = rows(clean(df), "gender", "employment_type", "company_type", "emi_scenario", "marital_status",
               "house_type", "education")
    assert out[1] == ("Male", "Self-Employed", "Mid-Size", "E-Commerce Shopping Emi", "Single", "Family", "Graduate")
    assert out[2][0] == "Female" and out[2][6] == "Post-Graduate"


def test_salary_is_repaired_from_positive_ones(table):
    df = table(dict(monthly_salary="0"), dict(monthly_salary="-5"), dict(monthly_salary="40000"),
               dict(monthly_salary="60000"), dict(monthly_salary="oops"))
    prepared = C.prepare(df)
    stats = C.measure(prepared)
    ruled = rows(C.apply_rules(C.fill_missing(prepared, stats), stats), "monthly_salary")
    # the unreadable one takes the median of all read values, 20000, before the repair
    assert ruled == {1: 40000.0, 2: 40000.0, 3: 40000.0, 4: 60000.0, 5: 20000.0}


def test_outlier_is_capped(sample):
    extreme = sample.withColumn("monthly_salary", F.when(F.col("application_id") == 1, "1000000000").otherwise(
        F.col("monthly_salary")))
    assert clean(extreme).agg(F.max("monthly_salary")).first()[0] < 1e9


def test_whole_numbers_round_half_to_even(table):
    df = table(dict(family_size=2.5, dependents=0.5), dict(family_size=3.5, dependents=1.5))
    assert rows(clean(df), "family_size", "dependents") == {1: (2, 0), 2: (4, 2)}


def test_fitted_statistics_do_not_cap_a_single_request_to_itself(spark, sample, table, tmp_path):
    model = LoanCleaner(training=True).fit(sample)
    model.write().overwrite().save(str(tmp_path / "cleaner"))
    loaded = LoanCleanerModel.load(str(tmp_path / "cleaner")).for_inference()
    one = table(dict(monthly_salary="61000", bank_balance=None, company_type="nan"))
    out = loaded.transform(one).first()
    assert out["monthly_salary"] == 61000.0
    assert out["company_type"] == "Mnc" and out["bank_balance"] == 230000.0
    assert out["bank_balance_missing"] == 1 and out["credit_score_missing"] == 0
    assert model.cleaning_stats() == loaded.cleaning_stats()


def test_statistics_of_an_empty_batch(table):
    empty = table({}).limit(0)
    assert clean(empty).count() == 0


def test_dirty_values_are_listed(table):
    df = table(dict(age="30.0.0"), dict(age="30.0.0"), dict(monthly_salary="n/a"), {})
    assert {tuple(r) for r in P.dirty_values(df).collect()} == {
        ("age", "30.0.0", 2), ("monthly_salary", "n/a", 1)}


def test_duplicate_audit_counts_hot_copies(table):
    df = table(*[dict(application_id=1, customer_id="A")] * 9, {})
    assert tuple(P.audit_duplicates(df).first()) == (10, 2, 8)


def test_correlation_with_nulls_is_pairwise(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.RandomState(0)
    data = pd.DataFrame(rng.randn(60, 3), columns=list("abc"))
    data.loc[::7, "b"] = np.nan
    rows_ = [tuple(None if pd.isna(v) else float(v) for v in r) for r in data.to_numpy()]
    got = P.correlation_matrix(spark.createDataFrame(rows_, "a double, b double, c double"), ("a", "b", "c")).collect()
    want = data.corr()
    assert len(got) == 3
    for r in got:
        assert r["r"] == pytest.approx(want.loc[r["row_name"], r["column_name"]], abs=1e-6)


def test_correlation_is_one_scan_and_keeps_digits(spark):
    import numpy as np

    rng = np.random.RandomState(1)
    base = 1e9 + rng.randn(500)
    data = np.column_stack([base, base * 2 + rng.randn(500) * 0.1, rng.rand(500), np.full(500, 7.0)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double, d double")
    got = P.correlation_matrix(df, ("a", "b", "c", "d"))
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") + text.count("LocalRelation") == 1
    found = {(r.row_name, r.column_name): r.r for r in got.collect()}
    want = np.corrcoef(data[:, :3].T)
    assert found["b", "a"] == pytest.approx(want[1, 0], abs=1e-6) and found["c", "b"] == pytest.approx(want[2, 1], abs=1e-6)
    assert found["d", "a"] is None and found["d", "c"] is None
    assert P.correlation_matrix(df.filter("false"), ("a", "b")).collect() == []
    none = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert [r.r for r in P.correlation_matrix(none, ("a", "b")).collect()] == [None]


def test_density_by_windows_equals_all_terms(spark):
    import numpy as np

    rng = np.random.RandomState(2)
    values = {0: np.concatenate([rng.randn(400) * 50 + 600, [300.0, 899.0]]), 1: rng.rand(300) * 5, 2: np.ones(50), 3: [1.0, 2.0]}
    rows = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], f"{S.TARGET_CLASS} int, x double")
    found = {(r.target, r.point): r.density for r in P.density(rows, "x", 300.0, 900.0, 60).collect()}
    assert {k for k, _ in found} == {0, 1} and len(found) == 120
    for k in (0, 1):
        x = np.asarray(values[k])
        h = x.std(ddof=1) * len(x) ** -0.2
        at = 300 + np.arange(60) * (600 / 59)
        want = np.exp(-((at[:, None] - x[None, :]) / h) ** 2 / 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
        assert np.allclose([found[k, i] for i in range(60)], want, rtol=0, atol=1e-12 / h)


def test_unexpected_values_are_counted_with_nulls(table):
    df = table(dict(gender="Male"), dict(gender="Martian"), dict(gender="Martian"), dict(gender=None))
    got = {(r["column"], r["value"]): r["rows"] for r in P.unexpected_values(df, {"gender": ["Male", "Female"]}).collect()}
    assert got == {("gender", "Martian"): 2, ("gender", None): 1}


def test_cleaning_report_counts_both_sides(spark):
    raw = spark.createDataFrame([("a", 1), ("a", 1), (None, 0)], f"x string, {S.TARGET_CLASS} int")
    done = spark.createDataFrame([("a", 1, 0)], f"x string, {S.TARGET_CLASS} int, flag int")
    r = P.cleaning_report(raw, done).first()
    assert (r.raw_rows, r.raw_nulls, r.raw_duplicates, r.clean_rows, r.clean_nulls, r.clean_duplicates) == (3, 1, 1, 1, 0, 0)
    assert (r.eligible_pct, r.rows_removed, r.new_columns) == (100.0, 2, "flag")
