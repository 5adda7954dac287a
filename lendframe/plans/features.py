"""The 21 engineered columns, as an ML stage with one fitted scalar."""

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.functions import expr as X
from lendframe.operators.ranks import quantile_map
from lendframe.staging import discard, staged


def total_expenses() -> Column:
    return X.row_sum(S.EXPENSE_COLUMNS)


def _bounded(c: Column, low: float, high: float, missing: float) -> Column:
    return F.coalesce(X.clip(c, low, high), F.lit(missing))


def ratio_features(expense_fallback: float | None) -> dict[str, Column]:
    expenses, salary = total_expenses(), F.col("monthly_salary")
    emi = X.or_zero("current_emi_amount")
    wanted = F.coalesce(X.ratio("requested_amount", "requested_tenure"), F.lit(0.0))
    # a fallback of zero leaves x/0: the upper bound when x > 0, else missing
    fund = X.or_zero("emergency_fund")
    base = F.when(expenses == 0, F.lit(expense_fallback).cast("double")).otherwise(expenses)
    months = F.when((base == 0) & (fund > 0), F.lit(24.0)).otherwise(X.ratio(fund, base))
    return {
        "expense_ratio": _bounded(X.ratio(expenses, salary), 0.0, 2.0, 1.0),
        "emi_burden_ratio": _bounded(X.ratio(emi, salary), 0.0, 1.0, 0.0),
        "requested_emi_monthly": wanted,
        "requested_emi_ratio": _bounded(X.ratio(wanted, salary), 0.0, 2.0, 1.0),
        "total_emi_ratio": _bounded(X.ratio(emi + wanted, salary), 0.0, 2.0, 1.0),
        "disposable_income": X.or_zero("monthly_salary") - expenses,
        "savings_ratio": _bounded(X.ratio(X.or_zero("bank_balance"), salary), 0.0, 100.0, 0.0),
        "emergency_months": _bounded(months, 0.0, 24.0, 0.0),
    }


def band_features() -> dict[str, Column]:
    band = X.credit_band("credit_score")
    return {"credit_score_band": band, "credit_score_ord": X.credit_ordinal(band)}


def capacity_features() -> dict[str, Column]:
    yearly = F.col("monthly_salary") * 12
    return {
        "loan_to_income_ratio": _bounded(X.ratio("requested_amount", yearly), 0.0, 20.0, 0.0),
        "loan_to_balance_ratio": _bounded(
            X.ratio("requested_amount", "bank_balance"), 0.0, 100.0, 50.0),
    }


def interaction_features() -> dict[str, Column]:
    working = X.clip(F.coalesce(F.col("age"), F.lit(25)) - 18, low=1)
    return {
        "credit_x_income": X.or_zero("credit_score") * X.or_zero("monthly_salary") / F.lit(1e7),
        "employment_stability": X.clip(X.or_zero("years_of_employment") / working, 0.0, 1.0),
    }


def flag_features() -> dict[str, Column]:
    burden = _bounded(X.ratio(total_expenses(), "monthly_salary"), 0.0, 2.0, 1.0)
    return {
        "has_emergency_fund": (X.or_zero("emergency_fund") > 0).cast("int"),
        "is_renter": F.col("house_type").eqNullSafe(F.lit("Rented")).cast("int"),
        "high_credit": (X.or_zero("credit_score") >= 750).cast("int"),
        "low_expense_burden": (burden <= 0.5).cast("int"),
    }


def log_features() -> dict[str, Column]:
    return {
        f"log_{c}": F.log1p(X.clip(X.or_zero(c), low=0.0))
        for c in ("bank_balance", "monthly_salary", "requested_amount")
    }


def fit_expense_fallback(df: DataFrame) -> float | None:
    return quantile_map(df, {"expenses": total_expenses()}).get(("expenses", 0.5))


def add_features(df: DataFrame, expense_fallback: float | None) -> DataFrame:
    return df.withColumns(
        ratio_features(expense_fallback) | band_features() | capacity_features()
        | interaction_features() | flag_features() | log_features()
    )


class FeatureBuilder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the median of row-summed expenses."""

    def _fit(self, df: DataFrame) -> "FeatureBuilderModel":
        # one column is written, so the two rank passes do not repeat what made the rows
        sums = staged(df.select(total_expenses().alias("expenses")), "expenses")
        fallback = quantile_map(sums, {"expenses": F.col("expenses")}).get(("expenses", 0.5))
        discard(sums)
        return FeatureBuilderModel()._set(expenseFallback=0.0 if fallback is None else fallback)


class FeatureBuilderModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    expenseFallback = Param(Params._dummy(), "expenseFallback",
                            "denominator where a row has no expenses", TypeConverters.toFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_features(df, self.getOrDefault(self.expenseFallback))

    @property
    def new_feature_names(self) -> list[str]:
        return list(S.ENGINEERED_FEATURES)
