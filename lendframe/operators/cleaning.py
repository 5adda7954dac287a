"""Cleaning steps, one function per step, and the statistics they need.

The order of the steps carries meaning: statistics are taken from the rows and values
the earlier steps left. All statistics are scalars gathered in a few passes, after
which the whole cleaning is one narrow projection.
"""

from dataclasses import asdict, dataclass, field
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe import schema as S
from lendframe.functions import expr as X
from lendframe.operators.ranks import quantile_map

_RAW_NULL = "_raw_null_"


# --- steps 1-5: names, duplicates, numbers ----------------------------------
def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Copies are merged in each task before the shuffle, so hot copies cost little."""
    return df.dropDuplicates()


def _text_numbers(df: DataFrame) -> list[str]:
    return [c for c in S.NUMERIC_COLUMNS
            if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]


def clean_currency(df: DataFrame) -> DataFrame:
    """Each step is a projection of its own, so no text is worked on twice."""
    columns = _text_numbers(df)
    return df.withColumns({c: X.bare_number(c) for c in columns}).withColumns(
        {c: X.known_text(c) for c in columns})


def coerce_numbers(df: DataFrame) -> DataFrame:
    text = _text_numbers(df)
    columns = [c for c in S.NUMERIC_COLUMNS if c in df.columns]
    df = df.withColumns({c: X.strip(c) for c in text})
    df = df.withColumns({c: X.parsed(c) if c in text else F.col(c).cast("double") for c in columns})
    return df.withColumns({c: X.finite(c) for c in columns})


def prepare(df: DataFrame, merge_copies: bool = True) -> DataFrame:
    """Steps 1-5, keeping for the flag columns whether the raw value was null.

    Requests keep their copies: each is answered, and a stream holds no state for it.
    """
    df = normalize_columns(df)
    df = drop_exact_duplicates(df) if merge_copies else df
    raw = {f"{_RAW_NULL}{c}": F.col(c).isNull() for c in S.FLAGGED_COLUMNS if c in df.columns}
    return coerce_numbers(clean_currency(df.withColumns(raw)))


# --- steps 7-8: rows that leave ---------------------------------------------
def is_labeled(c: Column | str = S.TARGET_CLASS) -> Column:
    return F.coalesce(X.col(c).isin(S.ACCEPTED_LABELS), F.lit(False))


def split_labeled(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with an accepted label, and the side output of all others."""
    return df.filter(is_labeled()), df.filter(~is_labeled())


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[c for c in S.CRITICAL_COLUMNS if c in df.columns])


# --- statistics -------------------------------------------------------------
@dataclass
class CleaningStats:
    """Everything the projection needs; a few dozen scalars whatever the data size."""

    flag_gates: dict[str, bool] = field(default_factory=dict)
    null_gates: dict[str, bool] = field(default_factory=dict)
    medians: dict[str, float | None] = field(default_factory=dict)
    bracket_medians: dict[str, dict[str, float]] = field(default_factory=dict)
    global_medians: dict[str, float | None] = field(default_factory=dict)
    positive_salary_median: float | None = None
    modes: dict[str, str] = field(default_factory=dict)
    caps: dict[str, tuple[float, float]] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "CleaningStats":
        return cls(**json.loads(text))


BRACKET_FILLED = ["bank_balance", "groceries_utilities"]


def training_rows(df: DataFrame, training: bool) -> DataFrame:
    if training and S.TARGET_CLASS in df.columns:
        df = df.filter(is_labeled())
    return drop_critical_nulls(df)


def measure(prepared: DataFrame, training: bool = True) -> CleaningStats:
    """Statistics passes over prepared rows, each reading only the columns it needs."""
    stats = CleaningStats()
    keep = F.lit(True)
    if training and S.TARGET_CLASS in prepared.columns:
        keep = is_labeled()
    for c in S.CRITICAL_COLUMNS:
        if c in prepared.columns:
            keep = keep & F.col(c).isNotNull()
    raw = [c for c in S.FLAGGED_COLUMNS if f"{_RAW_NULL}{c}" in prepared.columns]
    gated = [c for c in ["monthly_rent", *BRACKET_FILLED] if c in prepared.columns]
    gates = prepared.agg(F.count_if(keep).alias("kept"), *[
        *[F.coalesce(F.bool_or(f"{_RAW_NULL}{c}"), F.lit(False)).alias(f"raw_{c}") for c in raw],
        *[F.coalesce(F.bool_or(keep & F.col(c).isNull()), F.lit(False)).alias(f"null_{c}")
          for c in gated],
    ]).first()
    stats.flag_gates = {c: gates[f"raw_{c}"] for c in raw}
    stats.null_gates = {c: gates[f"null_{c}"] for c in gated}

    rows = training_rows(prepared, training)
    measure_first_medians(rows, stats)
    stats.modes = measure_modes(rows)
    measure_second_medians(rows, stats)
    stats.caps = measure_caps(apply_rules(fill_missing(rows, stats), stats))
    return stats


def measure_first_medians(rows: DataFrame, stats: CleaningStats) -> None:
    """Plain medians, the renters' median, and medians per salary bracket."""
    values = {c: F.col(c) for c in S.NUMERIC_COLUMNS
              if c in rows.columns and c != S.TARGET_AMOUNT
              and c not in S.ZERO_FILL_COLUMNS and c not in BRACKET_FILLED
              and c not in ("monthly_rent", "credit_score", *S.CRITICAL_COLUMNS)}
    values["renter_rent"] = F.when(F.lower("house_type") == "rented", F.col("monthly_rent"))
    labels = [label for _, label in S.SALARY_BRACKETS]
    cells = {(c, label): F.when(X.in_salary_bracket("monthly_salary", label), F.col(c))
             for c in BRACKET_FILLED for label in labels}
    found = quantile_map(
        rows, values | {f"{c}|{label}": e for (c, label), e in cells.items()})
    stats.medians = {name: found.get((name, 0.5)) for name in values}
    stats.bracket_medians = {
        c: {label: found[f"{c}|{label}", 0.5] for label in labels
            if (f"{c}|{label}", 0.5) in found}
        for c in BRACKET_FILLED
    }


def measure_second_medians(rows: DataFrame, stats: CleaningStats) -> None:
    """Medians that depend on the bracket fill and on the salary fill."""
    salary = F.coalesce(F.col("monthly_salary"), F.lit(stats.medians.get("monthly_salary")))
    values = {c: bracket_filled(c, stats) if stats.null_gates.get(c) else F.col(c)
              for c in BRACKET_FILLED if c in rows.columns}
    values["positive_salary"] = F.when(salary > 0, salary)
    found = quantile_map(rows, values)
    stats.global_medians = {c: found.get((c, 0.5)) for c in BRACKET_FILLED}
    stats.positive_salary_median = found.get(("positive_salary", 0.5))


def measure_modes(rows: DataFrame) -> dict[str, str]:
    """Most frequent good value per category column; the smallest one on ties."""
    columns = [c for c in S.CATEGORICAL_COLUMNS if c in rows.columns]
    # spellings are counted first, so texts are standardized once per distinct value
    counted = (rows.select(*[F.col(c).cast("string").alias(c) for c in columns])
               .unpivot([], columns, "column", "raw")
               .groupBy("column", "raw").agg(F.count(F.lit(1)).alias("n")))
    text = F.lit(None).cast("string")
    for c in columns:
        text = F.when(F.col("column") == c, standard_text(c, F.col("raw"))).otherwise(text)
    best = (
        counted.select("column", text.alias("value"), "n")
        .filter(~F.col("value").isin(S.NULL_STRINGS))
        .groupBy("column", "value").agg(F.sum("n").alias("n"))
        .groupBy("column").agg(
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    )
    return {r["column"]: r["mode"] for r in best.collect()}


def measure_caps(ruled: DataFrame) -> dict[str, tuple[float, float]]:
    columns = [c for c in S.CAP_COLUMNS if c in ruled.columns]
    found = quantile_map(ruled, {c: F.col(c) for c in columns}, S.CAP_PROBABILITIES)
    low, high = S.CAP_PROBABILITIES
    return {c: (found[c, low], found[c, high]) for c in columns if (c, low) in found}


# --- step 6: flags ----------------------------------------------------------
def missing_flags(df: DataFrame, gates: dict[str, bool] | None) -> DataFrame:
    """A flag is set only if its column held a null before the numbers were read.

    Without gates every prepared row is its own batch: its flag is its raw null.
    """
    if gates is None:
        return df.withColumns({
            f"{c}_missing": F.col(f"{_RAW_NULL}{c}").cast("int")
            for c in S.FLAGGED_COLUMNS if c in df.columns
        })
    return df.withColumns({
        f"{c}_missing": (F.col(c).isNull().cast("int") if gates.get(c) else F.lit(0))
        for c in S.FLAGGED_COLUMNS if c in df.columns
    })


# --- step 9: fills ----------------------------------------------------------
def rent_filled(renter_median: float | None) -> Column:
    rent = F.col("monthly_rent")
    house = F.col("house_type")
    return (
        F.when(rent.isNotNull(), rent)
        .when(F.coalesce(house.isin(S.RENT_FREE_HOUSES), F.lit(False)), F.lit(0.0))
        .when(F.lower(house) == "rented", F.coalesce(F.lit(renter_median).cast("double"), F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )


def bracket_median(c: str, stats: CleaningStats) -> Column:
    medians = stats.bracket_medians.get(c, {})
    salary = F.col("monthly_salary")
    return F.when(salary > 0, X.stepped(
        salary, [(bound, medians.get(label)) for bound, label in S.SALARY_BRACKETS]))


def bracket_filled(c: str, stats: CleaningStats) -> Column:
    """Null outside the salary brackets, even where the value was known."""
    return F.when(F.col("monthly_salary") > 0, F.coalesce(F.col(c), bracket_median(c, stats)))


def fill_missing(df: DataFrame, stats: CleaningStats, single: bool = False) -> DataFrame:
    """Fills of a batch; ``single`` treats every row as a batch of its own."""
    def constant(c, value):
        return F.coalesce(F.col(c), F.lit(value).cast("double"))

    fills: dict[str, Column] = {}
    for c in S.NUMERIC_COLUMNS:
        if c not in df.columns or c == S.TARGET_AMOUNT:
            continue
        if c == "monthly_rent":
            fills[c] = rent_filled(stats.medians.get("renter_rent"))
        elif c == "credit_score":
            fills[c] = constant(c, S.NO_CREDIT_SCORE)
        elif c in BRACKET_FILLED:
            overall = F.lit(stats.global_medians.get(c)).cast("double")
            if single:
                fills[c] = F.coalesce(F.col(c), bracket_median(c, stats), overall)
            elif stats.null_gates.get(c):
                fills[c] = F.coalesce(bracket_filled(c, stats), overall)
        elif c in S.ZERO_FILL_COLUMNS:
            fills[c] = constant(c, 0)
        elif c not in S.CRITICAL_COLUMNS:
            fills[c] = constant(c, stats.medians.get(c))
    if "education" in df.columns:
        fills["education"] = F.coalesce(F.col("education"), F.lit("Unknown"))
    return df.withColumns(fills)


# --- steps 10-12: categories ------------------------------------------------
def trimmed_text(source: Column | str) -> Column:
    return F.coalesce(X.strip(X.col(source).cast("string")), F.lit("nan"))


def mapped_text(c: str, source: Column | None = None) -> Column:
    """Spelling map, then title case, of one category column."""
    text = trimmed_text(c if source is None else source)
    if c in S.VALUE_MAPS:
        text = X.mapped(text, S.VALUE_MAPS[c])
    return X.title_case(text) if c in S.TITLE_COLUMNS else text


def standard_text(c: str, source: Column) -> Column:
    """Steps 10-11 for one column, after the education fill of step 9."""
    return mapped_text(c, F.coalesce(source, F.lit("Unknown")) if c == "education" else source)


def null_text_filled(c: str, text: Column, modes: dict[str, str]) -> Column:
    fill = "Unknown" if c in ("education", "gender") else modes.get(c, "Unknown")
    return F.when(text.isin(S.NULL_STRINGS), F.lit(fill)).otherwise(text)


def standardize_categories(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    df = df.withColumns({
        c: mapped_text(c) for c in S.CATEGORICAL_COLUMNS if c in df.columns
    } | ({S.TARGET_CLASS: trimmed_text(S.TARGET_CLASS)} if S.TARGET_CLASS in df.columns else {}))
    return df.withColumns({
        c: null_text_filled(c, F.col(c), modes) for c in S.CATEGORICAL_COLUMNS if c in df.columns
    })


# --- steps 13-15: rules, types, caps ----------------------------------------
def apply_rules(df: DataFrame, stats: CleaningStats) -> DataFrame:
    """Domain clips, non-negative money, repaired salary, whole-number columns."""
    df = df.withColumns({
        c: X.clip(c, float(low), float(high))
        for c, (low, high) in S.DOMAIN_BOUNDS.items() if c in df.columns
    })
    rules = {c: X.clip(c, low=0.0) for c in S.NON_NEGATIVE_COLUMNS if c in df.columns}
    if "monthly_salary" in df.columns:
        rules["monthly_salary"] = repaired_salary(stats.positive_salary_median)
    df = df.withColumns(rules)
    return df.withColumns({
        c: F.bround(c, 0).cast("int") for c in S.INTEGER_COLUMNS if c in df.columns
    })


def repaired_salary(positive_median: float | None) -> Column:
    salary = F.col("monthly_salary")
    return F.when(salary <= 0, F.lit(positive_median).cast("double")).otherwise(salary)


def cap_outliers(df: DataFrame, caps: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({
        c: X.clip(c, low, high) for c, (low, high) in caps.items() if c in df.columns
    })


# --- step 16: target --------------------------------------------------------
def encoded_target() -> Column:
    label = F.col(S.TARGET_CLASS)
    return (F.when(label == S.POSITIVE_LABEL, F.lit(1))
            .when(label.isin(S.NEGATIVE_LABELS), F.lit(0)))


def encode_target(df: DataFrame) -> DataFrame:
    return df.withColumn(S.TARGET_CLASS, encoded_target()).dropna(subset=[S.TARGET_CLASS])


# --- the whole --------------------------------------------------------------
def project(prepared: DataFrame, stats: CleaningStats, training: bool = True,
            single: bool = False) -> DataFrame:
    """Steps 6-16 as one projection over prepared rows.

    ``single``: the statistics come from elsewhere and each row is cleaned for itself.

    Rows carry ``application_id``, so the closing duplicate check of the table
    cannot find copies that the opening one left; without keys it is made.
    """
    df = missing_flags(prepared, None if single else stats.flag_gates)
    df = training_rows(df, training)
    df = standardize_categories(fill_missing(df, stats, single), stats.modes)
    df = cap_outliers(apply_rules(df, stats), stats.caps)
    if training and S.TARGET_CLASS in df.columns:
        df = encode_target(df)
    if not training:
        df = df.drop(S.TARGET_CLASS, S.TARGET_AMOUNT)
    df = df.drop(*[c for c in df.columns if c.startswith(_RAW_NULL)])
    return df if single or "application_id" in df.columns else drop_exact_duplicates(df)
