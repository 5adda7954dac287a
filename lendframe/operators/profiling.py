"""Audits, summaries and descriptive statistics."""

from functools import reduce
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe import schema as S
from lendframe.functions import expr as X
from lendframe.functions import pvalues
from lendframe.operators import cleaning as C
from lendframe.operators.ranks import (
    exact_quantiles, group_medians, long_values, quantile_map,
)


def whole(c: str) -> Column:
    """Total over a result that is already small."""
    return F.sum(c).over(Window.partitionBy())


def _texts(df: DataFrame, columns=None) -> DataFrame:
    columns = [c for c in (columns or df.columns) if c in df.columns]
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value")


def _counts(df: DataFrame, tests: dict[str, Column], name: str) -> DataFrame:
    """One scan of conditional counts, turned into rows."""
    one = df.agg(*[F.count_if(t).alias(c) for c, t in tests.items()])
    return one.unpivot([], list(tests), "column", name)


# --- loading ----------------------------------------------------------------
def missing_columns(df: DataFrame, expected=tuple(S.EXPECTED_COLUMNS)) -> list[str]:
    have = {c.strip().lower() for c in df.columns}
    return [c for c in expected if c not in have]


def null_map(df: DataFrame, columns=None) -> DataFrame:
    columns = columns or df.columns
    return _counts(df, {c: F.col(c).isNull() for c in columns}, "nulls").filter("nulls > 0")


def input_bytes(spark, path: str) -> int:
    """Size of all files of an input."""
    files = spark.read.format("binaryFile").load(path).agg(F.coalesce(F.sum("length"), F.lit(0)))
    return files.first()[0]


def load_summary(df: DataFrame) -> DataFrame:
    """Rows, nulls, null share and type per column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    one = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in df.columns])
    long = one.unpivot(["rows"], [f"n_{c}" for c in df.columns], "column", "nulls")
    long = long.withColumn("column", F.expr("substring(column, 3)"))
    kinds = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return long.select("column", kinds[F.col("column")].alias("type"), "rows", "nulls",
                       X.share(F.col("nulls"), F.col("rows"), 1).alias("null_pct"))


def row_count_gate(df: DataFrame, minimum: int = 0, maximum: int | None = None) -> dict:
    """Stops counting as soon as the answer is known."""
    edge = max(minimum, (maximum or 0) + 1)
    seen = df.limit(edge).count()
    return {"empty": seen == 0, "enough": seen >= minimum,
            "within": maximum is None or seen <= maximum, "columns": len(df.columns)}


def dirty_values(df: DataFrame) -> DataFrame:
    """Raw texts of the numeric columns that did not become a number, with counts."""
    columns = [c for c in S.NUMERIC_COLUMNS if c in df.columns
               and isinstance(df.schema[c].dataType, T.StringType)]
    counted = _texts(df, columns).filter(F.col("value").isNotNull()).groupBy(
        "column", "value").agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(X.to_number(X.strip_currency("value")).isNull())


def numeric_column_names(df: DataFrame) -> DataFrame:
    """The numeric, non-target columns of a frame; nulls per column tie it to the data."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)
             and f.name not in (S.TARGET_CLASS, S.TARGET_AMOUNT)]
    return _counts(df, {c: F.col(c).isNotNull() for c in names}, "present")


# --- audits -----------------------------------------------------------------
def audit_profile(df: DataFrame) -> DataFrame:
    """Nulls and exact distinct counts. Values are counted before they are distinct."""
    kinds = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    values = _texts(df).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    ).withColumn("type", kinds[F.col("column")])


def value_counts(df: DataFrame, columns) -> DataFrame:
    return _texts(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def audit_labels(df: DataFrame, columns) -> DataFrame:
    counts = value_counts(df, columns)
    # one total per column
    totals = F.broadcast(counts.groupBy("column").agg(F.sum("rows").alias("_total")))
    text = F.coalesce(F.col("value"), F.lit("nan"))
    note = (F.when((F.col("column") == "gender") & text.isin(S.GENDER_ABBREVIATIONS), "abbreviation")
            .when(F.lower(text).isin(S.SUSPICIOUS_LABELS), "suspicious").otherwise("ok"))
    return counts.join(totals, "column").select(
        "column", "value", "rows", X.share(F.col("rows"), F.col("_total"), 1).alias("pct"), note.alias("note"))


def audit_ranges(df: DataFrame, bounds=S.AUDIT_BOUNDS) -> DataFrame:
    cells = []
    for c, (low, high) in bounds.items():
        if c in df.columns:
            x = F.col(c).cast("double")
            cells += [
                F.count_if(x < low).alias(f"below|{c}") if low is not None
                else F.lit(0).cast("long").alias(f"below|{c}"),
                F.count_if(x > high).alias(f"above|{c}") if high is not None
                else F.lit(0).cast("long").alias(f"above|{c}"),
                F.min(x).alias(f"min|{c}"), F.max(x).alias(f"max|{c}"),
            ]
    one = df.agg(*cells)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[
            F.col(f"`{part}|{c}`").alias(f"{part}_bound" if part in ("below", "above") else f"{part}_value")
            for part in ("below", "above", "min", "max")])
        for c in bounds if c in df.columns
    ])
    return one.select(F.inline(rows))


def audit_hidden_nulls(df: DataFrame, columns=None) -> DataFrame:
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return _texts(df, columns).filter(F.col("value").isin(S.HIDDEN_NULLS)).groupBy(
        "column", "value").agg(F.count(F.lit(1)).alias("rows"))


def audit_flags(df: DataFrame) -> DataFrame:
    flags = [c for c in S.FLAG_COLUMNS if c in df.columns]
    long = df.select(*[F.col(c).cast("long").alias(c) for c in flags]).unpivot(
        [], flags, "column", "value")
    return long.groupBy("column").agg(
        F.min("value").alias("lowest"), F.max("value").alias("highest"),
        F.sum("value").alias("flagged"),
        F.bool_and(F.col("value").isin(0, 1)).alias("valid"))


def audit_target(df: DataFrame) -> DataFrame:
    counts = df.groupBy(F.col(S.TARGET_CLASS).alias("target")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(
        "target", "rows", X.share(F.col("rows"), whole("rows"), 1).alias("pct"),
        F.coalesce(F.col("target").isin(0, 1), F.lit(False)).alias("expected"))


def audit_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each kind; copies are counted before the shuffle."""
    kinds = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return kinds.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
                     F.count(F.lit(1)).alias("distinct_rows")).select(
        "rows", "distinct_rows", (F.col("rows") - F.col("distinct_rows")).alias("duplicates"))


def unexpected_values(df: DataFrame, allowed=S.ALLOWED_VALUES) -> DataFrame:
    counts = value_counts(df, list(allowed))
    fine = reduce(lambda a, b: a | b, [
        (F.col("column") == c) & F.col("value").isin(v) for c, v in allowed.items()])
    return counts.filter(~F.coalesce(fine, F.lit(False)))


def final_null_check(df: DataFrame) -> DataFrame:
    per = _counts(df, {c: F.col(c).isNull() for c in df.columns}, "nulls")
    return per.withColumn("total_nulls", whole("nulls"))


def cleaning_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows, nulls and duplicates before and after, and the eligible share, as one row."""
    def snapshot(df: DataFrame, name: str) -> DataFrame:
        nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in df.columns])
        kinds = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
        return kinds.agg(
            F.sum("_n").alias(f"{name}_rows"), F.sum(nulls * F.col("_n")).alias(f"{name}_nulls"),
            (F.sum("_n") - F.count(F.lit(1))).alias(f"{name}_duplicates"),
            *([F.round(F.sum(F.col(S.TARGET_CLASS) * F.col("_n")) * 100.0 / F.sum("_n"), 2)
               .alias("eligible_pct")] if name == "clean" else []),
        )

    new = [c for c in cleaned.columns if c not in raw.columns]
    # two one-row frames side by side
    both = snapshot(raw, "raw").unionByName(snapshot(cleaned, "clean"), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("rows_removed", F.col("raw_rows") - F.col("clean_rows")).withColumn(
        "new_columns", F.lit(",".join(new)))


def map_effect(df: DataFrame) -> DataFrame:
    """Distinct texts per category column before and after the spelling maps."""
    counted = value_counts(df, list(S.VALUE_MAPS)).withColumn("before", C.trimmed_text("value"))
    after = F.lit(None).cast("string")
    for c, mapping in S.VALUE_MAPS.items():
        after = F.when(F.col("column") == c, X.mapped("before", mapping)).otherwise(after)
    return counted.withColumn("after", after).groupBy("column").agg(
        F.count_distinct("before").alias("before"), F.count_distinct("after").alias("after"))


def rule_violations(df: DataFrame) -> DataFrame:
    return _counts(df, {c: (F.col(c) < low) | (F.col(c) > high)
                        for c, (low, high) in S.DOMAIN_BOUNDS.items()}, "violations")


def cap_report(ruled: DataFrame, caps: dict[str, tuple[float, float]]) -> DataFrame:
    below = {c: F.col(c) < low for c, (low, _) in caps.items()}
    above = {c: F.col(c) > high for c, (_, high) in caps.items()}
    one = ruled.agg(*[F.count_if(t).alias(f"below|{c}") for c, t in below.items()],
                    *[F.count_if(t).alias(f"above|{c}") for c, t in above.items()])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(low).alias("p01"), F.lit(high).alias("p99"),
                 F.col(f"`below|{c}`").alias("below"), F.col(f"`above|{c}`").alias("above"))
        for c, (low, high) in caps.items()])))


# --- class and category summaries -------------------------------------------
def class_balance(df: DataFrame) -> DataFrame:
    one = df.agg(F.count_if(F.col(S.TARGET_CLASS) == 0).alias("not_eligible"),
                 F.count_if(F.col(S.TARGET_CLASS) == 1).alias("eligible"),
                 F.count(F.lit(1)).alias("total"))
    pct = X.share(F.col("eligible"), F.col("total"))
    return one.select(
        "*", X.share(F.col("not_eligible"), F.col("total"), 1).alias("not_eligible_pct"),
        F.round(pct, 1).alias("eligible_pct"),
        F.round(X.ratio("not_eligible", "eligible"), 4).alias("imbalance_ratio"),
        ((pct < 20) | (pct > 80)).alias("imbalanced"))


def class_ratio(df: DataFrame) -> DataFrame:
    one = df.agg(F.count_if(F.col(S.TARGET_CLASS) == 0).alias("n0"),
                 F.count_if(F.col(S.TARGET_CLASS) == 1).alias("n1"),
                 F.count(S.TARGET_CLASS).alias("n"))
    return one.select(
        "n0", "n1", F.round(X.ratio("n0", "n1"), 4).alias("class_ratio"),
        F.round(X.ratio(F.col("n"), F.col("n0") * 2), 6).alias("weight0"),
        F.round(X.ratio(F.col("n"), F.col("n1") * 2), 6).alias("weight1"))


def scenario_summary(df: DataFrame) -> DataFrame:
    sums = df.groupBy("emi_scenario").agg(
        F.count(S.TARGET_CLASS).alias("total"), F.sum(S.TARGET_CLASS).alias("eligible"),
        F.round(F.avg(S.TARGET_AMOUNT), 4).alias("avg_emi"))
    medians = group_medians(df, ["emi_scenario"], ["requested_amount"])
    return sums.join(medians, "emi_scenario", "left").select(
        "emi_scenario", "total", "eligible", "avg_emi",
        F.round("median_requested_amount", 4).alias("median_req"),
        X.share(F.col("eligible"), F.col("total"), 1).alias("approval_pct"),
        F.replace(F.replace(F.col("emi_scenario"), F.lit(" EMI"), F.lit("")),
                  F.lit(" Emi"), F.lit("")).alias("short_name"))


def approval_by_category(df: DataFrame, columns=tuple(S.APPROVAL_CATEGORIES)) -> DataFrame:
    """All category columns in one pass."""
    long = df.select(F.col(S.TARGET_CLASS).alias("_y"),
                     *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        ["_y"], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(
        F.round(F.avg("_y"), 6).alias("approval_rate"), F.count("_y").alias("rows"),
        F.round(F.avg("_y") * 100, 4).alias("approval_pct"))


def crosstab_pct(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).pivot(S.TARGET_CLASS, [0, 1]).agg(F.count(F.lit(1)))
    zero, one = F.coalesce(F.col("0"), F.lit(0)), F.coalesce(F.col("1"), F.lit(0))
    return counts.select(F.col(column).alias("value"),
                         X.share(zero, zero + one, 4).alias("not_eligible_pct"),
                         X.share(one, zero + one, 4).alias("eligible_pct"))


def approval_by_bracket(df: DataFrame) -> DataFrame:
    rows = df.withColumn("salary_bracket", X.salary_bracket("monthly_salary"))
    return rows.filter("salary_bracket is not null").groupBy("salary_bracket").agg(
        F.round(F.avg(S.TARGET_CLASS), 6).alias("approval_rate"),
        F.count(S.TARGET_CLASS).alias("rows"),
        F.round(F.avg(S.TARGET_CLASS) * 100, 4).alias("approval_pct"))


def class_means(df: DataFrame, columns) -> DataFrame:
    names = list(columns)
    long = df.select(F.col(S.TARGET_CLASS).alias("target"),
                     *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        ["target"], names, "column", "_x")
    means = long.groupBy("target", "column").agg(F.round(F.avg("_x"), 4).alias("mean"))
    medians = exact_quantiles(long, [0.5], ["target", "column"], "_x")
    return means.join(medians, ["target", "column"], "left").select(
        "target", "column", "mean", F.round("quantile", 4).alias("median"))


def describe_target(df: DataFrame) -> DataFrame:
    median = quantile_map(df, {"y": F.col(S.TARGET_AMOUNT)}).get(("y", 0.5))
    return df.agg(F.min(S.TARGET_AMOUNT).alias("min"), F.max(S.TARGET_AMOUNT).alias("max"),
                  F.round(F.avg(S.TARGET_AMOUNT), 4).alias("mean")).withColumn(
        "median", F.round(F.lit(median).cast("double"), 4))


def distribution_stats(df: DataFrame, columns=tuple(S.DISTRIBUTION_COLUMNS)) -> DataFrame:
    """Mean, median, bias-corrected skew and zero share."""
    long = long_values(df, {c: F.col(c) for c in columns}).filter("value is not null")
    medians = quantile_map(df, {c: F.col(c) for c in columns})
    median = F.lit(None).cast("double")
    for (c, _), x in medians.items():
        median = F.when(F.col("key") == c, F.lit(x)).otherwise(median)
    n = F.col("n")
    sums = long.groupBy("key").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.skewness("value").alias("_g"), F.count_if(F.col("value") == 0).alias("_zeros"))
    zero_pct = X.share(F.col("_zeros"), n)
    return sums.select(
        F.col("key").alias("column"), F.round("mean", 4).alias("mean"),
        F.round(median, 4).alias("median"),
        F.when(n > 2, F.round(F.sqrt(n * (n - 1)) / (n - 2) * F.col("_g"), 6)).alias("skew"),
        F.round(zero_pct, 4).alias("zero_pct"), (zero_pct > 20).alias("zero_heavy"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins; the top edge belongs to the last bin. Empty bins are kept."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    position = F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("int")
    counted = df.filter(F.col(column).isNotNull()).groupBy(
        F.least(F.greatest(position, F.lit(0)), F.lit(bins - 1)).alias("bin")
    ).agg(F.count(F.lit(1)).alias("rows"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin", F.round(F.lit(low) + F.col("bin") * width, 6).alias("from_value"),
        F.round(F.lit(low) + (F.col("bin") + 1) * width, 6).alias("to_value"),
        F.coalesce("rows", F.lit(0)).alias("rows"))


# cells of the kernel density: so many to a bandwidth, so many bandwidths of reach, moments up to so many
_CELLS, _REACH, _MOMENTS = 32, 8.75, 5


def density(sample: DataFrame, column: str, low: float, high: float, points: int = 500) -> DataFrame:
    """Gaussian kernel density per class on a fixed grid, Scott bandwidth.

    Values are counted in cells of 1/32 bandwidth with their moments about the cell's centre, in their tasks; each cell adds
    to the grid points within 8.75 bandwidths only. The kernel's series about the centre to the fifth moment and the tails left
    out are below 1e-12 of a kernel's peak. Rows before the last sum: cells times the grid points in reach.
    """
    rows = sample.select(F.col(S.TARGET_CLASS).alias("target"), F.col(column).cast("double").alias("x")
                         ).filter("x is not null")
    spread = rows.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"))
    # one row per class
    spread = F.broadcast(spread.filter("n >= 10 and sd > 0").withColumn(
        "h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))))
    width = F.col("h") / _CELLS
    # in bandwidths from the centre of the cell
    off = (F.col("x") / width - F.col("cell") - 0.5) / _CELLS
    moments = [F.sum(F.pow("d", F.lit(float(k)))).alias(f"m{k}") for k in range(_MOMENTS + 1)]
    cells = rows.join(spread, "target").withColumn("cell", F.floor(F.col("x") / width)).withColumn("d", off).groupBy(
        "target", "n", "h", "cell").agg(*moments)
    step = (high - low) / (points - 1)
    centre = (F.col("cell") + 0.5) * width
    first = F.greatest(F.ceil((centre - F.col("h") * _REACH - low) / step), F.lit(0))
    last = F.least(F.floor((centre + F.col("h") * _REACH - low) / step), F.lit(points - 1))
    near = cells.withColumn("first", first).withColumn("last", last).filter("first <= last").withColumn("centre", centre)
    u = (F.lit(low) + F.col("point") * F.lit(step) - F.col("centre")) / F.col("h")
    added = near.withColumn("point", F.explode(F.sequence("first", "last"))).withColumn("u", u)
    # Hermite polynomials: He(k + 1) = u He(k) - k He(k - 1)
    hermite = [F.lit(1.0), F.col("u")]
    for k in range(1, _MOMENTS):
        hermite.append(F.col("u") * hermite[k] - k * hermite[k - 1])
    series = sum((hermite[k] * F.col(f"m{k}") / factorial(k) for k in range(1, _MOMENTS + 1)), F.col("m0"))
    sums = added.groupBy("target", F.col("point").cast("int").alias("point")).agg(F.sum(F.exp(-F.pow("u", F.lit(2.0)) / 2) * series).alias("s"))
    grid = spread.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return grid.join(sums, ["target", "point"], "left").select(
        "target", "point", F.round(F.lit(low) + F.col("point") * step, 4).alias("at"),
        (F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0)) / (F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"))


def quantiles(df: DataFrame, columns, probabilities) -> DataFrame:
    """One row per column and probability that have a value."""
    found = quantile_map(df, {c: F.col(c) for c in columns}, probabilities)
    rows = [(c, p, x) for (c, p), x in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, probability double, quantile double").withColumn(
        "quantile", F.round("quantile", 4))


# --- correlation and tests --------------------------------------------------
def correlation_matrix(df: DataFrame, columns=tuple(S.CORRELATION_COLUMNS)) -> DataFrame:
    """Pearson r of every pair below the diagonal, each over its complete rows, from one scan.

    With m for "has a value" and x for the value (0 where there is none), all sums of all pairs stand in the product of
    [m, x, x * x] with itself. Each task adds it up block by block and sends one row per pair. Values are taken from a row
    of the table on, so that large ones with little spread keep their digits. A column that does not vary has no r.
    """
    columns = list(columns)
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    one = rows.head(1)
    shift = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in (one[0] if one else [0.0] * len(columns))])
    pairs = [(i, j) for i in range(len(columns)) for j in range(i)]
    a, b = (np.array([p[k] for p in pairs], int) for k in (0, 1))

    def blocks(batches):
        k = len(columns)
        total = np.zeros((3 * k, 3 * k))
        for batch in batches:
            held = np.array([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).T.astype(float)
            x = np.array([c.fill_null(0.0).to_numpy() for c in batch.columns]).T
            x = np.where(held > 0, x - shift, 0.0)
            whole = np.hstack([held, x, x * x])
            total += whole.T @ whole
        x, xx = k, 2 * k
        sums = {"n": total[a, b], "sx": total[x + a, b], "sy": total[x + b, a], "sxx": total[xx + a, b],
                "syy": total[xx + b, a], "sxy": total[x + a, x + b]}
        yield pa.record_batch([pa.array(np.arange(len(pairs)), pa.int32()), *map(pa.array, sums.values())], names=["pair", *sums])

    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    found = rows.mapInArrow(blocks, "pair int, " + ", ".join(f"{c} double" for c in names)).groupBy("pair").agg(
        *[F.sum(c).alias(c) for c in names])
    spreads = [F.col("n") * F.col(f"s{c}{c}") - F.col(f"s{c}") * F.col(f"s{c}") for c in "xy"]
    r = F.when((spreads[0] > 0) & (spreads[1] > 0), (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(spreads[0]) / F.sqrt(spreads[1]))
    name = lambda k: F.element_at(F.array(*[F.lit(columns[p[k]]) for p in pairs]), F.col("pair") + 1)
    return found.select(name(0).alias("row_name"), name(1).alias("column_name"), F.round(F.when(~F.isnan(r), r), 6).alias("r"))


def _correlations(df: DataFrame, columns, target: str) -> DataFrame:
    names = list(columns)
    long = df.select(F.col(target).cast("double").alias("_y"),
                     *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        ["_y"], names, "column", "_x")
    return long.groupBy("column").agg(F.corr("_x", "_y").alias("_r"))


def target_correlation(df: DataFrame, columns, target: str = S.TARGET_CLASS) -> DataFrame:
    return _correlations(df, [c for c in columns if c != target], target).select(
        "column", F.round("_r", 6).alias("r"), F.when(F.col("_r") >= 0, "+").otherwise("-").alias("sign"))


def top_correlation(correlations: DataFrame, k: int) -> DataFrame:
    return correlations.orderBy(F.abs("r").desc_nulls_last(), "column").limit(k)


def t_test(sample: DataFrame, columns=tuple(S.SIGNIFICANCE_COLUMNS)) -> DataFrame:
    """Pooled two-sample t per column between the classes, with two-sided p."""
    names = list(columns)
    long = sample.select(F.col(S.TARGET_CLASS).alias("_y"),
                         *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        ["_y"], names, "column", "_x").filter("_x is not null")
    stats = long.groupBy("column").agg(*[
        e for y in (0, 1) for e in (
            F.count(F.when(F.col("_y") == y, F.col("_x"))).alias(f"n{y}"),
            F.avg(F.when(F.col("_y") == y, F.col("_x"))).alias(f"m{y}"),
            F.var_samp(F.when(F.col("_y") == y, F.col("_x"))).alias(f"v{y}"))])
    df_ = F.col("n0") + F.col("n1") - 2
    pooled = ((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1")) / df_
    t = X.ratio(F.col("m1") - F.col("m0"),
                F.sqrt(pooled * (1 / F.col("n0") + 1 / F.col("n1"))))
    out = stats.select("column", F.round("m1", 4).alias("eligible_mean"),
                       F.round("m0", 4).alias("not_eligible_mean"), t.alias("_t"),
                       df_.alias("degrees"))
    p = pvalues.t_two_sided(F.col("_t"), F.col("degrees").cast("double"))
    return out.withColumn("_p", p).select(
        "column", "eligible_mean", "not_eligible_mean", F.round("_t", 6).alias("t"), "degrees",
        F.round("_p", 6).alias("p"), (F.col("_p") < 0.05).alias("significant"))
