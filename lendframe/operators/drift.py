"""Distribution drift per column, per layer and per batch."""

import warnings
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe import schema as S
from lendframe.functions import expr as X
from lendframe.functions import pvalues
from lendframe.operators.profiling import approval_by_category
from lendframe.operators.ranks import running_counts
from lendframe.staging import staged

# the published preset: what it takes for a category, and for distances instead of p-values
FEW_VALUES = 5
LARGE_REFERENCE = 1000
TESTS = ("jensenshannon", "wasserstein", "ks", "chisquare", "z")
# what reading and running a layer may fail with
FAILURES = (PySparkException, Py4JError, OSError)


@dataclass
class Profile:
    """What later batches are compared with: how often each column holds each value. Null values are left out.

    ``numbers`` has ``column, value double, n long``, ``texts`` the same with text values. Both can be
    written, read, and merged with the counts of more rows.
    """

    numbers: DataFrame
    texts: DataFrame
    kinds: dict[str, str]

    @classmethod
    def of(cls, df: DataFrame, columns: list[str]) -> "Profile":
        numeric, text = column_kinds(df, columns)
        return cls(_value_counts(df, numeric, "double"), _value_counts(df, text, "string"),
                   {c: "double" for c in numeric} | {c: "string" for c in text})

    def merged(self, more: "Profile") -> "Profile":
        if self.kinds != more.kinds:
            raise ValueError("profiles of different columns")

        def add(a: DataFrame, b: DataFrame) -> DataFrame:
            return a.unionByName(b).groupBy("column", "value").agg(F.sum("n").alias("n"))

        return Profile(add(self.numbers, more.numbers), add(self.texts, more.texts), self.kinds)

    def write(self, path: str) -> None:
        """Columns without any value are known by a row of zero."""
        spark = self.numbers.sparkSession
        for name, kind, counts in (("numbers", "double", self.numbers), ("texts", "string", self.texts)):
            known = spark.createDataFrame([(c,) for c, k in self.kinds.items() if k == kind], "column string")
            rows = counts.unionByName(known.select("column", F.lit(None).cast(kind).alias("value"), F.lit(0).cast("long").alias("n")))
            rows.write.mode("errorifexists").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark, path: str) -> "Profile":
        parts, kinds = [], {}
        for name, kind in (("numbers", "double"), ("texts", "string")):
            rows = spark.read.schema(f"column string, value {kind}, n long").parquet(f"{path}/{name}")
            # one row per column of the table
            kinds |= {r["column"]: kind for r in rows.filter("value IS NULL").select("column").distinct().collect()}
            parts.append(rows.filter("value IS NOT NULL"))
        return cls(*parts, kinds)

    def counts(self, columns: list[str], kind: str) -> DataFrame:
        held = self.numbers if kind == "double" else self.texts
        return held.filter(F.col("column").isin(columns)).select("column", "value", "n")

    @property
    def columns(self) -> list[str]:
        return list(self.kinds)


def _value_counts(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    if not columns:
        return df.sparkSession.createDataFrame([], f"column string, value {kind}, n long")
    return df.select(*[F.col(c).cast(kind).alias(c) for c in columns]).unpivot(
        [], columns, "column", "value").filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _counts(side: "DataFrame | Profile", columns: list[str], kind: str) -> DataFrame:
    return side.counts(columns, kind) if isinstance(side, Profile) else _value_counts(side, columns, kind)


def _sides(reference: "DataFrame | Profile", current: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """Counts per (column, value) on both sides: ``r`` for reference, ``c`` for current."""
    none = F.lit(0).cast("long")
    r = _counts(reference, columns, kind).select("column", "value", F.col("n").alias("r"), none.alias("c"))
    c = _counts(current, columns, kind).select("column", "value", none.alias("r"), F.col("n").alias("c"))
    return r.unionByName(c).groupBy("column", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


def _deviations(run: DataFrame) -> DataFrame:
    """Population deviation of the reference's values per column, from the counts: about the mean, so that digits stay."""
    mean = run.groupBy("column").agg(F.try_divide(F.sum(F.col("value") * F.col("r")), F.sum("r")).alias("_mean"))
    # one row per column
    away = F.col("value") - F.col("_mean")
    return run.join(F.broadcast(mean), "column").groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(F.col("r") * away * away), F.sum("r"))).alias("sd"))


def _js_terms(p: Column, q: Column) -> Column:
    """Twice the Jensen-Shannon divergence, per value."""
    mid = (p + q) / 2

    def part(x):
        return F.when(x > 0, x * F.ln(x / mid)).otherwise(F.lit(0.0))

    return part(p) + part(q)


def numeric_distances(reference: "DataFrame | Profile", current: DataFrame, columns: list[str]) -> DataFrame:
    """KS and Wasserstein distances from one running count over both sides."""
    sides = staged(_sides(reference, current, columns, "double"), "sides")
    run = running_counts(sides, ["column"], "value", ["r", "c"])
    gap = F.abs(F.try_divide("r_upto", "r_total") - F.try_divide("c_upto", "c_total"))
    p, q = F.try_divide("r", "r_total"), F.try_divide("c", "c_total")
    x = F.col("value")
    stats = run.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_values"), F.max("r_total").alias("n_reference"),
        F.max("c_total").alias("n_current"), F.max(gap).alias("ks"),
        F.when(_both_sides(), F.coalesce(F.sum(gap * (F.col("next_value") - x)), F.lit(0.0))).alias("_w"),
        F.sum(_js_terms(p, q)).alias("_js"), *_chi_parts())
    # one row per column
    spread = F.broadcast(_deviations(sides))
    return stats.join(spread, "column").withColumn(
        "wasserstein", F.col("_w") / F.greatest("sd", F.lit(0.001))).withColumn(
        "jensen_shannon", F.sqrt(F.greatest(F.col("_js") / 2, F.lit(0.0)))).drop("_w", "_js")


def _both_sides() -> Column:
    return (F.max("r_total") > 0) & (F.max("c_total") > 0)


def categorical_distances(reference: "DataFrame | Profile", current: DataFrame, columns: list[str]) -> DataFrame:
    counts = _sides(reference, current, columns, "string")
    totals = counts.groupBy("column").agg(F.sum("r").alias("r_total"), F.sum("c").alias("c_total"))
    # one row of totals per column
    rows = counts.join(F.broadcast(totals), "column")
    p, q = F.try_divide("r", "r_total"), F.try_divide("c", "c_total")
    return rows.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_values"), F.max("r_total").alias("n_reference"),
        F.max("c_total").alias("n_current"), F.sum(_js_terms(p, q)).alias("_js"), *_chi_parts(),
    ).withColumn("jensen_shannon", F.sqrt(F.greatest(F.col("_js") / 2, F.lit(0.0)))).drop("_js")


def _chi_parts() -> list[Column]:
    """Chi-square of current counts against scaled reference counts, and the sums that
    give the Z of two shares: plain sums, so the aggregate stays hashed."""
    expected = F.try_divide(F.col("r") * F.col("c_total"), "r_total")
    gap = F.try_divide("r", "r_total") - F.try_divide("c", "c_total")
    pooled = (F.col("r") + F.col("c")) / (F.col("r_total") + F.col("c_total"))
    return [
        F.sum(F.when(F.col("r") > 0, F.try_divide(F.pow(F.col("c") - expected, 2), expected))
              .when(F.col("c") > 0, F.lit(float("inf")))).alias("_chi"),
        F.sum(gap * gap).alias("_gap2"), F.sum(pooled * pooled).alias("_pooled2"),
    ]


def _two_share_z() -> Column:
    """|Z| of the difference of two shares by the pooled share. Over two values the
    squared gaps sum to 2 (p1 - p2)^2 and 1 less the squared pooled shares is
    2 p (1 - p)."""
    spread = (1 - F.col("_pooled2")) * (F.try_divide(F.lit(1), "n_reference") + F.try_divide(F.lit(1), "n_current"))
    return F.coalesce(F.sqrt(X.ratio(F.col("_gap2"), spread)), F.lit(0.0))


def column_kinds(df: "DataFrame | Profile", columns: list[str]) -> tuple[list[str], list[str]]:
    if isinstance(df, Profile):
        return [c for c in columns if df.kinds[c] == "double"], [c for c in columns if df.kinds[c] == "string"]
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    return [c for c in columns if c not in text], text


def drift_statistics(reference: DataFrame, current: DataFrame, columns: list[str],
                     few_values: int = FEW_VALUES) -> DataFrame:
    """What the p-values follow from: ``ks`` of numbers, ``chi_square`` of categories and of
    numbers of few values, and ``z`` where there are two values."""
    numeric, text = column_kinds(reference, columns)
    parts = []
    if numeric:
        parts.append(numeric_distances(reference, current, numeric).withColumn("_num", F.lit(True)))
    if text:
        parts.append(categorical_distances(reference, current, text).withColumn("_num", F.lit(False)))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    ks = F.col("ks") if numeric else F.lit(None).cast("double")
    few = ~F.col("_num") | (F.col("n_values") <= few_values)
    return rows.select(
        "column", "n_values", F.round(F.when(F.col("_num"), ks), 8).alias("ks"),
        F.round(F.when(few, F.col("_chi")), 6).alias("chi_square"),
        F.round(F.when(F.col("n_values") == 2, _two_share_z()), 6).alias("z"))


def drift_columns(reference: "DataFrame | Profile", current: DataFrame, columns: list[str],
                  distance_threshold: float = 0.1, p_threshold: float = 0.05,
                  large_reference: int = LARGE_REFERENCE, few_values: int = FEW_VALUES,
                  tests: dict[str, str] | None = None) -> DataFrame:
    """One row per column: test used, score and whether the column drifted. A stored ``Profile`` may stand for the
    reference: then only the current rows are scanned.

    ``tests`` names the test of each column. Columns it leaves out take the preset's.
    Large reference: distances, drift at or above the threshold. Small reference:
    p-values, drift below the threshold. Numeric columns of few values are treated as
    categories.

    A column that has values on one side only drifted, and has no score; one without
    any values did not drift.
    """
    tests = tests or {}
    if unknown := set(tests.values()) - set(TESTS):
        raise ValueError(f"unknown tests: {sorted(unknown)}")
    numeric, text = column_kinds(reference, columns)
    parts = []
    if numeric:
        parts.append(numeric_distances(reference, current, numeric).withColumn("_num", F.lit(True)))
    if text:
        parts.append(categorical_distances(reference, current, text).withColumn("_num", F.lit(False)))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    for c in ("ks", "wasserstein"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("double"))
    few = ~F.col("_num") | (F.col("n_values") <= few_values)
    test = (F.when(F.col("n_reference") > large_reference,
                   F.when(few, "jensenshannon").otherwise("wasserstein"))
            .otherwise(F.when(~few, "ks").when(F.col("n_values") > 2, "chisquare").otherwise("z")))
    for column, name in tests.items():
        test = F.when(F.col("column") == column, F.lit(name)).otherwise(test)
    n1, n2 = F.col("n_reference"), F.col("n_current")
    root = F.sqrt(F.try_divide((n1 * n2).cast("double"), (n1 + n2).cast("double")))
    rows = rows.withColumn("test", test).withColumn("score", (
        F.when(F.col("test") == "jensenshannon", F.col("jensen_shannon"))
        .when(F.col("test") == "wasserstein", F.col("wasserstein"))))
    p_values = {"_p_ks": F.lit(None).cast("double"), "_p_chi": F.lit(None).cast("double"), "_p_z": F.lit(None).cast("double")}
    if not set(columns) <= {c for c, name in tests.items() if name in TESTS[:2]}:
        # p-values run in Python, on one row per column, and only where they are asked for
        p_values = {
            "_p_ks": pvalues.kolmogorov_upper(F.when(F.col("test") == "ks", F.col("ks") * root)),
            "_p_chi": pvalues.chi2_upper(F.when(F.col("test") == "chisquare", F.col("_chi")),
                                         F.col("n_values").cast("double") - 1),
            "_p_z": pvalues.normal_two_sided(F.when(F.col("test") == "z", _two_share_z())),
        }
    rows = rows.withColumns(p_values)
    distance = F.col("test").isin("jensenshannon", "wasserstein")
    both = (n1 > 0) & (n2 > 0)
    score = F.when(both, F.coalesce("score", "_p_ks", "_p_chi", "_p_z"))
    # columns without any value have no counts, but a row
    names = current.sparkSession.createDataFrame([(c, c in numeric) for c in columns], "_column string, _number boolean")
    rows = names.join(rows, F.col("_column") == F.col("column"), "left")
    over = F.when(distance, score >= distance_threshold).otherwise(score < p_threshold)
    return rows.withColumn("column", F.col("_column")).withColumn("_num", F.col("_number")).withColumn(
        "n_values", F.coalesce("n_values", F.lit(0).cast("long"))).select(
        "column", F.when(F.col("_num"), "num").otherwise("cat").alias("kind"), "test", "n_values",
        F.round(score, 6).alias("score"),
        F.when(distance, F.lit(distance_threshold)).otherwise(F.lit(p_threshold)).alias("threshold"),
        F.when(F.coalesce(both, F.lit(True)), F.coalesce(over, F.lit(False))).otherwise(True).alias("drifted"))


def drift_summary(columns: DataFrame, share: float = 0.5) -> DataFrame:
    """Share of drifted columns, their names in order, and the flag."""
    return columns.agg(
        F.round(F.avg(F.col("drifted").cast("double")), 4).alias("share_drifted"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("column")))).alias("drifted_columns"),
        (F.avg(F.col("drifted").cast("double")) >= share).alias("drift_detected"))


LAYERS = ((1, S.REQUEST_COLUMNS, 5), (2, S.DRIFT_ENGINEERED, 2))
_LAYER_SCHEMA = "share_drifted double, drifted_columns array<string>, drift_detected boolean, layer int"


def drift_layer(reference: DataFrame, current: DataFrame, layer: int, share: float = 0.5, **thresholds) -> DataFrame | None:
    """Summary row of one layer, or None if too few of its columns are on both sides."""
    columns, least = next((c, n) for number, c, n in LAYERS if number == layer)
    shared = [c for c in columns if c in reference.columns and c in current.columns]
    if len(shared) < least:
        return None
    return drift_summary(drift_columns(reference, current, shared, **thresholds), share).withColumn("layer", F.lit(layer))


def drift_layers(reference: DataFrame, current: DataFrame, share: float = 0.5, **thresholds) -> DataFrame:
    """Raw layer and engineered layer; a layer with too few shared columns has no row."""
    layers = current.sparkSession.createDataFrame([], _LAYER_SCHEMA)
    for number, _, _ in LAYERS:
        one = drift_layer(reference, current, number, share, **thresholds)
        layers = layers if one is None else layers.unionByName(one)
    return layers


def drift_report(layers: DataFrame) -> DataFrame:
    """One row per batch: drift in either layer is drift."""
    def of(layer, c, missing):
        return F.coalesce(F.max(F.when(F.col("layer") == layer, F.col(c))), missing)

    none = F.array().cast("array<string>")
    return layers.agg(
        F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("drift_detected"),
        of(1, "drift_detected", F.lit(False)).alias("layer1_drift"),
        of(1, "drifted_columns", none).alias("layer1_columns"),
        of(2, "drift_detected", F.lit(False)).alias("layer2_drift"),
        of(2, "drifted_columns", none).alias("layer2_columns"),
    ).withColumn("skipped", F.lit(False)).withColumn("skip_reason", F.lit(""))


def guarded_drift(spark, read_reference, read_current, share: float = 0.5, **thresholds) -> DataFrame:
    """Never fails for want of data: a table that cannot be read gives a ``skipped`` row
    with the reason, and a layer that fails counts as one without drift."""
    report = drift_report(spark.createDataFrame([], _LAYER_SCHEMA))
    try:
        reference, current = read_reference(), read_current()
        # files may be missing although the names are known
        reference.limit(1).collect(), current.limit(1).collect()
    except FAILURES as problem:
        return report.withColumn("skipped", F.lit(True)).withColumn("skip_reason", F.lit(str(problem)))
    rows = []
    for number, _, _ in LAYERS:
        try:
            one = drift_layer(reference, current, number, share, **thresholds)
            rows += [] if one is None else one.collect()
        except FAILURES as problem:
            warnings.warn(f"drift layer {number} failed: {problem}", stacklevel=2)
    return drift_report(spark.createDataFrame(rows, _LAYER_SCHEMA))


def subgroup_rates(df: DataFrame, columns=("gender", "marital_status")) -> DataFrame:
    """Approval rate per group and its ratio to the best group of the column."""
    rates = approval_by_category(df, columns).select("column", "value", "approval_rate", "rows")
    best = F.max("approval_rate").over(Window.partitionBy("column"))
    return rates.withColumn("ratio_to_best", F.round(X.ratio(F.col("approval_rate"), best), 4))
