"""Seeded class samples, stratified splits and label permutation.

A sample is a filter on a seeded hash: one cut per class is found from hash-prefix
counts, so no class is ever sorted or gathered as a whole.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.operators.ranks import (
    global_rank, quota_cuts, seeded_order, within_quota,
)

_ORDER = "_order"


def class_counts(df: DataFrame, by: str = S.TARGET_CLASS) -> dict:
    rows = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[by]: r["n"] for r in sorted(rows, key=lambda r: r[by])}


def proportional_quotas(counts: dict, total: int) -> dict:
    """Largest remainders, ties to the smaller class value."""
    whole = sum(counts.values())
    exact = {k: n * total / whole for k, n in counts.items()}
    quotas = {k: int(x) for k, x in exact.items()}
    left = total - sum(quotas.values())
    for k in sorted(counts, key=lambda k: (-(exact[k] - quotas[k]), k))[:left]:
        quotas[k] += 1
    return quotas


def take_quota(df: DataFrame, quotas: dict, by: str = S.TARGET_CLASS,
               key: str = "application_id", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(rows inside their class quota, the other rows of those classes)."""
    rows = df.withColumn(_ORDER, seeded_order(F.col(key), seed))
    cuts = quota_cuts(rows, by, _ORDER, quotas)
    inside = within_quota(by, _ORDER, cuts)
    known = F.col(by).isin(list(quotas)) if quotas else F.lit(False)
    return (rows.filter(known & inside).drop(_ORDER), rows.filter(known & ~inside).drop(_ORDER))


def class_sample(df: DataFrame, n: int, by: str = S.TARGET_CLASS, seed: int = 42,
                 key: str = "application_id") -> DataFrame:
    """Up to ``n`` rows of each class."""
    quotas = {k: min(n, size) for k, size in class_counts(df, by).items()}
    return take_quota(df, quotas, by, key, seed)[0]


def stratified_split(df: DataFrame, test_share: float = 0.2, by: str = S.TARGET_CLASS,
                     seed: int = 42, key: str = "application_id") -> tuple[DataFrame, DataFrame]:
    """(train, test) with exact per-class shares."""
    counts = class_counts(df, by)
    total = -int(-sum(counts.values()) * test_share // 1)
    test, train = take_quota(df, proportional_quotas(counts, total), by, key, seed)
    return train, test


def tune_sample(df: DataFrame, total: int = 50_000, by: str = S.TARGET_CLASS,
                seed: int = 42, key: str = "application_id") -> DataFrame:
    """Stratified sample of ``total`` rows, or all rows when there are no more."""
    counts = class_counts(df, by)
    if total >= sum(counts.values()):
        return df
    return take_quota(df, proportional_quotas(counts, total), by, key, seed)[0]


def permute_labels(df: DataFrame, label: str, seed: int, key: str = "application_id") -> DataFrame:
    """The same labels dealt out in another seeded order, by joining two global ranks."""
    here = global_rank(df.drop(label).withColumn(_ORDER, seeded_order(F.col(key), seed)),
                       _ORDER, "_rank").drop(_ORDER)
    dealt = global_rank(
        df.select(label, seeded_order(F.col(key), seed + 7919).alias(_ORDER)), _ORDER, "_rank"
    ).drop(_ORDER)
    return here.join(dealt, "_rank").drop("_rank")
