"""Serving metrics over request events; the same functions take streams and tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.functions import expr as X


def requests(events: DataFrame) -> DataFrame:
    """Events read as requests: endpoint, status, duration and decision zone."""
    return events.select(
        "event_id", "ts", "user_id", F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
        (F.col("value") / 100).alias("seconds"),
        X.zone(F.col("value") / 100).alias("conf_zone"), "value")


def window_start(c: str = "w") -> Column:
    return F.date_format(F.col(f"{c}.start"), "yyyy-MM-dd HH:mm:ss")


def _windowed(df: DataFrame, width: str, *by: str):
    return df.groupBy(F.window("ts", width).alias("w"), *by)


def request_rate(df: DataFrame) -> DataFrame:
    return _windowed(df, "1 minute", "endpoint").agg(F.count(F.lit(1)).alias("requests")).select(
        window_start().alias("window_start"), "endpoint", "requests",
        F.round(F.col("requests") / 60, 6).alias("per_second"))


def error_rate(df: DataFrame) -> DataFrame:
    return _windowed(df, "5 minutes").agg(
        F.count_if(F.col("status").rlike("^[45]..$")).alias("errors")).select(
        window_start().alias("window_start"), "errors",
        F.round(F.col("errors") / 300, 6).alias("per_second"))


def zone_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("conf_zone").agg(F.count(F.lit(1)).alias("predictions"))


def latency_buckets(df: DataFrame) -> DataFrame:
    """Cumulative counts per latency bound, one column per bound, plus the total."""
    return _windowed(df, "5 minutes", "endpoint").agg(
        *[F.count_if(F.col("seconds") <= b).alias(f"le_{i}") for i, b in enumerate(S.LATENCY_BOUNDS)],
        F.count(F.lit(1)).alias("le_inf"))


def bucket_quantile(q: float) -> Column:
    """Linear within the bucket of the rank; the last bound above all bounds."""
    rank = F.lit(q) * F.col("le_inf")
    out = F.lit(S.LATENCY_BOUNDS[-1])
    for i in reversed(range(len(S.LATENCY_BOUNDS))):
        upto = F.col(f"le_{i}")
        below = F.col(f"le_{i - 1}") if i else F.lit(0)
        low, high = (S.LATENCY_BOUNDS[i - 1] if i else 0.0), S.LATENCY_BOUNDS[i]
        inside = F.lit(low) + F.lit(high - low) * X.ratio(rank - below, upto - below)
        out = F.when(upto >= rank, inside).otherwise(out)
    return out


def latency_quantiles(df: DataFrame) -> DataFrame:
    return latency_buckets(df).select(
        window_start().alias("window_start"), "endpoint", F.col("le_inf").alias("requests"),
        *[F.round(bucket_quantile(q), 6).alias(name)
          for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))])


def cache_hit_rate(replayed: DataFrame) -> DataFrame:
    rate = X.ratio(F.col("hits"), F.col("hits") + F.col("misses"))
    color = F.lit(None).cast("string")
    for low, name in reversed(S.HIT_RATE_STEPS):
        color = F.when(F.col("hit_rate") >= low, F.lit(name)).otherwise(color)
    return _windowed(replayed, "5 minutes").agg(
        F.count_if("cache_hit").alias("hits"), F.count_if(~F.col("cache_hit")).alias("misses")
    ).select(window_start().alias("window_start"), "hits", "misses",
             F.round(rate, 6).alias("hit_rate")).withColumn("color", color)


def last_status(df: DataFrame) -> DataFrame:
    """Latest up (1) or down (0) per endpoint, ties by event id."""
    up = F.when(F.col("status") == "200", 1).otherwise(0)
    at = F.struct("ts", "event_id")
    return df.groupBy("endpoint").agg(F.max_by(up, at).alias("up"),
                                      F.max_by("event_id", at).alias("event_id")).withColumn(
        "text", F.when(F.col("up") == 1, "UP").otherwise("DOWN"))


def latency_delta(df: DataFrame, session: str = "user_id", bucket: str = "1 hour") -> DataFrame:
    """Change against the previous request of the session; null sessions are one session.

    Windows run per session and hour; the value before an hour comes from the small
    table of last values per hour, so a busy session is spread over its hours.
    """
    rows = df.withColumn("_b", F.window("ts", bucket)["start"])
    at = F.struct("ts", "event_id")
    by_session = Window.partitionBy(session).orderBy("_b")
    before = rows.groupBy(session, "_b").agg(F.max_by("seconds", at).alias("_last")).select(
        F.col(session).alias("_s"), F.col("_b").alias("_c"), F.lag("_last").over(by_session).alias("_before"))
    inside = Window.partitionBy(session, "_b").orderBy("ts", "event_id")
    previous = F.coalesce(F.lag("seconds").over(inside), F.col("_before"))
    same = F.col(session).eqNullSafe(F.col("_s")) & F.col("_b").eqNullSafe(F.col("_c"))
    return rows.join(before, same).withColumn(
        "delta", F.round(F.col("seconds") - previous, 6)).drop("_b", "_before", "_s", "_c")
