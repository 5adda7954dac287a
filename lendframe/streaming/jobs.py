"""Structured Streaming forms of the serving metrics, scoring and cache replay."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from lendframe import schema as S
from lendframe.operators.cache import mark_hits, replay_misses
from lendframe.operators.cleaning import clean_currency, coerce_numbers, normalize_columns
from lendframe.operators.scoring import validate_requests
from lendframe.staging import small_methods, staged, staging_path

LATENESS_SECONDS = 600
LATENESS = f"{LATENESS_SECONDS} seconds"


def event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """New event files of a folder, with event time and watermark."""
    reader = spark.readStream.schema(S.EVENT_SCHEMA).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).withColumn(
        "ts", F.col("ts").cast("timestamp")).withWatermark("ts", LATENESS)


def run_available(stream: DataFrame, name: str, mode: str = "update",
                  checkpoint: str | None = None, out: str | None = None) -> tuple[str, StreamingQuery]:
    """Process what is there now. Each micro-batch owns one folder, so a replay after a
    failure overwrites its own output instead of adding to it."""
    spark = stream.sparkSession
    out = out or staging_path(spark, f"{name}-out")
    checkpoint = checkpoint or staging_path(spark, f"{name}-checkpoint")

    def write(df: DataFrame, batch: int) -> None:
        with small_methods(df.sparkSession):
            df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()
    return out, query


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark and were dropped."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress
               for op in progress["stateOperators"])


def latest(spark: SparkSession, out: str, keys: list[str], schema) -> DataFrame:
    """Last update of each key over all micro-batches."""
    # every micro-batch rewrites the keys it touched; only those rows are kept in its folder
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
    rows = spark.read.option("basePath", out).schema(with_batch).parquet(out)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


def stream_metric(stream: DataFrame, metric: Callable[[DataFrame], DataFrame], keys: list[str],
                  name: str) -> DataFrame:
    """A windowed metric run as a stream; gives the same rows as on the table."""
    updates = metric(stream)
    out, _ = run_available(updates, name)
    return latest(stream.sparkSession, out, keys, updates.schema)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores: a micro-batch takes few files, and a file of one row group is read by one task."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def stream_score(stream: DataFrame, score: Callable[[DataFrame], DataFrame], name: str = "score") -> DataFrame:
    """Score rows as they arrive, by a narrow function of the row."""
    scored = score(spread(stream))
    out, _ = run_available(scored, name, mode="append")
    return stream.sparkSession.read.schema(scored.schema).parquet(f"{out}/batch=*")


def stream_requests(stream: DataFrame, features: Callable[[DataFrame], DataFrame],
                    score: Callable[[DataFrame], DataFrame], name: str = "requests") -> tuple[DataFrame, DataFrame]:
    """Raw requests: the valid ones cleaned, featured and scored; the others with their problems.

    Rows are judged by the values that cleaning would read. A repeated micro-batch
    replaces its own folders, and no state is kept between micro-batches.
    """
    spark = stream.sparkSession
    out, checkpoint = staging_path(spark, f"{name}-out"), staging_path(spark, f"{name}-checkpoint")

    def write(df: DataFrame, batch: int) -> None:
        judged = judged_requests(spread(df)).persist()
        valid, refused = sides(judged)
        with small_methods(df.sparkSession):
            score(features(valid)).write.mode("overwrite").parquet(f"{out}/scored/batch={batch}")
        refused.write.mode("overwrite").parquet(f"{out}/refused/batch={batch}")
        judged.unpersist()

    query = (stream.writeStream.option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()
    return spark.read.parquet(f"{out}/scored/batch=*"), spark.read.parquet(f"{out}/refused/batch=*")


def judged_requests(df: DataFrame) -> DataFrame:
    """Raw rows as one column, with ``problems`` and ``valid``."""
    raw = normalize_columns(df)
    read = coerce_numbers(clean_currency(raw.withColumn("_raw", F.struct(*raw.columns))))
    return validate_requests(read).select("_raw", "problems", "valid")


def sides(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(raw rows of valid requests, the others with ``problems``)."""
    return judged.filter("valid").select("_raw.*"), judged.filter(~F.col("valid")).select("_raw.*", "problems")


def judge_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return sides(judged_requests(df))


def stream_replay(stream: DataFrame, ttl: int = S.CACHE_TTL_SECONDS,
                  checkpoint: str | None = None, out: str | None = None,
                  lateness_seconds: int = LATENESS_SECONDS) -> DataFrame:
    """Hit or miss per event, micro-batch by micro-batch.

    State is a table of the last miss per key and the newest event time, one version per
    micro-batch. A replayed micro-batch starts from the version before it, so its result
    does not change. Events older than the newest one of earlier batches by more than the
    lateness are not replayed; they are written to ``late``. Entries that ended before
    that watermark are forgotten, as no event that still counts can hit them.
    """
    spark = stream.sparkSession
    out = out or staging_path(spark, "replay-out")
    checkpoint = checkpoint or staging_path(spark, "replay-checkpoint")
    state_schema = "user_id long, _at long"
    micros = F.unix_micros("ts")

    def write(df: DataFrame, batch: int) -> None:
        prior = newest = None
        if batch > 0:
            prior = spark.read.schema(state_schema).parquet(f"{out}/state/batch={batch - 1}")
            newest = spark.read.schema("newest long").parquet(f"{out}/newest/batch={batch - 1}").first()[0]
        rows = df.select("event_id", "user_id", "ts").persist()
        late = F.lit(False)
        if newest is not None:
            late = F.coalesce(micros < newest - lateness_seconds * 1_000_000, F.lit(False))
        rows.filter(late).write.mode("overwrite").parquet(f"{out}/late/batch={batch}")
        intime = rows.filter(~late)
        misses = staged(replay_misses(intime, ttl=ttl, prior=prior), "misses")
        mark_hits(intime, misses).write.mode("overwrite").parquet(f"{out}/hits/batch={batch}")
        newest = max((x for x in (newest, rows.agg(F.max(micros)).first()[0]) if x is not None), default=None)
        spark.createDataFrame([(newest,)], "newest long").write.mode("overwrite").parquet(f"{out}/newest/batch={batch}")
        seen = misses.filter("user_id IS NOT NULL").select("user_id", "_at")
        if prior is not None:
            seen = seen.unionByName(prior)
        alive = F.lit(True) if newest is None else F.col("_at") >= newest - (lateness_seconds + ttl) * 1_000_000
        seen.groupBy("user_id").agg(F.max("_at").alias("_at")).filter(alive).write.mode("overwrite").parquet(f"{out}/state/batch={batch}")
        rows.unpersist()

    query = (stream.writeStream.option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()
    return spark.read.parquet(f"{out}/hits/batch=*")
