"""Cache replay with keyed state: the last miss of each key, evicted by event time.

One state per key, kept by Spark's state store and restored from the checkpoint: the time of the key's last miss. An event within a
lifetime of it is a hit; any other is a miss and becomes the state, with a timer for the end of its life. Timers
run as the watermark passes, so the store holds live entries only. Events behind the watermark that the micro-batch before began
with are dropped and counted by Spark; ``progress`` gives the counts per micro-batch as rows.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from lendframe import schema as S
from lendframe.staging import staging_path

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_MILLIS = 1000


class LastMiss(StatefulProcessor):
    """Hit or miss of each event of one key, in the order of time and id within a micro-batch."""

    def __init__(self, key: str, order: str, ttl: int):
        self.key, self.order, self.life = key, order, ttl * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.miss = handle.getValueState("last_miss", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [r for r in rows if len(r)]
        if not frames:
            return
        if key[0].startswith("none "):
            for frame in frames:
                yield pd.DataFrame({self.key: pd.array([None] * len(frame), "Int64"), self.order: frame[self.order].to_numpy(), "cache_hit": False})
            return
        events = pd.concat(frames).sort_values(["at_micros", self.order], kind="stable")
        held = self.miss.get()
        before = last = held[0] if held is not None else None
        hits = []
        for at in events["at_micros"].tolist():
            hit = last is not None and at < last + self.life
            hits.append(hit)
            if not hit:
                last = at
        if last != before:
            if before is not None:
                self.handle.deleteTimer(self._end(before))
            self.miss.update((last,))
            self.handle.registerTimer(self._end(last))
        yield pd.DataFrame({self.key: events[self.key].to_numpy(), self.order: events[self.order].to_numpy(), "cache_hit": hits})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.miss.get()
        if held is not None and self._end(held[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.miss.clear()
        return iter(())

    def _end(self, at: int) -> int:
        return -(-(at + self.life) // _MILLIS)

    def close(self) -> None:
        pass


class Progress(StreamingQueryListener):
    """What each micro-batch of one query read, dropped and held: a few numbers a micro-batch, kept by the driver."""

    def __init__(self):
        self.rows: dict[tuple, tuple] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        held = sum(op.numRowsTotal for op in p.stateOperators)
        self.rows[str(p.runId), p.batchId] = (p.batchId, p.numInputRows, late, held, p.eventTime.get("watermark"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def keyed_hits(events: DataFrame, key: str = "user_id", ts: str = "ts", order: str = "event_id", ttl: int = S.CACHE_TTL_SECONDS) -> DataFrame:
    """Stream of ``(key, order, cache_hit)``. An event without a key is a group of its own, misses, and leaves no state.

    All events take one way: a branch of its own for some of them would hold the watermark back while it gets none.
    """
    out = T.StructType([events.schema[key], events.schema[order], T.StructField("cache_hit", T.BooleanType())])
    group = F.coalesce(F.concat(F.lit("key "), F.col(key).cast("string")), F.concat(F.lit("none "), F.col(order).cast("string")))
    rows = events.select(group.alias("state_key"), key, order, ts, F.unix_micros(ts).alias("at_micros"))
    return rows.groupBy("state_key").transformWithStateInPandas(
        statefulProcessor=LastMiss(key, order, ttl), outputStructType=out, outputMode="Append", timeMode="EventTime")


def keyed_replay(stream: DataFrame, ttl: int = S.CACHE_TTL_SECONDS, checkpoint: str | None = None,
                 out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """What is there now, replayed: (``user_id``, ``event_id``, ``cache_hit``), and ``progress`` of the micro-batches.

    A later call with the same checkpoint and folder goes on where this one ended. Each micro-batch owns its folder, so one that is
    repeated overwrites itself. Events behind the watermark have no row.
    """
    spark = stream.sparkSession
    out, checkpoint = out or staging_path(spark, "keyed-out"), checkpoint or staging_path(spark, "keyed-checkpoint")
    hits = keyed_hits(stream, ttl=ttl)

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    heard = Progress()
    spark.streams.addListener(heard)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        query = (hits.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).foreachBatch(write).start())
        query.awaitTermination()
        _wait(heard, query)
    finally:
        spark.conf.set(_PROVIDER, before)
        spark.streams.removeListener(heard)
    return spark.read.schema(hits.schema).parquet(f"{out}/batch=*"), progress(spark, heard, query)


def _wait(heard: Progress, query: StreamingQuery, seconds: float = 10.0) -> None:
    """Progress events come after the query has ended."""
    import time

    end = time.monotonic() + seconds
    while str(query.runId) not in heard.ended and time.monotonic() < end:
        time.sleep(0.05)


def progress(spark: SparkSession, heard: Progress, query: StreamingQuery) -> DataFrame:
    """One row per micro-batch: ``batch``, ``rows`` read, ``late`` ones dropped, ``held`` states, ``watermark`` it began with."""
    rows = [row for (run, _), row in sorted(heard.rows.items(), key=lambda x: x[1][0]) if run == str(query.runId)]
    return spark.createDataFrame(rows, "batch long, rows long, late long, held long, watermark string")
