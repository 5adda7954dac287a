"""Feature cache as a keyed table: keys, payloads, upserts, lookups, expiry, replay."""

from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lendframe import schema as S
from lendframe.functions import expr as X
from lendframe.staging import discard, staged

_MICROS = 1_000_000
#: Lifetimes of a block of one key's time, which one task scans in order.
BLOCK = 8


def customer_digest(customer: Column | str) -> Column:
    """What entries are keyed by: the whole hash of the id. The plain id is never stored.

    Null and blank ids have none.
    """
    text = X.col(customer).cast("string")
    return F.when(X.strip(text) != "", F.sha2(text, 256))


def cache_key(customer: Column | str) -> Column:
    """The published short name of an entry: prefix and a part of the hash. Nothing is joined by it."""
    return _short(F.sha2(X.col(customer).cast("string"), 256))


def _short(digest: Column) -> Column:
    return F.concat(F.lit(f"{S.CACHE_PREFIX}:"), F.substring(digest, 1, S.CACHE_HASH_CHARS))


def payload_text(df: DataFrame, columns, exact: bool = False) -> Column:
    """JSON of the columns present, nulls written, values as text.

    Reals go as plain decimals of six places, or with all their digits if ``exact``.
    """
    def text(c):
        kind = df.schema[c].dataType.typeName()
        plain = kind in ("double", "float") and not exact
        x = F.col(c).cast("decimal(28,6)") if plain else F.col(c)
        return x.cast("string").alias(c)

    return F.to_json(F.struct(*[text(c) for c in columns if c in df.columns]),
                     {"ignoreNullFields": "false"})


def content_key(df: DataFrame, columns) -> Column:
    """Published short name of a request by its content, over the columns in sorted order."""
    return F.concat(F.lit("UI-"), F.substring(content_digest(df, columns), 1, 12))


def content_digest(df: DataFrame, columns) -> Column:
    """What requests without an id are told apart by."""
    return F.sha2(payload_text(df, sorted(columns)), 256)


def batch_write(df: DataFrame, columns, customer: str = "customer_id",
                sequence: str = "application_id", ttl: int = S.CACHE_TTL_SECONDS,
                written_at: Column | None = None, exact: bool = False) -> DataFrame:
    """One entry per customer with a usable id; the later row wins.

    The last sequence per customer is a hashed aggregate over narrow rows; payloads
    are written only for the rows that win. Ties take the largest payload.
    """
    usable = df.filter(_usable(customer)).withColumn(
        "digest", customer_digest(X.strip(F.col(customer).cast("string"))))
    last = usable.groupBy(F.col("digest").alias("_digest")).agg(F.max(sequence).alias("_seq"))
    won = usable.join(last, (F.col("digest") == F.col("_digest")) & F.col(sequence).eqNullSafe(F.col("_seq")))
    rows = won.select("digest", F.col(sequence).alias("seq"), payload_text(df, columns, exact).alias("payload"))
    order = Window.partitionBy("digest").orderBy(F.col("payload").desc())
    entries = rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select(
        "digest", _short(F.col("digest")).alias("cache_key"), "payload", "seq")
    return with_expiry(entries, written_at, ttl)


def with_expiry(entries: DataFrame, written_at: Column | None, ttl: int = S.CACHE_TTL_SECONDS) -> DataFrame:
    written_at = F.current_timestamp() if written_at is None else written_at
    return entries.withColumn("written_at", written_at).withColumn(
        "expires_at", F.col("written_at") + F.make_dt_interval(secs=F.lit(ttl)))


def _usable(customer: str) -> Column:
    text = X.strip(F.col(customer).cast("string"))
    return F.coalesce(text != "", F.lit(False))


def write_counts(df: DataFrame, customer: str = "customer_id") -> DataFrame:
    return df.agg(F.count_if(_usable(customer)).alias("written"),
                  F.count_if(~_usable(customer)).alias("errors"))


def upsert(store: DataFrame, entries: DataFrame) -> DataFrame:
    """New entries replace stored ones of the same customer."""
    kept = store.join(entries.select("digest"), "digest", "left_anti")
    return kept.select(*store.columns).unionByName(entries.select(*store.columns))


def lookup(requests: DataFrame, store: DataFrame, now: Column, customer: str = "customer_id") -> DataFrame:
    """Requests with their stored payload, or null where none is alive.

    Requests without an id go past the join, so they do not meet in one task.
    """
    live = store.filter(F.col("expires_at") > now).select(F.col("digest").alias("_digest"), F.col("payload").alias("cached"))
    named = requests.withColumn("cache_key", cache_key(customer)).withColumn("_own", customer_digest(customer))
    found = named.filter("_own IS NOT NULL").join(live, F.col("_own") == F.col("_digest"), "left").drop("_own", "_digest")
    rest = named.filter("_own IS NULL").withColumn("cached", F.lit(None).cast("string")).drop("_own")
    return found.unionByName(rest).withColumn("cache_hit", F.col("cached").isNotNull())


def uncached(requests: DataFrame, store: DataFrame, now: Column, customer: str = "customer_id") -> DataFrame:
    return lookup(requests, store, now, customer).filter(~F.col("cache_hit")).drop("cached", "cache_hit")


def restored(rows: DataFrame, schema: T.StructType, payload: str = "cached") -> DataFrame:
    """The stored columns back in their types, beside the other columns of ``rows``."""
    names = schema.names
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rest = [c for c in rows.columns if c not in names and c != payload]
    return rows.select(*rest, F.from_json(payload, text).alias("_p")).select(
        *rest, *[F.col(f"_p.{f.name}").cast(f.dataType).alias(f.name) for f in schema.fields])


def invalidate(store: DataFrame, customers: DataFrame, customer: str = "customer_id") -> DataFrame:
    """The store without the listed customers."""
    gone = customers.select(customer_digest(customer).alias("digest"))
    return store.join(gone, "digest", "left_anti")


def invalidated(store: DataFrame, customers: DataFrame, customer: str = "customer_id") -> DataFrame:
    """Per listed customer, whether there was an entry to delete."""
    gone = customers.select(customer_digest(customer).alias("digest")).filter("digest IS NOT NULL").distinct()
    return gone.join(store.select("digest", F.lit(True).alias("deleted")), "digest", "left").select(
        _short(F.col("digest")).alias("cache_key"), F.coalesce("deleted", F.lit(False)).alias("deleted"))


# --- replay -----------------------------------------------------------------
def following(events: DataFrame, starts: DataFrame, key: str, order: str, ttl: int) -> DataFrame:
    """For each start (``key``, ``_at``, ``_id``, ``_from``) the first event a lifetime or more after ``_from``: ``_next_at``, ``_next_id``.

    Time is cut into cells of one lifetime. A lifetime after a start lies in the cell
    behind its own: the answer is the next event there, by a running window over key
    and cell, or the first event of the next filled cell, by a window over the cells.
    """
    width = ttl * _MICROS
    kind = events.schema[order].dataType.simpleString()
    event = F.struct(F.col("_at").alias("at"), F.col("_id").alias("id"))
    rows = events.select(key, F.col("_at").alias("_when"), F.lit(0).alias("_asks"), F.lit(None).cast("long").alias("_at"),
                         F.lit(None).cast(kind).alias("_id"), event.alias("_event"))
    asks = starts.select(key, (F.col("_from") + width).alias("_when"), F.lit(1).alias("_asks"), "_at", "_id",
                         F.lit(None).cast(rows.schema["_event"].dataType).alias("_event"))
    both = rows.unionByName(asks).withColumn("_cell", F.expr(f"_when div {width}") - F.when(F.col("_when") < 0, 1).otherwise(0))
    # from the latest on; an event at the very time of a question comes before it, the first by order last
    back = Window.partitionBy(key, "_cell").orderBy(F.col("_when").desc(), "_asks", F.col("_event.id").desc())
    here = F.last("_event", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    firsts = both.groupBy(key, "_cell").agg(F.min(F.when(F.col("_asks") == 0, F.col("_event"))).alias("_first"))
    later = Window.partitionBy(key).orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select(key, "_cell", F.last("_first", ignorenulls=True).over(later).alias("_beyond"))
    found = both.withColumn("_here", here).filter("_asks = 1").join(firsts, [key, "_cell"])
    answer = F.coalesce("_here", "_beyond")
    return found.select(key, "_at", "_id", answer["at"].alias("_next_at"), answer["id"].alias("_next_id"))


def _in_blocks(rows: DataFrame, key: str, width: int, *order: str) -> DataFrame:
    """Rows of a key and a block of time together, in order of time."""
    blocks = rows.withColumn("_block", F.expr(f"(_at - pmod(_at, {width})) div {width}"))
    return blocks.repartition(key, "_block").sortWithinPartitions(key, "_block", "_at", *order)


def block_exits(rows: DataFrame, key: str, ttl: int) -> DataFrame:
    """Where the chain of misses can enter a block, and the last miss of the block if it does: ``key``, ``_at``, ``_id``, ``_exit``.

    It enters at an event of the block's first lifetime or at the first event after that, or begins at a row of ``_prior``,
    which has ``_id`` 1. Chains that meet go on as one, so a scan holds the chains of one lifetime at most.
    """
    life, width = ttl * _MICROS, BLOCK * ttl * _MICROS
    narrow = _in_blocks(rows.select(key, "_at", "_prior"), key, width).select(key, "_block", "_at", "_prior")
    names = [key, "_at", "_id", "_exit"]

    def run(batches):
        group, entries, parent, waiting = None, [], [], deque()

        def root(chain):
            while parent[chain] != chain:
                parent[chain] = chain = parent[parent[chain]]
            return chain

        def made():
            last = {chain: at for at, chain in waiting}
            return [(group[0], at, prior, last[root(chain)]) for chain, (at, prior) in enumerate(entries)]

        for batch in batches:
            out = []
            for k, block, at, prior in zip(*(c.to_pylist() for c in batch.columns)):
                if (k, block) != group:
                    out += made() if group else []
                    group, entries, parent, waiting = (k, block), [], [], deque()
                    end, entered, beyond = block * width + life, None, False
                chain = None
                if not prior:
                    while waiting and waiting[0][0] + life <= at:
                        ended = waiting.popleft()[1]
                        if chain is None:
                            chain = ended
                        parent[ended] = chain
                if prior or (at != entered and not beyond):
                    entries.append((at, int(prior)))
                    parent.append(len(parent) if chain is None else chain)
                    chain = parent[-1]
                    if not prior:
                        entered, beyond = at, at >= end
                if chain is not None:
                    waiting.append((at, chain))
            if out:
                yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names=names)
        if group:
            yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*made()), kinds)], names=names)

    schema = T.StructType([narrow.schema[key], T.StructField("_at", T.LongType()), T.StructField("_id", T.IntegerType()),
                           T.StructField("_exit", T.LongType())])
    kinds = to_arrow_schema(schema).types
    return narrow.mapInArrow(run, schema)


def block_misses(rows: DataFrame, key: str, ttl: int) -> DataFrame:
    """The misses of every block: events (``_kind`` 2) from the block's entry (1), or from a lifetime after an earlier miss (0), on."""
    life = ttl * _MICROS
    narrow = _in_blocks(rows, key, BLOCK * life, "_kind", "_id").select(key, "_block", "_at", "_kind", "_id")
    names = [key, "_at", "_id"]

    def run(batches):
        group = last = entry = None
        for batch in batches:
            missed = []
            for row, (k, block, at, kind) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:4]))):
                if (k, block) != group:
                    group, last, entry = (k, block), None, None
                if kind == 0:
                    last = at
                elif kind == 1:
                    entry = at
                elif at == entry or (last is not None and last + life <= at):
                    missed.append(row)
                    last, entry = at, None
            yield batch.select(names).take(pa.array(missed, pa.int64()))

    return narrow.mapInArrow(run, narrow.select(*names).schema)


def replay_misses(events: DataFrame, key: str = "user_id", ts: str = "ts",
                  order: str = "event_id", ttl: int = S.CACHE_TTL_SECONDS,
                  prior: DataFrame | None = None) -> DataFrame:
    """The events that miss: ``(key, _at, order)``, times in microseconds.

    An entry lives ``ttl`` from its miss, and hits do not renew it. ``prior`` holds the
    last miss per key of earlier data. Events without a key are never stored, so all
    of them miss.

    A key's misses are the chain from its first event to the first event a lifetime
    later, and so on. Time is cut into blocks. One scan finds for each place where the chain
    may enter a block where it leaves it; only these few places point to their successor, and
    the chain is marked among them by doubling the pointers, so the rounds are the logarithm
    of the most blocks of a key. A second scan marks the misses of each block from its entry on.
    """
    rows = events.select(key, F.unix_micros(ts).alias("_at"), F.col(order).alias("_id"))
    nameless = rows.filter(F.col(key).isNull())
    rows = rows.filter(F.col(key).isNotNull())
    # a key with an event without time has no first event
    timeless = rows.filter("_at IS NULL").select(key).distinct().withColumn("_timeless", F.lit(True))
    rows = rows.filter("_at IS NOT NULL")
    known = rows.select(key, "_at", F.lit(False).alias("_prior"))
    if prior is not None:
        known = known.unionByName(prior.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("_at").alias("_at")).filter(
            "_at IS NOT NULL").withColumn("_prior", F.lit(True)))
    exits = staged(block_exits(known, key, ttl), "replay")
    # earlier data begin a key's chain, else its first event
    heads = exits.groupBy(key).agg(F.min(F.struct((-F.col("_id")).alias("_first"), "_at")).alias("_h")).select(
        key, F.col("_h._at").alias("_at"), (-F.col("_h._first")).alias("_id"), F.lit(True).alias("_miss")).join(
        timeless, key, "left").filter("_id = 1 OR _timeless IS NULL").drop("_timeless")
    chain = following(exits.filter("_id = 0"), exits.withColumnRenamed("_exit", "_from"), key, order="_id", ttl=ttl).join(
        heads, [key, "_at", "_id"], "left").withColumn("_miss", F.coalesce("_miss", F.lit(False)))
    chain = staged(chain, "replay")
    discard(exits)
    place = [key, "_next_at", "_next_id"]
    while not chain.filter("_miss AND _next_at IS NOT NULL").isEmpty():
        after = chain.select(F.col(key), F.col("_at").alias("_next_at"), F.col("_id").alias("_next_id"),
                             F.col("_next_at").alias("_then_at"), F.col("_next_id").alias("_then_id"))
        reached = chain.filter("_miss AND _next_at IS NOT NULL").select(
            key, F.col("_next_at").alias("_at"), F.col("_next_id").alias("_id"), F.lit(True).alias("_reached"))
        before, chain = chain, staged(chain.join(after, place, "left").join(reached.distinct(), [key, "_at", "_id"], "left").select(
            key, "_at", "_id", F.col("_then_at").alias("_next_at"), F.col("_then_id").alias("_next_id"),
            (F.col("_miss") | F.coalesce("_reached", F.lit(False))).alias("_miss")), "replay")
        discard(before)
    entries = chain.filter("_miss").select(key, "_at", F.lit(None).cast(rows.schema["_id"].dataType).alias("_id"),
                                           (1 - F.col("_id")).alias("_kind"))
    misses = block_misses(rows.withColumn("_kind", F.lit(2)).unionByName(entries), key, ttl)
    return misses.unionByName(nameless).withColumnRenamed("_id", order)


def mark_hits(events: DataFrame, misses: DataFrame, key: str = "user_id",
              order: str = "event_id") -> DataFrame:
    """Events without a key are misses; they go past the join."""
    missed = misses.filter(F.col(key).isNotNull()).select(key, order, F.lit(True).alias("_miss"))
    named = events.filter(F.col(key).isNotNull()).join(missed, [key, order], "left")
    return named.withColumn("cache_hit", F.col("_miss").isNull()).drop("_miss").unionByName(
        events.filter(F.col(key).isNull()).withColumn("cache_hit", F.lit(False)))


def replay(events: DataFrame, key: str = "user_id", ts: str = "ts", order: str = "event_id",
           ttl: int = S.CACHE_TTL_SECONDS, prior: DataFrame | None = None) -> DataFrame:
    """Events with ``cache_hit`` by the replay rule."""
    return mark_hits(events, replay_misses(events, key, ts, order, ttl, prior), key, order)
