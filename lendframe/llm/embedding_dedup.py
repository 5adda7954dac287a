"""Near-duplicate embeddings by Euclidean p-stable hashing of normalised vectors.

On the unit sphere a cosine is a distance. Each of several tables projects a vector on random directions (normal, so that
the projection of a difference is as wide as the difference is long), quantises the projections into steps of ``STEP``,
and takes the steps of all its directions as the bucket. Directions a table and number of tables follow from the number of
vectors, so that buckets stay small, and from the recall wanted of pairs that are just similar enough; pairs that are more
similar are found more surely. All pairs of a bucket are checked by their exact cosine in double precision.

Equal vectors are merged first and counted. A bucket of more than ``BLOCK`` vectors is split into blocks, and each pair
of blocks is a unit of work of its own, so no task holds more than two blocks of one bucket. Pairs are not written out:
a unit adds up the links of each vector, counting a pair in the first table that has it only, and keeps one link for
each vector of a group, which is what the components need.

Defined results: null, empty and zero vectors, and those with null or non-finite components, link with nothing. Vectors of
different lengths do not link. Rows are told apart as in ``ids.py``; repeated rows are vectors of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.components import components
from lendframe.llm.ids import keyed
from lendframe.llm.packed import bucket_count, mix, map_batches
from lendframe.staging import staged

U = np.uint64
STEP, BUCKET, BLOCK = 2.0, 256, 1024


def collision(distance: float, step: float = STEP) -> float:
    """Chance that a quantised projection is equal for two vectors at this distance."""
    t = step / distance
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def layout(n: int, least: float, recall: float) -> tuple[int, int]:
    """Directions of a table, and tables: unrelated vectors fill buckets of about ``BUCKET``; pairs at ``least`` are found
    with the wanted chance."""
    near, far = collision(math.sqrt(2 - 2 * least) or 1e-9), collision(math.sqrt(2))
    directions = max(1, math.ceil(math.log(max(n / BUCKET, 1.0)) / -math.log(far)))
    return directions, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near ** directions)))


def bucket_keys(vectors: np.ndarray, directions: int, tables: int, seed: int = 17) -> np.ndarray:
    """The bucket of each unit vector in each table, as 64-bit keys."""
    rng = np.random.default_rng([seed, vectors.shape[1], directions, tables])
    lines = rng.normal(size=(vectors.shape[1], directions * tables))
    steps = np.floor((vectors @ lines + rng.random(directions * tables) * STEP) / STEP).astype(np.int64).view(U)
    keys = np.empty((len(vectors), tables), U)
    for t in range(tables):
        key = np.full(len(vectors), U(t + 1)) ^ (U(vectors.shape[1]) << U(32))
        for k in range(t * directions, (t + 1) * directions):
            key = mix(key * U(0x9E3779B97F4A7C15) ^ steps[:, k])
        keys[:, t] = key
    return keys


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _entries(classes: DataFrame, directions: int, tables: int) -> DataFrame:
    """A row for each vector and table: bucket key, table, and what a unit of work needs."""
    schema = "key long, tab int, uid long, copies long, vector array<double>, keys array<long>"
    names = ["key", "tab", "uid", "copies", "vector", "keys"]

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                flat, size = part.column("vector").flatten().to_numpy(zero_copy_only=False), part.column("size").to_numpy()
                start = np.cumsum(size) - size
                for n in np.unique(size).tolist():
                    rows = np.flatnonzero(size == n)
                    vectors = unit(flat[start[rows][:, None] + np.arange(n)])
                    keys = bucket_keys(vectors, directions, tables).view(np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, vectors.size + 1, n), pa.int32()), pa.array(vectors.ravel()))
                    codes = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables), pa.int32()), pa.array(keys.ravel()))
                    uid, copies = (part.column(c).take(pa.array(rows)) for c in ("uid", "copies"))
                    for t in range(tables):
                        yield pa.record_batch([pa.array(keys[:, t].copy()), pa.array(np.full(len(rows), t, np.int32)), uid, copies, lists, codes], names=names)

    return classes.select("uid", "copies", F.col("vector").cast("array<double>").alias("vector"), F.size("vector").cast("long").alias("size")).transform(map_batches, run, schema)


def _labels(linked: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each row of a symmetric table of links."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label, len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _unit_links(table: pa.Table, least: float, tables: int):
    """Links of one bucket's units: per vector the copies it links with; and links that hold its components together."""
    key, left, right, side, uid = (table.column(c).to_numpy() for c in ("key", "left", "right", "side", "uid"))
    copies, tab = table.column("copies").to_numpy(), table.column("tab").to_numpy()
    order = np.lexsort((uid, side, right, left, key))
    changed = [np.append(True, x[order][1:] != x[order][:-1]) for x in (key, left, right)]
    new = changed[0] | changed[1] | changed[2]
    starts = np.append(np.flatnonzero(new), len(order))
    vectors = table.column("vector").combine_chunks()
    offset, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy()
    codes = table.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, tables)
    counted, summed, a_side, b_side = [], [], [], []
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
        rows = order[s:e]
        if e - s < 2:
            continue
        n = int(offset[rows[0] + 1] - offset[rows[0]])
        x = flat[offset[rows][:, None] + np.arange(n)]
        linked = x @ x.T >= least
        np.fill_diagonal(linked, False)
        if left[rows[0]] != right[rows[0]]:  # two blocks: pairs inside a block belong to that block's own unit
            linked &= side[rows][:, None] != side[rows][None, :]
        if not linked.any():
            continue
        c = codes[rows]
        for t in range(int(tab[rows[0]])):
            linked &= c[:, t][:, None] != c[:, t][None, :]
        counted.append(uid[rows])
        summed.append(linked @ copies[rows])
        label = _labels(linked)
        apart = np.flatnonzero(label != np.arange(len(label)))
        a_side.append(uid[rows][apart])
        b_side.append(uid[rows][label[apart]])
    none = np.zeros(0, np.int64)
    nodes, inverse = np.unique(np.concatenate([none, *counted]), return_inverse=True)
    sums = np.bincount(inverse, np.concatenate([none, *summed]), minlength=len(nodes)).astype(np.int64)
    edges = np.unique(np.stack([np.concatenate([none, *a_side]), np.concatenate([none, *b_side])]), axis=1)
    zero, null = np.zeros(len(edges[0]), np.int64), np.full(len(nodes), -1)
    return pa.table({"a": np.append(nodes, edges[0]), "b": pa.array(np.append(null, edges[1]), mask=np.append(null < 0, zero > 0)),
                     "links": np.append(sums, zero)})


def linked_classes(classes: DataFrame, least: float, recall: float) -> DataFrame:
    """``a``, ``b``, ``links``: rows without ``b`` carry link counts of ``a``; rows with it join ``a`` to ``b``."""
    spark = classes.sparkSession
    directions, tables = layout(max(classes.count(), 1), least, recall)
    entries = _entries(classes, directions, tables)
    sizes = _entries(classes, directions, tables).groupBy("key").count().filter(F.col("count") > BLOCK)
    large = staged(sizes.select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large-buckets")
    split = entries.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    split = split.withColumn("own", F.pmod(F.xxhash64("uid", "key"), F.col("blocks")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = split.select("key", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
                         (F.col("own") > F.col("other")).cast("int").alias("side"), "tab", "uid", "copies", "vector", "keys")
    units = units.withColumn("bucket", F.pmod(F.xxhash64("key", "left", "right"), F.lit(bucket_count(spark))).cast("int"))

    def unit_links(table: pa.Table) -> pa.Table:
        return _unit_links(table, least, tables)

    return staged(units.groupBy("bucket").applyInArrow(unit_links, "a long, b long, links long"), "vector-links")


def report(vectors: DataFrame, least: float = 0.9, recall: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per vector: id, n_links, component_id (smallest id reachable by links, itself included), kept (it is that one)."""
    rows = keyed(vectors.select(F.col(id_column), F.col(vector_column)), id_column, vector_column)
    inf = F.lit(float("inf"))
    fine = F.forall("value", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("value", lambda x: x != 0)
    # equal vectors meet by a digest of their bytes
    digest = F.sha2(F.to_json(F.struct("value")).cast("binary"), 256)
    marked = rows.select("uid", "id", F.when(F.coalesce(fine, F.lit(False)), digest).alias("digest"))
    stands = marked.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("uid").alias("stands"), F.count("*").alias("copies"))
    stands = staged(stands, "vector-classes")
    classes = rows.join(stands.withColumnRenamed("stands", "uid"), "uid").select("uid", "copies", F.col("value").alias("vector"))
    found = linked_classes(staged(classes, "distinct-vectors"), least, recall)
    links = found.filter("b IS NULL").groupBy(F.col("a").alias("stands")).agg(F.sum("links").alias("links"))
    joined = components(found.filter("b IS NOT NULL"), "a", "b").withColumnRenamed("node", "stands")
    facts = stands.join(links, "stands", "left").join(joined, "stands", "left").select(
        "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "stands").alias("component"))
    each = marked.join(facts, "digest", "left").select(
        "uid", "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "uid").alias("component"))
    names = rows.select(F.col("uid").alias("component"), F.col("id").alias("component_id"))
    return each.join(names, "component").select(F.col("id").alias(id_column), "n_links", "component_id", (F.col("uid") == F.col("component")).alias("kept"))
