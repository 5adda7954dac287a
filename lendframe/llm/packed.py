"""Dealing many small records between tasks as a few compressed Arrow blobs.

A map task groups its records by bucket and emits one binary row per bucket instead of one row per
record; Spark shuffles those rows by ``bucket``, and a reduce task unpacks whole numpy columns. The
number of buckets follows ``spark.sql.shuffle.partitions``, so what one task holds shrinks as the
cluster's setting grows.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_libc = None
with contextlib.suppress(OSError):
    _libc = ctypes.CDLL("libc.so.6")
    _libc = _libc if hasattr(_libc, "malloc_trim") else None

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BLOB_SCHEMA = "bucket int, kind int, blob binary"
_ARROW_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
_WRITE = pa.ipc.IpcWriteOptions(compression="zstd")


def bucket_count(spark: SparkSession) -> int:
    """One bucket for each shuffle partition: the setting bounds what a task holds, and the number of blobs."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack(columns: dict[str, np.ndarray | pa.Array]) -> bytes:
    batch = pa.record_batch(list(columns.values()), names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_WRITE) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(blobs: list[bytes]) -> pa.Table | None:
    """All records of some blobs of one kind, in the order of the blobs."""
    tables = [pa.ipc.open_stream(b).read_all() for b in blobs]
    return pa.concat_tables(tables).combine_chunks() if tables else None


def unpacked(batches: Iterator[pa.RecordBatch], limit_bytes: int = 8 << 20) -> Iterator[pa.Table]:
    """Records of many blobs of one kind, joined up to a size."""
    held, size = [], 0
    for batch in batches:
        for blob in batch.column("blob").to_pylist():
            held.append(pa.ipc.open_stream(blob).read_all())
            size += held[-1].nbytes
            if size >= limit_bytes:
                yield pa.concat_tables(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def blob_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    if not rows:
        return pa.RecordBatch.from_pylist([], schema=_ARROW_SCHEMA)
    bucket, kind, blob = zip(*rows)
    return pa.record_batch([pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())],
                           schema=_ARROW_SCHEMA)


def deal(bucket: np.ndarray, columns: dict[str, np.ndarray | pa.Array], kind: int = 0) -> Iterator[pa.RecordBatch]:
    """One blob for each bucket that has records; the records of a bucket keep their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    dealt = bucket[order]
    cuts = np.flatnonzero(dealt[1:] != dealt[:-1]) + 1
    starts, ends = np.append(0, cuts), np.append(cuts, len(dealt))
    taken = {k: v[order] if isinstance(v, np.ndarray) else v.take(pa.array(order)) for k, v in columns.items()}
    rows, held = [], 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        part = {k: v[a:b] if isinstance(v, np.ndarray) else v.slice(a, b - a) for k, v in taken.items()}
        rows.append((int(dealt[a]), kind, pack(part)))
        held += len(rows[-1][2])
        if held > 16 << 20:
            yield blob_batch(rows)
            rows, held = [], 0
    if rows:
        yield blob_batch(rows)


def gathered(batches: Iterator[pa.RecordBatch], limit_bytes: int) -> Iterator[pa.Table]:
    """Input batches joined or split to about a size, so that blobs get large while memory stays bounded."""
    held, size = [], 0
    for batch in batches:
        rows = max(1, batch.num_rows * limit_bytes // max(1, batch.nbytes))
        for a in range(0, batch.num_rows, rows):
            part = batch.slice(a, rows)
            if held and size + part.nbytes > limit_bytes:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
            held.append(part)
            size += part.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def trim() -> None:
    """Give memory that is free back to the machine; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def trimmed(function):
    """A map over batches that leaves no free memory behind in its worker, and takes none over: what an earlier step had
    sent to the worker is let go as this one begins."""
    def run(batches):
        trim()
        try:
            yield from function(batches)
        finally:
            trim()

    return run


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` for rows that hold whole texts: batches of fewer rows than Spark's own default, unless the session
    has another setting, and no free memory left behind."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_ROWS, "10000") == "10000":
        conf.set(_BATCH_ROWS, "1000")
    return df.mapInArrow(trimmed(function), schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(keys) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def by_bucket(blobs: DataFrame, function, schema: str) -> DataFrame:
    """Run ``function`` on each bucket's blobs: given {kind: table of all records}, it yields record batches.

    Blobs of one bucket meet in one task; a bucket's size is bounded by the number of buckets.
    """
    def run(table: pa.Table) -> pa.Table | None:
        kinds, blobs_ = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        by_kind: dict[int, list[bytes]] = {}
        for k, b in zip(kinds, blobs_):
            by_kind.setdefault(k, []).append(b)
        out = list(function({k: unpack(v) for k, v in by_kind.items()}))
        return pa.Table.from_batches(out) if out else None

    def guarded(table: pa.Table) -> pa.Table:
        made = run(table)
        trim()
        return made if made is not None else empty

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    kind_of = _parse_datatype_string(schema)
    assert isinstance(kind_of, StructType)
    empty = to_arrow_schema(kind_of).empty_table()
    # plans show which step a group belongs to
    guarded.__name__ = function.__qualname__.split(".")[0].strip("_")
    return blobs.groupBy("bucket").applyInArrow(guarded, schema)
