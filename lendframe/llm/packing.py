"""Documents packed into token sequences of a fixed capacity by bounded-space online best-fit.

Each document is its token numbers and an end number. What is longer than the capacity is cut into full pieces, each a
sequence of its own, and a first piece with the rest. All shorter pieces go through packers: each Spark partition is a
stream in the random order of a hash, read in windows whose pieces come by falling length. A packer keeps a fixed number
of open bins. Their free spaces are bits of one number, so the bin that fits best is the lowest bit from the piece's
length on. When no bin fits and all are open, the fullest closes. Memory is the open bins and one window.

Bins that are open when a partition ends come back as blocks, through fewer packers, until few packers are left.

Defined results: null text counts as empty: a piece of the end number alone. Rows map one to one, so repeated rows and
null or repeated ids are packed as documents of their own. Special strings inside a text are the tokens that the library
makes of them. Equal input gives equal pieces; which pieces share a sequence depends on how the input is split. An empty
table gives none. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lendframe.llm.encoders import BytePairs, made_once
from lendframe.llm.packed import map_batches
from lendframe.llm.token_counts import parts
from lendframe.staging import staged

#: Open bins of a packer, pieces of one window, pieces of one packer, packers whose last bins meet in one packer of the next round.
OPEN_BINS, WINDOW, PACKER_ROWS, JOINED = 4096, 4096, 1 << 17, 16
TEXT_BYTES = 4 << 20
#: Packers whose open bins are left as they are.
FEW = 8


def cut(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of a document: all full but the first, which takes the rest."""
    at = 0
    size = length % capacity or capacity
    while at < length:
        yield at, size
        at, size = at + size, capacity


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (little-endian 32-bit numbers), ``_key`` (its own number), and its
    ``ids`` if wanted. The key holds the input split, so write the rows before reading them twice."""
    narrow = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    schema = (f"{id_column} {narrow.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, _key long"
              + (", ids array<int>" if with_ids else ""))

    def run(batches):
        own = made_once(BytePairs, path)
        number = TaskContext.get().partitionId() << 38
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).to_pylist()
            for a, b in parts(sizes, TEXT_BYTES):
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(batch.column("text").slice(a, b - a).to_pylist(), a):
                    tokens = np.append(own.encode(text), end_id).astype("<u4")
                    for k, (at, size) in enumerate(cut(len(tokens), capacity)):
                        own_ids = tokens[at:at + size]
                        row.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(own_ids.tobytes()))
                        if with_ids:
                            ids.append(own_ids)
                columns = [batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.arange(number, number + len(row)), pa.int64())]
                names = [id_column, "piece", "start", "length", "ids_crc32", "_key"]
                if with_ids:
                    flat = np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(flat)))
                    names.append("ids")
                number += len(row)
                yield pa.record_batch(columns, names=names)

    return narrow.transform(map_batches, run, schema)


class Packer:
    """Bins of one capacity, of which a fixed number stays open."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.spaces = 0  # bit f: a bin with f free places is open
        self.by_space: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.count = 0

    def _take(self, space: int) -> list:
        bins = self.by_space[space]
        taken = bins.pop()
        if not bins:
            self.spaces ^= 1 << space
        self.count -= 1
        return taken

    def put(self, size: int, block) -> list[list]:
        """Lay a block into the fullest bin that has room; returns the bins that closed by it, each a list of (offset, block)."""
        closed = []
        fitting = self.spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            chosen = self._take(space)
        else:
            if self.count == self.open_bins:
                closed.append(self._take((self.spaces & -self.spaces).bit_length() - 1))
            space, chosen = self.capacity, []
        chosen.append((self.capacity - space, block))
        space -= size
        if space:
            self.by_space[space].append(chosen)
            self.spaces |= 1 << space
            self.count += 1
        else:
            closed.append(chosen)
        return closed

    def rest(self) -> Iterator[list]:
        while self.spaces:
            yield self._take((self.spaces & -self.spaces).bit_length() - 1)


def _pack_round(rows: DataFrame, packers: int, capacity: int, open_bins: int, window: int) -> DataFrame:
    """One round over blocks: rows of one ``sequence_id`` lie at their ``offset`` and stay together."""
    order = F.xxhash64("sequence_id", F.lit(packers))
    dealt = rows.withColumn("_order", order).repartition(packers, "_order").sortWithinPartitions("_order", "sequence_id", "offset").drop("_order")
    names = dealt.columns
    schema = T.StructType([*dealt.schema.fields, T.StructField("open", T.BooleanType())])
    types = to_arrow_schema(schema)
    at_id, at_offset, at_length = names.index("sequence_id"), names.index("offset"), names.index("length")

    def written(bins: list[list], is_open: bool):
        out = []
        for bin_ in bins:
            name = bin_[0][1][0][at_id]
            for offset, block in bin_:
                for row in block:
                    row = list(row)
                    row[at_id], row[at_offset] = name, offset + row[at_offset]
                    out.append((*row, is_open))
        columns = list(zip(*out)) if out else [[] for _ in types]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    def run(batches):
        packer, waiting, block = Packer(capacity, open_bins), [], []

        def lay():
            """Blocks of one window by falling size."""
            waiting.sort(key=lambda x: -x[0])
            closed = [bin_ for size, rows_ in waiting for bin_ in packer.put(size, rows_)]
            waiting.clear()
            return written(closed, False)

        def whole(rows_):
            return rows_[-1][at_offset] + rows_[-1][at_length], rows_

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if block and block[0][at_id] != row[at_id]:
                    waiting.append(whole(block))
                    block = []
                    if len(waiting) == window:
                        yield lay()
                block.append(row)
        if block:
            waiting.append(whole(block))
        yield lay()
        yield written(list(packer.rest()), True)

    return dealt.mapInArrow(run, schema)


def placed(cut_pieces: DataFrame, capacity: int = 1024, open_bins: int = OPEN_BINS, window: int = WINDOW,
           packer_rows: int = PACKER_ROWS) -> DataFrame:
    """Written pieces with ``sequence_id`` and ``offset`` instead of their key."""
    full = cut_pieces.filter(F.col("length") == capacity).select(
        *[c for c in cut_pieces.columns if c != "_key"], F.col("_key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = cut_pieces.filter(F.col("length") < capacity).select(*full.columns[:-2], F.col("_key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    packers = max(1, -(-left.count() // packer_rows))
    done = [full]
    while True:
        now = staged(_pack_round(left, packers, capacity, open_bins, window), "packed")
        if packers <= FEW:
            done.append(now.drop("open"))
            break
        done.append(now.filter("NOT open").drop("open"))
        left, packers = now.filter("open").drop("open"), -(-packers // JOINED)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset, and its ids if wanted."""
    return placed(staged(pieces(docs, path, capacity, end_id, with_ids, id_column, text_column), "pieces"), capacity)


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """``sequence_id`` and its token ``ids``, from pieces that hold theirs. A sequence has at most its capacity of tokens."""
    laid = packed_pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_laid"))
    return laid.select("sequence_id", F.flatten(F.transform("_laid", lambda x: x["ids"])).alias("ids"))
