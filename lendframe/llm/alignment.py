"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of linked token pairs by external counting.

Each text is cut into groups where tokens of both sides end at one byte. All tokens of a group are linked across. How
many documents hold a pair of numbers linked is counted outside of memory:

1. A task aligns a block of documents, sorts its (pair, document) records side-major, that is by the first tokenizer's
   number and then by the second's, and writes one zstd run for each radix of the first number: the pairs with their numbers of
   documents, and apart from them the documents and how often each holds the pair.
2. Runs of a radix are merged k ways: a heap holds the first pair of the next block of each run, blocks are taken while
   they may still meet smaller pairs, and what lies below the heap is counted. Each pair of a run is one record however many documents
   hold it, so a frequent pair costs one record a block. Many runs are merged in rounds of bounded size. In side-major
   order all pairs of a first number come together, so its highest count is known when the next number begins.
3. The runs of a radix are dealt to salted parts of bounded size. Each part streams its runs past the counts of the radix
   and sends what they contribute to each document back to the part of its block.

Defined results: null, empty and irreproducible texts (the tokens of one side do not spell the space and the text) have no
tokens: zeros and an empty digest. Rows are documents of their own, so repeated rows and null or repeated ids each count. Ties
for the highest count all count as best. An empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.encoders import BytePairs, Pieces, made_once
from lendframe.llm.packed import BLOB_SCHEMA, blob_batch, map_batches, pack, trim
from lendframe.llm.token_counts import parts
from lendframe.staging import staged

#: Parts of the first numbers, bytes of text of a block, pairs of one block of a run, pairs that a merge holds before it counts.
RADIX, TEXT_BYTES, RUN_ROWS, HELD_ROWS = 32, 4 << 20, 4096, 1 << 20
#: Bytes of runs that one task merges or streams, parts that meet in one of the next round, blocks whose documents meet in one task.
GROUP_BYTES, FAN_IN, GROUP_BLOCKS = 24 << 20, 8, 32
#: Links made at a time, and the most in a group that are listed one by one.
LINKS, LISTED = 1 << 22, 4096
#: Bits of a number of the second side, and of a document's place in its block.
B_BITS, DOC_BITS = 20, 22
_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


@dataclass
class Side:
    """Bytes of the token numbers of one tokenizer."""

    sizes: np.ndarray
    starts: np.ndarray
    flat: np.ndarray
    digits: np.ndarray  # each number in decimal digits, in a row of its own
    digit_count: np.ndarray

    @classmethod
    def of(cls, table: list[bytes]) -> Side:
        sizes = np.array([len(t) for t in table], np.int64)
        names = [str(i).encode() for i in range(len(table))]
        width = max(map(len, names), default=1)
        return cls(sizes, np.cumsum(sizes) - sizes, np.frombuffer(b"".join(table), np.uint8),
                   np.frombuffer(b"".join(n.ljust(width) for n in names), np.uint8).reshape(-1, width), np.array([len(n) for n in names], np.int64))

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        size = self.sizes[ids]
        before = np.cumsum(size) - size
        return self.flat[np.repeat(self.starts[ids] - before, size) + np.arange(int(size.sum()))]


class Aligner:
    """Two encoders and their tables, made once a worker."""

    def __init__(self, paths: tuple[str, str]):
        self.first, self.second = made_once(BytePairs, paths[0]), made_once(Pieces, paths[1])
        self.a, self.b = Side.of(self.first.byte_table()), Side.of(self.second.byte_table())

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [self.first.encode(" " + t, specials=False) if t else np.zeros(0, np.uint32) for t in texts]
        b = [np.array(x, np.uint32) for x in self.second.encode(texts)]
        return a, b


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _aligners:
        _aligners[paths] = Aligner(paths)
    return _aligners[paths]


@dataclass
class Aligned:
    """Tokens of a block of documents, and the groups that they fall in. ``docs`` are the places of the documents that have tokens."""

    docs: np.ndarray
    ids: tuple[np.ndarray, np.ndarray]
    group: tuple[np.ndarray, np.ndarray]
    group_doc: np.ndarray  # index into ``docs``

    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.group_doc)
        return np.bincount(self.group[0], minlength=n), np.bincount(self.group[1], minlength=n)


def align(texts: list[str], own: Aligner) -> Aligned:
    raw = [(" " + t).encode() if t else b"" for t in texts]
    tokens = own.encode(texts)
    size = np.array([len(r) for r in raw], np.int64)
    fine = size > 0
    for ids, side in zip(tokens, (own.a, own.b)):
        spelled = np.array([int(side.sizes[i].sum()) for i in ids], np.int64)
        fine &= spelled == size
    docs = np.flatnonzero(fine)
    if len(docs):
        source = np.frombuffer(b"".join(raw[i] for i in docs.tolist()), np.uint8)
        differs = np.zeros(len(source), bool)
        for ids, side in zip(tokens, (own.a, own.b)):
            differs |= side.spelled(np.concatenate([ids[i] for i in docs.tolist()])) != source
        starts = np.cumsum(size[docs]) - size[docs]
        docs = docs[~np.logical_or.reduceat(differs, starts)]
    none = np.zeros(0, np.int64)
    if not len(docs):
        return Aligned(docs, (none, none), (none, none), none)
    joined = tuple(np.concatenate([ids[i] for i in docs.tolist()]).astype(np.int64) for ids in tokens)
    ends = tuple(np.cumsum(side.sizes[ids]) for ids, side in zip(joined, (own.a, own.b)))
    total = int(size[docs].sum())
    marks = [np.zeros(total + 1, bool) for _ in ends]
    for m, e in zip(marks, ends):
        m[e] = True
    group, closes = [], []
    for e, other in zip(ends, marks[::-1]):
        last = other[e]
        group.append(np.cumsum(last) - last)
        closes.append(e[last])
    # a group's last byte lies in its document
    group_doc = np.searchsorted(np.cumsum(size[docs]), closes[0], side="left")
    return Aligned(docs, joined, tuple(group), group_doc)


def written(found: Aligned, own: Aligner) -> list[bytes]:
    """For each document with tokens its groups in decimal: numbers by commas, sides by a bar, groups by semicolons."""
    (a, b), (ga, gb) = found.ids, found.group
    n_a, n_b = found.sizes()
    before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    # the first side of a group goes after all of earlier groups, its second side after its first
    place_a = np.arange(len(a)) + before_b[ga]
    place_b = np.arange(len(b)) + (before_a + n_a)[gb]
    total = len(a) + len(b)
    width = max(own.a.digits.shape[1], own.b.digits.shape[1])
    cells = np.full((total, width + 1), 32, np.uint8)
    count = np.zeros(total, np.int64)
    for ids, place, side in ((a, place_a, own.a), (b, place_b, own.b)):
        cells[place, :side.digits.shape[1]] = side.digits[ids]
        count[place] = side.digit_count[ids]
    after = np.full(total, ord(","), np.uint8)
    after[(before_a + before_b + n_a) - 1] = ord("|")
    ends = before_a + before_b + n_a + n_b
    after[ends - 1] = ord(";")
    cells[np.arange(total), count] = after
    text = cells[np.arange(width + 1) <= count[:, None]]
    per_doc = np.bincount(found.group_doc, weights=None, minlength=len(found.docs))
    last_token = ends[np.cumsum(per_doc) - 1]
    stops = np.cumsum(count + 1)[last_token - 1]
    data, out, at = text.tobytes(), [], 0
    for stop in stops.tolist():
        out.append(data[at:stop - 1])
        at = stop
    return out


def permuted(a: np.ndarray, numbers: int) -> np.ndarray:
    """First numbers in the order of their radix, so that the numbers of a radix are neighbours."""
    per = -(-numbers // RADIX)
    return (a % RADIX) * per + a // RADIX


def pair_records(found: Aligned, numbers: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (first number permuted, second number, document) and how many links each stands for."""
    (a, b), (ga, gb) = found.ids, found.group
    n_a, n_b = found.sizes()
    first = permuted(a, numbers)
    head = np.cumsum(n_b) - n_b
    doc = found.docs[found.group_doc] if len(found.docs) else found.docs
    keys, counts = [], []
    links = n_a * n_b
    # groups of few links are listed link by link, in slices
    small = np.flatnonzero((links <= LISTED)[ga])
    upto = np.cumsum(n_b[ga[small]])
    at = 0
    while at < len(small):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LINKS, side="right")))
        some = small[at:stop]
        g = ga[some]
        each = n_b[g]
        before = np.cumsum(each) - each
        partner = np.repeat(head[g] - before, each) + np.arange(int(each.sum()))
        made = (np.repeat((first[some] << (B_BITS + DOC_BITS)) | doc[g], each)) | (b[partner] << DOC_BITS)
        made.sort()
        edge = np.flatnonzero(np.append(True, made[1:] != made[:-1])) if len(made) else np.zeros(0, np.int64)
        keys.append(made[edge])
        counts.append(np.diff(np.append(edge, len(made))))
        at = stop
    # groups of many links go by their distinct numbers
    tail = np.cumsum(n_a) - n_a
    for g in np.flatnonzero(links > LISTED).tolist():
        xs, x_n = np.unique(first[tail[g]:tail[g] + n_a[g]], return_counts=True)
        ys, y_n = np.unique(b[head[g]:head[g] + n_b[g]], return_counts=True)
        keys.append(((xs[:, None] << (B_BITS + DOC_BITS)) | (ys[None, :] << DOC_BITS) | doc[g]).ravel())
        counts.append((x_n[:, None] * y_n[None, :]).ravel())
    return summed(keys, counts)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if len(keys) == 1:
        return keys[0], counts[0]
    k, n = np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    if not len(k):
        return k, n
    edge = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[edge], np.add.reduceat(n, edge)


# --- runs -------------------------------------------------------------------
def run_of(pairs: np.ndarray, **columns: np.ndarray) -> bytes:
    """Sorted pairs and what belongs to each, as zstd blocks of so many pairs; pairs as differences within a block."""
    sink = pa.BufferOutputStream()
    schema = pa.schema([("pair", pa.int64()), *[(k, pa.from_numpy_dtype(v.dtype)) for k, v in columns.items()]])
    with pa.ipc.new_stream(sink, schema, options=_ZSTD) as writer:
        for at in range(0, len(pairs), RUN_ROWS):
            part = pairs[at:at + RUN_ROWS]
            writer.write_batch(pa.record_batch([pa.array(np.diff(part, prepend=0)), *[pa.array(v[at:at + RUN_ROWS]) for v in columns.values()]], schema=schema))
    return sink.getvalue().to_pybytes()


def blocks_of(run: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in pa.ipc.open_stream(run):
        yield (np.cumsum(batch.column(0).to_numpy()), *[c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])


def merged(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-way merge: pairs in order with their summed counts, in stretches; no pair stands in two of them."""
    streams = [blocks_of(r) for r in runs]
    heap: list[tuple[int, int]] = []
    ahead: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def advance(i: int) -> None:
        block = next(streams[i], None)
        if block is not None:
            ahead[i] = block
            heapq.heappush(heap, (int(block[0][0]), i))

    for i in range(len(streams)):
        advance(i)
    keys, counts, held = [], [], 0
    while heap:
        _, i = heapq.heappop(heap)
        block = ahead.pop(i)
        keys.append(block[0])
        counts.append(block[1].astype(np.int64))
        held += len(block[0])
        advance(i)
        if held >= HELD_ROWS and heap:
            k, n = summed(keys, counts)
            cut = int(np.searchsorted(k, heap[0][0], side="left"))
            if cut:
                yield k[:cut], n[:cut]
            keys, counts, held = [k[cut:]], [n[cut:]], len(k) - cut
    k, n = summed(keys, counts)
    if len(k):
        yield k, n


def with_best(stretches: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs, counts, and whether the count is the highest of its first number, as soon as that number has ended."""
    kept_k, kept_n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def judged(k, n):
        first = k >> B_BITS
        edge = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        most = np.repeat(np.maximum.reduceat(n, edge), np.diff(np.append(edge, len(k))))
        return k, n, n == most

    for k, n in stretches:
        k, n = np.append(kept_k, k), np.append(kept_n, n)
        cut = int(np.searchsorted(k >> B_BITS, k[-1] >> B_BITS, side="left"))
        kept_k, kept_n = k[cut:], n[cut:]
        if cut:
            yield judged(k[:cut], n[:cut])
    if len(kept_k):
        yield judged(kept_k, kept_n)


# --- jobs -------------------------------------------------------------------
_RUNS = "kind int, radix int, block long, spread int, docs int, size long, pairs binary, records binary"
_RUN_SCHEMA = pa.schema([("kind", pa.int32()), ("radix", pa.int32()), ("block", pa.int64()), ("spread", pa.int32()), ("docs", pa.int32()), ("size", pa.int64()),
                         ("pairs", pa.binary()), ("records", pa.binary())])
FACTS, RUN = 0, 1


def _smallest(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.int64)


def _block_rows(block: int, ids: pa.Array, texts: list[str], own: Aligner) -> Iterator[dict]:
    """The facts of a block's documents, and its runs."""
    found = align(texts, own)
    n = len(texts)
    n_a, n_b = found.sizes()
    facts = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    for name, weight in (("n_a", n_a), ("n_b", n_b), ("n_groups", np.ones(len(n_a), np.int64)), ("n_links", n_a * n_b)):
        np.add.at(facts[name], found.docs[found.group_doc] if len(found.docs) else found.docs, weight)
    digests = [""] * n
    if len(found.docs):
        for i, text in zip(found.docs.tolist(), written(found, own)):
            digests[i] = hashlib.sha256(text).hexdigest()
    # blocks are dealt by this number: those of many splits are spread
    common = {"block": block, "spread": (block * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 33, "docs": n}
    yield {**common, "kind": FACTS, "radix": -1, "size": 0, "records": b"",
           "pairs": pack({"doc_id": ids, **facts, "groups_sha256": pa.array(digests, pa.string())})}
    numbers = len(own.a.sizes)
    keys, links = pair_records(found, numbers)
    pair, doc = keys >> DOC_BITS, keys & ((1 << DOC_BITS) - 1)
    edge = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    held, distinct = np.diff(np.append(edge, len(pair))), pair[edge]
    per = -(-numbers // RADIX)
    bounds = np.searchsorted(distinct >> B_BITS, np.arange(RADIX + 1) * per)
    first_record = np.append(edge, len(pair))
    for radix in range(RADIX):
        x, y = int(bounds[radix]), int(bounds[radix + 1])
        if x < y:
            s, e = int(first_record[x]), int(first_record[y])
            pairs = run_of(distinct[x:y], n=_smallest(held[x:y]))
            records = pack({"doc": _smallest(doc[s:e]), "links": _smallest(links[s:e])})
            yield {**common, "kind": RUN, "radix": radix, "size": len(pairs) + len(records), "pairs": pairs, "records": records}


def block_runs(docs: DataFrame, paths: tuple[str, str], id_column: str, text_column: str) -> DataFrame:
    narrow = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        own = aligner(paths)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).to_pylist()
            for a, b in parts(sizes, TEXT_BYTES):
                rows = list(_block_rows(block, batch.column("id").slice(a, b - a), batch.column("text").slice(a, b - a).to_pylist(), own))
                block += 1
                yield pa.RecordBatch.from_pylist(rows, schema=_RUN_SCHEMA)

    return narrow.transform(map_batches, run, _RUNS)


def _parts(rows: DataFrame, size: str) -> dict[int, int]:
    """For each radix the parts that its runs are dealt to, each of about ``GROUP_BYTES``."""
    return {r.radix: max(1, -(-int(r.total) // GROUP_BYTES)) for r in rows.groupBy("radix").agg(F.sum(size).alias("total")).collect()}


def _salted(rows: DataFrame, of_radix: dict[int, int]) -> DataFrame:
    """``rows`` with ``salts``, the parts of their radix, and ``salt``, their own part."""
    of = F.lit(1)
    for radix, n in of_radix.items():
        if n > 1:
            of = F.when(F.col("radix") == radix, F.lit(n)).otherwise(of)
    return rows.withColumn("salts", of.cast("int")).withColumn("salt", F.pmod(F.xxhash64("block"), F.col("salts")).cast("int"))


def pair_totals(runs: DataFrame) -> DataFrame:
    """One run per radix and stretch: pairs, counts over all documents, and whether a count is its first number's highest."""
    schema = "radix int, block long, pairs binary"
    out = pa.schema([("radix", pa.int32()), ("block", pa.int64()), ("pairs", pa.binary())])

    def merge_runs(final: bool):
        def run(table: pa.Table) -> pa.Table:
            stretches = merged(table.column("pairs").to_pylist())
            radix = table.column("radix")[0].as_py()
            block = min(table.column("block").to_pylist())
            if final:
                made = [run_of(k, n=_smallest(n), best=best) for k, n, best in with_best(stretches)]
            else:
                # one run, though it was merged in stretches
                made = [joined_run(stretches)]
            trim()
            return pa.table({"radix": [radix] * len(made), "block": [block] * len(made), "pairs": made}, schema=out)

        return run

    rows = runs.select("radix", "block", "pairs")
    of_radix = _parts(rows.withColumn("size", F.length("pairs")), "size")
    while True:
        final = max(of_radix.values(), default=1) == 1
        made = _salted(rows, of_radix).groupBy("radix", "salt").applyInArrow(merge_runs(final), schema)
        rows = staged(made, "totals" if final else "merged")
        if final:
            return rows
        # fewer parts in each round, also where runs share few pairs
        of_radix = {radix: -(-n // FAN_IN) for radix, n in of_radix.items()}


def joined_run(stretches: Iterator[tuple[np.ndarray, np.ndarray]]) -> bytes:
    sink = pa.BufferOutputStream()
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
    with pa.ipc.new_stream(sink, schema, options=_ZSTD) as writer:
        for k, n in stretches:
            for at in range(0, len(k), RUN_ROWS):
                writer.write_batch(pa.record_batch([pa.array(np.diff(k[at:at + RUN_ROWS], prepend=0)), pa.array(n[at:at + RUN_ROWS])], schema=schema))
    return sink.getvalue().to_pybytes()


def contributions(runs: DataFrame, totals: DataFrame, groups: int) -> DataFrame:
    """What each run adds to the sums of its block's documents, dealt to the parts of the blocks."""
    dealt = _salted(runs, _parts(runs, "size"))
    salts = dealt.select("radix", "salts").distinct()
    everywhere = totals.join(F.broadcast(salts), "radix").select("radix", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "pairs")

    def contribute(runs_: pa.Table, totals_: pa.Table) -> pa.Table:
        known = [b for t in totals_.column("pairs") for b in blocks_of(t.as_py())]
        out = []
        if known and runs_.num_rows:
            pair, count, best = (np.concatenate(c) for c in zip(*known))
            order = np.argsort(pair)
            pair, count, best = pair[order], count[order].astype(np.int64), best[order]
            for block, spread, docs, pairs, records in zip(*[runs_.column(c) for c in ("block", "spread", "docs", "pairs", "records")]):
                wanted, n = (np.concatenate(c) for c in zip(*blocks_of(pairs.as_py())))
                at = np.repeat(np.searchsorted(pair, wanted), n)
                held = pa.ipc.open_stream(records.as_py()).read_all()
                doc, links = held.column("doc").to_numpy(), held.column("links").to_numpy().astype(np.int64)
                sums, bests = np.zeros(docs.as_py(), np.int64), np.zeros(docs.as_py(), np.int64)
                np.add.at(sums, doc, links * count[at])
                np.add.at(bests, doc, links * best[at])
                name = block.as_py()
                out.append((spread.as_py() % groups, RUN, pack({"block": np.array([name]), "count_sum": pa.array([sums]), "n_best": pa.array([bests])})))
        trim()
        return pa.Table.from_batches([blob_batch(out)])

    return dealt.groupBy("radix", "salt").cogroup(everywhere.groupBy("radix", "salt")).applyInArrow(contribute, BLOB_SCHEMA)


def alignments(docs: DataFrame, first: str, second: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    made = staged(block_runs(docs, (first, second), id_column, text_column), "runs", partition_by=["kind"])
    runs = made.filter(F.col("kind") == RUN)
    blocks = made.filter(F.col("kind") == FACTS)
    groups = max(1, -(-blocks.count() // GROUP_BLOCKS))
    totals = pair_totals(runs)
    back = contributions(runs, totals, groups)
    facts = blocks.select((F.col("spread") % groups).cast("int").alias("bucket"), F.lit(FACTS).alias("kind"), "block", F.col("pairs").alias("blob"))
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = (f"{id_column} {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

    def add_up(table: pa.Table) -> pa.Table:
        sums: dict[int, list[np.ndarray]] = {}
        rows = list(zip(*[table.column(c).to_pylist() for c in ("kind", "block", "blob")]))
        for kind, _, blob in rows:
            if kind == RUN:
                held = pa.ipc.open_stream(blob).read_all()
                more = [held.column(c)[0].values.to_numpy() for c in ("n_best", "count_sum")]
                name = held.column("block")[0].as_py()
                sums[name] = more if name not in sums else [x + y for x, y in zip(sums[name], more)]
        out = []
        for kind, block, blob in rows:
            if kind == FACTS:
                held = pa.ipc.open_stream(blob).read_all()
                best, total = sums.get(block, [np.zeros(held.num_rows, np.int64)] * 2)
                out.append(pa.table({id_column: held.column("doc_id"), **{c: held.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")},
                                     "n_best": best, "count_sum": total, "groups_sha256": held.column("groups_sha256")}))
        trim()
        return pa.concat_tables(out)

    both = facts.unionByName(back.withColumn("block", F.lit(None).cast("long")))
    return both.groupBy("bucket").applyInArrow(add_up, schema)
