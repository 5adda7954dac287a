"""Removing repeated byte strings by difference-cover suffix sorting, spread by content.

Every string of ``length`` bytes holds a minimum among the hashes of its ``ANCHOR``-byte pieces. That minimum depends on
nothing but the string, so equal strings meet in the bucket of their minimum, and each bucket can be sorted alone.
Neighbouring strings share their minimum: a run of them is one record, with the bytes they span as its context.

1. Runs are dealt by their minimum. A minimum met once has nothing to compare with. Runs of the same minimum and
   context are wholly equal: all but the earliest are repeats, whatever their number.
2. One run of each context of the other minima has its bytes fetched from the texts. In each bucket the suffixes of
   those bytes are sorted by difference cover (names of sampled triples, recursion on the names, merge of the rest),
   and neighbours in that order are compared over ``length`` bytes. Of equal strings the earliest stays.
3. The spans of each document are joined, and the text is cut.

Records travel in compressed blobs (``packed.py``), so no single string is a row of its own. A copy group of any size
costs as many records as it has bytes, spread over the buckets of its many minima.

Defined results: null text counts as empty. Earlier means a smaller id, nulls first; rows of equal id are ordered by
text, and repeated rows are documents of their own, so later ones lose what repeats. Texts shorter than ``length``
lose nothing. Other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.bytes_np import U, flat, sliding_min
from lendframe.llm.ids import keyed
from lendframe.llm.packed import BLOB_SCHEMA, bucket_count, bucket_of, by_bucket, column, deal, gathered, map_batches, mix
from lendframe.llm.token_counts import parts
from lendframe.staging import release, staged

ANCHOR, PART_BYTES, SORT_BYTES, DEAL_BYTES = 40, 1 << 20, 1 << 20, 8 << 20
TEXTS, SPANS, WANTED, RUNS = range(4)
_B = 0x9E3779B97F4A7C15
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD6E8FEB86659FD93)) | U(1)
_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, kept for the longest buffer so far."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_B, pow(_B, -1, 1 << 64))):
            out, size = np.ones(1, U), 1
            while size < n:
                out = np.concatenate([out, out * U(pow(base, size, 1 << 64))])
                size *= 2
            _powers[k] = out
    return _powers


def runs(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of neighbouring strings with one minimum: text number, start, size, minimum, hash of the context, and
    whether the run may hold equal strings itself."""
    n, window = len(data), length - ANCHOR + 1
    last = offsets[1:] - length
    whole = np.flatnonzero(last >= offsets[:-1])
    empty = np.zeros(0, np.int64)
    if not len(whole):
        return {"text": empty, "start": empty, "size": empty, "key": empty.astype(U), "context": empty.astype(U), "inner": empty.astype(bool)}
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(_VALUE[data] * up[:n], out=total[1:])
    pieces = (total[ANCHOR:] - total[:-ANCHOR]) * down[:n - ANCHOR + 1]
    pieces ^= pieces >> U(32)
    pieces *= U(0xBF58476D1CE4E5B9)
    # the low bits tell positions apart, so each minimum belongs to one place
    at = np.arange(len(pieces), dtype=np.uint64)
    marked = (pieces & ~U(255)) | (at & U(255))
    least = sliding_min(marked, window)
    valid = np.zeros(len(least) + 1, np.int8)
    np.add.at(valid, offsets[whole], 1)
    np.add.at(valid, last[whole] + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8).astype(bool)
    begins = valid.copy()
    begins[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    begins[offsets[whole]] = True
    ends = valid.copy()
    ends[:-1] &= (least[1:] != least[:-1]) | ~valid[1:]
    ends[last[whole]] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    value = least[start]
    place = start + ((value - start.astype(U)) & U(255)).astype(np.int64)
    own = pieces[place]
    inner = np.zeros(len(start), bool)
    padded = np.append(pieces, np.zeros(window, U))
    for step in range(1, window):
        inner |= padded[place + step] == own
    context = (total[end + length - 1] - total[start]) * down[start]
    text = np.searchsorted(offsets, start, side="right") - 1
    return {"text": text, "start": start - offsets[text], "size": end - start, "key": value >> U(8),
            "context": mix(context + (end - start).astype(U)), "inner": inner}


def suffix_order(t: np.ndarray) -> np.ndarray:
    """Suffixes of ``t`` (whole numbers from 1) in ascending order, by difference cover modulo 3."""
    n = len(t)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    t = np.append(t.astype(np.int64), [0, 0, 0, 0])
    top = int(t.max()) + 1
    first = np.arange(1, n + (n % 3 == 1), 3)
    sample = np.concatenate([first, np.arange(2, n, 3)])
    # names of the sampled triples, by their order
    pair = t[sample] * top + t[sample + 1]
    if top ** 3 >= 1 << 62:
        pair = np.unique(pair, return_inverse=True)[1]
    triple = pair * top + t[sample + 2]
    order = np.argsort(triple)
    dealt = triple[order]
    name = np.empty(len(sample), np.int64)
    name[order] = np.cumsum(np.append(1, dealt[1:] != dealt[:-1]))
    if int(name.max()) < len(sample):
        order = suffix_order(name)
        name[order] = np.arange(1, len(sample) + 1)
    sampled = sample[order]
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = name
    # the others by their first element and the rank behind it
    base = len(sample) + 2
    rest = np.arange(0, n, 3)
    key = t[rest] * base + rank[rest + 1]
    order = np.argsort(key)
    rest, key = rest[order], key[order]
    # merge: how many sampled suffixes of either residue come before each of the others
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(t[ones] * base + rank[ones + 1], key)
    two, other = t[twos] * top + t[twos + 1], t[rest] * top + t[rest + 1]
    if top * top * base >= 1 << 62:
        both = np.unique(np.concatenate([two, other]), return_inverse=True)[1]
        two, other = both[:len(two)], both[len(two):]
    before += np.searchsorted(two * base + rank[twos + 2], other * base + rank[rest + 2])
    out = np.empty(len(sampled) + len(rest), np.int64)
    slots = np.arange(len(rest)) + before
    free = np.ones(len(out), bool)
    free[slots] = False
    out[slots], out[free] = rest, sampled
    return out[out < n]


def repeats(data: np.ndarray, offsets: np.ndarray, size: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int):
    """Strings that also start earlier, as (document, first byte, end) of the bytes they cover.

    Context i holds ``size[i]`` strings, which start at byte ``start[i]`` of document ``doc[i]`` and behind it.
    """
    order = suffix_order(data.astype(np.int64) + 1)
    context = np.repeat(np.arange(len(size)), size)
    at = np.repeat(offsets[:-1] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    owner = np.full(len(data), -1, np.int64)
    owner[at] = context
    order = order[owner[order] >= 0]
    eights = np.ndarray(len(data) + 1, U, np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    same = np.arange(len(order) - 1)
    for step in [*range(0, length - 8, 8), length - 8]:
        same = same[eights[order[same] + step] == eights[order[same + 1] + step]]
    group = np.ones(len(order), np.int64)
    group[same + 1] = 0
    group = np.cumsum(group)
    of = owner[order]
    place = start[of] + order - offsets[of]
    rows = np.lexsort((place, doc[of], group))
    later = rows[1:][group[rows[1:]] == group[rows[:-1]]]
    return joined(doc[of[later]], place[later], place[later] + length)


def joined(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Overlapping and touching spans of a document made one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    new_doc = np.append(True, doc[1:] != doc[:-1])
    # each document on a stretch of its own, so that one running maximum serves all
    stretch = (np.cumsum(new_doc) - 1) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + stretch)
    first = np.flatnonzero(np.append(True, start[1:] + stretch[1:] > reach[:-1]))
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - stretch[last]


def _text_blobs(docs: DataFrame, buckets: int) -> DataFrame:
    """All documents dealt by ``uid``."""
    def run(batches):
        for t in gathered(batches, DEAL_BYTES):
            yield from deal(bucket_of(column(t, "uid"), buckets), {c: t.column(c).combine_chunks() for c in t.column_names}, TEXTS)

    return docs.select("uid", F.encode(F.coalesce(F.col("value").cast("string"), F.lit("")), "utf-8").alias("value"), "row").transform(map_batches, run, BLOB_SCHEMA)


def _run_blobs(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("value")).fill_null(0).to_pylist()
            for a, b in parts(sizes, PART_BYTES):
                data, offsets = flat(batch.column("value").slice(a, b - a))
                r = runs(data, offsets, length)
                r["doc"] = batch.column("uid").to_numpy()[a:b][r.pop("text")]
                r["start"], r["size"] = r["start"].astype(np.uint32), r["size"].astype(np.uint8)
                yield from deal(bucket_of(r["key"], buckets), r, RUNS)

    return docs.select("uid", F.col("value").cast("string").alias("value")).transform(map_batches, run, BLOB_SCHEMA)


def _span_blobs(spans, buckets: int):
    doc, start, end = spans
    return deal(bucket_of(doc, buckets), {"doc": doc, "start": start.astype(np.uint32), "end": end.astype(np.uint32)}, SPANS)


def _compare_runs(length: int, buckets: int):
    """Runs of a bucket to spans that are repeats for certain, and runs whose bytes are wanted."""
    def run(kinds):
        t = kinds[RUNS]
        key, context, doc, start, size, inner = (column(t, c) for c in ("key", "context", "doc", "start", "size", "inner"))
        order = np.lexsort((start, doc, context, key))
        key, context, doc, start, size, inner = (x[order] for x in (key, context, doc, start.astype(np.int64), size.astype(np.int64), inner))
        new_key = np.append(True, key[1:] != key[:-1])
        new_class = new_key | np.append(True, context[1:] != context[:-1])
        later = ~new_class
        yield from _span_blobs(joined(doc[later], start[later], (start + size - 1 + length)[later]), buckets)
        classes = np.add.reduceat(new_class, np.flatnonzero(new_key), dtype=np.int64)[np.cumsum(new_key) - 1]
        wanted = new_class & ((classes > 1) | inner)
        yield from deal(bucket_of(doc[wanted], buckets), {"doc": doc[wanted], "start": start[wanted].astype(np.uint32),
                                                          "size": size[wanted].astype(np.uint8), "key": key[wanted]}, WANTED)
    return run


def _fetch(length: int, buckets: int):
    """The bytes of the wanted runs of a bucket's documents, dealt by their minimum."""
    def run(kinds):
        if TEXTS not in kinds or WANTED not in kinds:
            return
        uid = column(kinds[TEXTS], "uid")
        data, offsets = flat(kinds[TEXTS].column("value"))
        doc, start, size, key = (column(kinds[WANTED], c) for c in ("doc", "start", "size", "key"))
        order = np.argsort(uid)
        base = offsets[order[np.searchsorted(uid, doc, sorter=order)]] + start
        span = size.astype(np.int64) + length - 1
        ends = np.cumsum(span)
        raw = data[np.repeat(base - (ends - span), span) + np.arange(int(span.sum()))]
        held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(raw)])
        yield from deal(bucket_of(key, buckets), {"doc": doc, "start": start, "size": size, "key": key, "bytes": held}, RUNS)
    return run


def _sort_contexts(length: int, buckets: int):
    """Contexts of one minimum are sorted together, those of several minima as far as they are few."""
    def run(kinds):
        t = kinds[RUNS]
        order = np.argsort(column(t, "key"), kind="stable")
        key, size = column(t, "key")[order], column(t, "size").astype(np.int64)[order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        bytes_ = np.add.reduceat(size + length - 1, new).tolist()
        for a, b in parts(bytes_, SORT_BYTES):
            rows = order[new[a]:new[b] if b < len(new) else len(order)]
            part = t.take(pa.array(rows)).combine_chunks()
            data, offsets = flat(part.column("bytes"))
            doc, start = column(part, "doc"), column(part, "start").astype(np.int64)
            yield from _span_blobs(repeats(data, offsets, column(part, "size").astype(np.int64), doc, start, length), buckets)
    return run


def _cut(as_text: bool):
    """Texts of a bucket without their spans: digests, or the texts themselves."""
    def run(kinds):
        if TEXTS not in kinds:
            return
        t = kinds[TEXTS]
        uid = column(t, "uid")
        order = np.argsort(uid)
        of = begin = end = np.zeros(0, np.int64)
        if SPANS in kinds:
            doc, begin, end = joined(*(column(kinds[SPANS], c).astype(np.int64) for c in ("doc", "start", "end")))
            of = order[np.searchsorted(uid, doc, sorter=order)]
            rows = np.argsort(of, kind="stable")
            of, begin, end = of[rows], begin[rows], end[rows]
        for a, b in parts(pa.compute.binary_length(t.column("value")).to_pylist(), PART_BYTES):
            data, offsets = flat(t.column("value").slice(a, b - a))
            own = slice(np.searchsorted(of, a), np.searchsorted(of, b))
            n_spans = np.bincount(of[own] - a, minlength=b - a)
            cut = np.zeros(len(data) + 1, np.int8)
            # spans of a text neither meet nor touch; those of neighbouring texts may touch, and cancel out
            np.add.at(cut, offsets[of[own] - a] + begin[own], 1)
            np.add.at(cut, offsets[of[own] - a] + end[own], -1)
            gone = np.cumsum(cut[:-1], dtype=np.int8) > 0
            lost = np.append(0, np.cumsum(gone, dtype=np.int64))[offsets]
            kept = data[~gone].tobytes()
            ends = (offsets - lost).tolist()
            texts = [kept[x:y] for x, y in zip(ends, ends[1:])]
            held = [x.decode("utf-8", "ignore") for x in texts] if as_text else [hashlib.sha256(x).hexdigest() for x in texts]
            yield pa.record_batch([t.column("row").slice(a, b - a).combine_chunks(), pa.array(np.diff(offsets), pa.int64()),
                                   pa.array(np.diff(lost), pa.int64()), pa.array(n_spans, pa.int64()), pa.array(held, pa.string())],
                                  names=["row", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def _deduplicated(docs: DataFrame, length: int, id_column: str, text_column: str, as_text: bool) -> DataFrame:
    if length < ANCHOR + 8:
        raise ValueError(f"length must be at least {ANCHOR + 8}")
    buckets = bucket_count(docs.sparkSession)
    rows = keyed(docs, id_column, text_column)
    found = staged(by_bucket(_run_blobs(rows, length, buckets), _compare_runs(length, buckets), BLOB_SCHEMA), "runs", ["kind"])
    found = found.select("bucket", F.col("kind").cast("int").alias("kind"), "blob")
    # every string's record was shuffled for them
    release(docs.sparkSession)
    texts = _text_blobs(rows, buckets)
    contexts = by_bucket(texts.unionByName(found.filter(F.col("kind") == WANTED)), _fetch(length, buckets), BLOB_SCHEMA)
    spans = by_bucket(contexts, _sort_contexts(length, buckets), BLOB_SCHEMA)
    kind = rows.schema["row"].dataType.simpleString()
    return by_bucket(texts.unionByName(found.filter(F.col("kind") == SPANS)).unionByName(spans), _cut(as_text),
                     f"row {kind}, n_bytes long, n_removed long, n_spans long, kept string")


def report(docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    narrow = docs.select(F.col(id_column), F.col(text_column))
    return _deduplicated(narrow, length, id_column, text_column, False).select(
        F.col("row")[id_column].alias(id_column), "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))


def without_repeats(docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all columns in order, with repeated strings cut from their texts.

    A cut through a character of several bytes takes what is left of the character too.
    """
    cut = _deduplicated(docs, length, id_column, text_column, True)
    return cut.select(*[F.col("kept").alias(c) if c == text_column else F.col("row")[c].alias(c) for c in docs.columns])
