"""Exact n-gram Jaccard join with prefixes of adaptive length.

Documents are sets of word shingles. Sorted by one global order, rare shingles first, two sets that overlap in at least
three quarters of the larger one share a shingle in their first quarter. A prefix that is longer by k - 1 shingles shares
k of them, which fewer pairs do by chance. Each document takes the k with the least estimated cost: the entries that its
prefix reads, plus the candidates that are left, each of which has to be verified. A pair is a candidate if it shares as
many prefix shingles as the smaller k of the two asks for, and as many as sets of their sizes must share there.

1. Exact copies are merged first; one of them stands for all.
2. How common shingles are is counted over all documents in a sketch of fixed size. It only sets the global order and the
   cost estimates; results do not depend on it.
3. Prefixes are dealt by shingle. In each list all documents are paired with the first one only; candidates are verified
   on whole sets; links make components. A group of near copies collapses here at a cost in proportion to its size.
4. The same lists then give the pairs of different components only. They are counted and verified alike. So every pair
   that could link is verified, unless its documents are in one component already.

Defined results: words are what is between blanks (space, tab to carriage return) after lower-casing A-Z. A document
with fewer words than a shingle has them all as its one shingle. Null, empty and blank texts have none and link with
nothing. Rows are told apart as in ``ids.py``: repeated rows are documents of their own, linked as copies; of null or
repeated ids the component takes the smallest. Extra columns stay as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.bytes_np import LOWER, U, flat, window_hashes, word_hashes, word_spans
from lendframe.llm.components import components
from lendframe.llm.ids import keyed
from lendframe.llm.packed import BLOB_SCHEMA, bucket_count, bucket_of, by_bucket, column, deal, gathered, mix, map_batches, unpack, unpacked
from lendframe.llm.token_counts import parts
from lendframe.staging import discard, release, staged

#: The sketch has 2 ** SKETCH_BITS counters; prefixes grow by at most LONGEST - 1 shingles.
SKETCH_BITS, LONGEST, PART_BYTES = 20, 8, 4 << 20
TEXTS, COPIES, SKETCH, ENTRIES, LISTS, PAIRS, WANTED, LABELS, LINKS, TRIED = range(10)
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[9, 10, 11, 12, 13, 32]] = False

def shingles(texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts by text: text number, hash; and how many each text has."""
    data, offsets = flat(texts)
    data = LOWER[data]
    start, end, text = word_spans(data, offsets, WORD_BYTES)
    words = word_hashes(data, start, end)
    n_words = np.bincount(text, minlength=len(offsets) - 1)
    hashes = window_hashes(words, size)
    inside = text[size - 1:] == text[:len(hashes)]
    hashes, of = hashes[inside], text[:len(inside)][inside]
    first = np.cumsum(n_words) - n_words
    for n in range(1, size):
        few = np.flatnonzero(n_words == n)
        if len(few):
            own = window_hashes(words, n)[first[few]] ^ mix(np.array([n]))[0]
            hashes, of = np.append(hashes, own), np.append(of, few)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return of[new], hashes[new], np.bincount(of[new], minlength=len(offsets) - 1)


def least_shared(n: np.ndarray, k: np.ndarray, m: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles the prefixes of two sets of ``n`` and ``m`` shingles share at least, if the sets are similar.

    Of the whole overlap that similar sets of these sizes need, at most what lies behind one of the two prefixes can be
    missing in both. Sets of too different sizes get more than any prefix has.
    """
    n, m, k, j = (x.astype(np.int64) for x in (n, m, k, j))
    overlap = -(-percent * (n + m) // (100 + percent))
    behind = np.maximum(-(-percent * n // 100) - k, -(-percent * m // 100) - j)
    least = np.maximum(np.minimum(k, j), overlap - behind)
    return np.where(100 * np.minimum(n, m) >= percent * np.maximum(n, m), least, 1 << 30)


def _text_parts(table: pa.Table):
    sizes = pa.compute.binary_length(table.column("value")).to_pylist()
    for a, b in parts(sizes, PART_BYTES):
        yield table.slice(a, b - a).combine_chunks()


def _deal_texts(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents dealt by a digest of their text; of copies in one part only the first sends its text."""
    def run(batches):
        for table in gathered(batches, PART_BYTES):
            data, offsets = flat(table.column("value"))
            raw, cut = data.tobytes(), offsets.tolist()
            digest = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(cut, cut[1:])]
            key = np.frombuffer(b"".join(digest), U)[::2]
            uid = table.column("uid").to_numpy()
            met: dict[bytes, int] = {}
            for i in np.argsort(uid, kind="stable").tolist():
                met.setdefault(digest[i], i)
            repeat = np.ones(len(digest), bool)
            repeat[list(met.values())] = False
            value = pa.compute.if_else(pa.array(repeat), pa.scalar(None, pa.binary()), table.column("value").combine_chunks())
            yield from deal(bucket_of(key, buckets), {"uid": uid, "digest": pa.array(digest, pa.binary()), "value": value,
                                                      "row": table.column("row").combine_chunks()}, TEXTS)

    binary = F.encode(F.coalesce(F.col("value").cast("string"), F.lit("")), "utf-8")
    return docs.select("uid", binary.alias("value"), "row").transform(map_batches, run, BLOB_SCHEMA)


def _merge_copies(size: int, buckets: int):
    """One text for each digest, dealt by its own number; who its copies are; and what its shingles add to the sketch."""
    def run(kinds):
        t = kinds[TEXTS]
        uid = column(t, "uid")
        _, digest = np.unique(np.array(t.column("digest").to_pylist(), "S16"), return_inverse=True)
        order = np.lexsort((uid, digest))
        new = np.append(True, digest[order][1:] != digest[order][:-1])
        first = order[new]
        stands = uid[first][np.cumsum(new) - 1]
        # the text may have come with a copy from another part: any non-null one of the digest will do
        held = np.flatnonzero(t.column("value").is_valid().to_numpy())
        source = np.empty(len(first), np.int64)
        source[digest[held]] = held
        texts = pa.table({"uid": uid[first], "value": t.column("value").take(pa.array(source[digest[first]])).combine_chunks(),
                          "row": t.column("row").take(pa.array(first)).combine_chunks()})
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        counts = []
        for part in _text_parts(texts):
            _, hashes, n = shingles(part.column("value"), size)
            counts.append(n)
            sketch += np.bincount((hashes >> U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
            yield from deal(bucket_of(column(part, "uid"), buckets), {c: part.column(c).combine_chunks() for c in part.column_names}, TEXTS)
        n = np.concatenate(counts)[np.cumsum(new) - 1]
        yield from deal(bucket_of(uid[order], buckets), {"uid": uid[order], "stands": stands, "n": n}, COPIES)
        slot = np.flatnonzero(sketch)
        slices = (slot * buckets >> SKETCH_BITS).astype(np.int32)
        yield from deal(slices, {"slot": slot.astype(np.uint32), "n": sketch[slot].astype(np.uint32)}, SKETCH)
    return run


def _add_sketches(kinds):
    slot, n = column(kinds[SKETCH], "slot"), column(kinds[SKETCH], "n")
    slots, inverse = np.unique(slot, return_inverse=True)
    yield from deal(np.zeros(len(slots), np.int32), {"slot": slots, "n": np.bincount(inverse, n).astype(np.int64)}, SKETCH)


def _estimates(found: DataFrame) -> np.ndarray:
    """For each counter of the sketch how many documents its commonest shingle may have; 0 if within its noise."""
    counters = np.zeros(1 << SKETCH_BITS)
    for r in by_bucket(found.filter(F.col("kind") == SKETCH), _add_sketches, BLOB_SCHEMA).collect():
        t = unpack([bytes(r.blob)])
        counters[column(t, "slot")] = column(t, "n")
    usual = np.median(counters)
    above = counters - usual
    return np.where(above > 6 * np.sqrt(usual) + 8, above, 0).astype(np.float32)


def prefix_lengths(of: np.ndarray, common: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The k of each set and the length of its prefix; ``common`` holds the estimates in the global order."""
    need = -(-percent * n // 100)
    start = np.cumsum(n) - n
    total = np.append(0, np.cumsum(common + 1.0))
    best, cost = np.ones(len(n), np.int64), np.full(len(n), np.inf)
    for k in range(1, LONGEST + 1):
        length = np.minimum(n - need + k, n)
        read = total[start + length] - total[start]
        mine = np.where((k <= need) | (k == 1), read + n * np.maximum(read - length, 0) / k, np.inf)
        better = mine < cost
        best[better], cost[better] = k, mine[better]
    return best, np.where(n > 0, np.minimum(n - need + best, n), 0)


def _prefix_entries(texts: DataFrame, estimates: np.ndarray, size: int, percent: int, buckets: int) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(estimates)

    def run(batches):
        for table in unpacked(batches, PART_BYTES):
            for part in _text_parts(table):
                of, hashes, n = shingles(part.column("value"), size)
                common = sent.value[(hashes >> U(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.lexsort((hashes, common, of))
                of, hashes, common = of[order], hashes[order], common[order]
                k, length = prefix_lengths(of, common, n, percent)
                place = np.arange(len(of)) - (np.cumsum(n) - n)[of]
                taken = place < length[of]
                of, hashes = of[taken], hashes[taken]
                yield from deal(bucket_of(hashes, buckets), {
                    "shingle": hashes, "uid": column(part, "uid")[of], "size": n[of].astype(np.uint32), "k": k[of].astype(np.uint8)}, ENTRIES)

    return texts.transform(map_batches, run, BLOB_SCHEMA)


def _count_pairs(x, y, least, buckets: int):
    """Pairs met in one bucket, with how often and how often it takes, dealt by x."""
    order = np.lexsort((y, x))
    x, y, least = x[order], y[order], least[order]
    first = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))) if len(x) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(x)))
    return deal(bucket_of(x[first], buckets), {"x": x[first], "y": y[first], "least": least[first].astype(np.uint32), "times": times.astype(np.uint32)}, PAIRS)


def _sorted_lists(t: pa.Table, *more: str):
    names = ["shingle", "uid", "size", "k", *more]
    columns = {c: column(t, c) for c in names}
    order = np.lexsort((columns["uid"], columns["shingle"]))
    columns = {c: v[order] for c, v in columns.items()}
    new = np.append(True, columns["shingle"][1:] != columns["shingle"][:-1])
    return columns, new


def _pair_with_first(percent: int, buckets: int):
    """Lists of one shingle: every document with the list's first one; the lists with several documents, dealt by document."""
    def run(kinds):
        c, new = _sorted_lists(kinds[ENTRIES])
        number = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        several = np.bincount(number)[number] > 1
        hub = first[number]
        least = least_shared(c["size"], c["k"], c["size"][hub], c["k"][hub], percent)
        rows = several & ~new & (least < 1 << 30)
        yield from _count_pairs(c["uid"][rows], c["uid"][hub[rows]], least[rows], buckets)
        yield from deal(bucket_of(c["uid"][several], buckets), {n: v[several] for n, v in c.items()}, LISTS)
    return run


def _label(buckets: int):
    """List entries with the component of their document, dealt by shingle again."""
    def run(kinds):
        if LISTS not in kinds:
            return
        t = kinds[LISTS]
        uid = column(t, "uid")
        component = uid.copy()
        if LABELS in kinds:
            node, own = column(kinds[LABELS], "node"), column(kinds[LABELS], "component")
            order = np.argsort(node)
            node, own = node[order], own[order]
            at = np.minimum(np.searchsorted(node, uid), len(node) - 1)
            component = np.where(node[at] == uid, own[at], uid)
        shingle = column(t, "shingle")
        yield from deal(bucket_of(shingle, buckets), {"shingle": shingle, "uid": uid, "size": column(t, "size"), "k": column(t, "k"),
                                                      "component": component}, ENTRIES)
    return run


def _pair_components(percent: int, buckets: int, at_once: int = 2_000_000):
    """Pairs of documents of different components that share a shingle and are of similar size."""
    def run(kinds):
        c, new = _sorted_lists(kinds[ENTRIES], "component")
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(new)))
        mixed = np.maximum.reduceat(c["component"], start) != np.minimum.reduceat(c["component"], start)
        start, size = start[mixed], size[mixed]
        held, count = [], 0

        def out():
            x, y, least = (np.concatenate(p) for p in zip(*held))
            return _count_pairs(c["uid"][x], c["uid"][y], least, buckets)

        # the entry ``step`` places behind each one, for all lists that are long enough
        reach = np.repeat(start + size, size)
        row = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        step = 1
        while len(row):
            live = row + step < reach
            row, reach = row[live], reach[live]
            for a in range(0, len(row), at_once):
                y, x = row[a:a + at_once], row[a:a + at_once] + step
                least = least_shared(c["size"][x], c["k"][x], c["size"][y], c["k"][y], percent)
                ok = (c["component"][x] != c["component"][y]) & (least < 1 << 30)
                if ok.any():
                    held.append((x[ok], y[ok], least[ok]))
                    count += int(ok.sum())
                if count >= at_once:
                    yield from out()
                    held, count = [], 0
            step += 1
        if held:
            yield from out()
    return run


def _candidates(buckets: int):
    """Pairs that share as many prefix shingles as asked for and were not tried before; and whose texts that takes, where."""
    def run(kinds):
        if PAIRS not in kinds:
            return
        t = kinds[PAIRS]
        x, y, least, times = (column(t, c) for c in ("x", "y", "least", "times"))
        tried = np.zeros(len(x), bool)
        if TRIED in kinds:
            old = kinds[TRIED]
            x, y = np.append(x, column(old, "x")), np.append(y, column(old, "y"))
            least, times = (np.append(z, np.zeros(old.num_rows, z.dtype)) for z in (least, times))
            tried = np.append(tried, np.ones(old.num_rows, bool))
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
        enough = np.add.reduceat(times[order].astype(np.int64), first) >= np.maximum.reduceat(least[order], first)
        if len(tried):
            enough &= ~np.maximum.reduceat(tried[order], first)
        x, y = x[first][enough], y[first][enough]
        home = bucket_of(x, buckets)
        yield from deal(home, {"x": x, "y": y}, PAIRS)
        need = np.unique(np.stack([np.append(x, y), np.append(home, home).astype(np.int64)]), axis=1)
        yield from deal(bucket_of(need[0], buckets), {"uid": need[0], "to": need[1].astype(np.int32)}, WANTED)
    return run


def _send(kinds):
    """The wanted texts, to the buckets that want them."""
    if TEXTS not in kinds or WANTED not in kinds:
        return
    t, uid, to = kinds[TEXTS], column(kinds[WANTED], "uid"), column(kinds[WANTED], "to")
    own = column(t, "uid")
    order = np.argsort(own)
    at = order[np.searchsorted(own, uid, sorter=order)]
    value = t.column("value").combine_chunks()
    sizes = pa.compute.binary_length(value).to_numpy(zero_copy_only=False)[at].tolist()
    for a, b in parts(sizes, 4 * PART_BYTES):
        yield from deal(to[a:b], {"uid": uid[a:b], "value": value.take(pa.array(at[a:b]))}, TEXTS)


def _verify(size: int, percent: int, buckets: int):
    """Pairs whose whole sets are similar enough, and those that were tried in vain."""
    def run(kinds):
        if PAIRS not in kinds:
            return
        t = kinds[TEXTS]
        uid, sets, n = [], [], []
        for part in _text_parts(t):
            _, hashes, counts = shingles(part.column("value"), size)
            uid.append(column(part, "uid"))
            sets.append(hashes)
            n.append(counts)
        uid, sets, n = np.concatenate(uid), np.concatenate(sets), np.concatenate(n)
        start, order = np.cumsum(n) - n, np.argsort(uid)
        x, y = column(kinds[PAIRS], "x"), column(kinds[PAIRS], "y")
        i, j = (order[np.searchsorted(uid, z, sorter=order)] for z in (x, y))
        links = np.zeros(len(x), bool)
        close = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        for p in np.flatnonzero(close & (n[i] > 0) & (n[j] > 0)).tolist():
            a, b = sets[start[i[p]]:start[i[p]] + n[i[p]]], sets[start[j[p]]:start[j[p]] + n[j[p]]]
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            both = int((b[at] == a).sum())
            links[p] = 100 * both >= percent * (len(a) + len(b) - both)
        yield from deal(bucket_of(x[links], buckets), {"x": x[links], "y": y[links]}, LINKS)
        yield from deal(bucket_of(x[~links], buckets), {"x": x[~links], "y": y[~links]}, TRIED)
    return run


def _rows(blobs: DataFrame, columns: list[str]) -> DataFrame:
    """Blobs of whole numbers as plain rows."""
    def run(batches):
        for t in unpacked(batches):
            yield pa.record_batch([pa.array(column(t, c).astype(np.int64)) for c in columns], names=columns)

    return blobs.select("blob").transform(map_batches, run, ", ".join(f"{c} long" for c in columns))


def _blobs(rows: DataFrame, key: str, kind: int, buckets: int) -> DataFrame:
    def run(batches):
        for t in gathered(batches, 16 << 20):
            yield from deal(bucket_of(column(t, key), buckets), {c: column(t, c) for c in t.column_names}, kind)

    return rows.transform(map_batches, run, BLOB_SCHEMA)


class _Work:
    """What the rounds of one join share."""

    def __init__(self, docs: DataFrame, size: int, percent: int, id_column: str, text_column: str):
        self.size, self.percent = size, percent
        self.buckets = bucket_count(docs.sparkSession)
        self.rows = keyed(docs, id_column, text_column)
        merged = by_bucket(_deal_texts(self.rows, self.buckets), _merge_copies(size, self.buckets), BLOB_SCHEMA)
        self.found = self._kept(merged, "texts")
        self.texts = self._of(self.found, TEXTS)

    def _kept(self, blobs: DataFrame, name: str) -> DataFrame:
        back = staged(blobs, name, ["kind"])
        kept = back.select("bucket", F.col("kind").cast("int").alias("kind"), "blob")
        kept.staged_path = back.staged_path
        release(blobs.sparkSession)
        return kept

    @staticmethod
    def _of(blobs: DataFrame, kind: int) -> DataFrame:
        return blobs.filter(F.col("kind") == kind)

    def _links(self, pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
        every = pairs if tried is None else pairs.unionByName(tried)
        wanted = self._kept(by_bucket(every, _candidates(self.buckets), BLOB_SCHEMA), "candidates")
        sent = by_bucket(self.texts.unionByName(self._of(wanted, WANTED)), _send, BLOB_SCHEMA)
        checked = by_bucket(sent.unionByName(self._of(wanted, PAIRS)), _verify(self.size, self.percent, self.buckets), BLOB_SCHEMA)
        links = self._kept(checked, "links")
        discard(wanted)
        return links

    def joined(self) -> DataFrame:
        """``node`` and ``component`` of the texts that link with another text."""
        entries = _prefix_entries(self.texts, _estimates(self.found), self.size, self.percent, self.buckets)
        lists = self._kept(by_bucket(entries, _pair_with_first(self.percent, self.buckets), BLOB_SCHEMA), "lists")
        first = self._links(self._of(lists, PAIRS), None)
        found = components(_rows(self._of(first, LINKS), ["x", "y"]), "x", "y")
        nodes = staged(found, "components")
        discard(found)
        labels = _blobs(nodes, "node", LABELS, self.buckets)
        labelled = by_bucket(self._of(lists, LISTS).unionByName(labels), _label(self.buckets), BLOB_SCHEMA)
        rest = by_bucket(labelled, _pair_components(self.percent, self.buckets), BLOB_SCHEMA)
        second = self._links(rest, self._of(first, TRIED))
        discard(lists)
        links = nodes.select(F.col("node").alias("x"), F.col("component").alias("y")).unionByName(_rows(self._of(second, LINKS), ["x", "y"]))
        found = components(links, "x", "y")
        for written in (first, second, nodes):
            discard(written)
        return found


def report(docs: DataFrame, size: int = 5, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest id reachable by links, itself included)."""
    work = _Work(docs.select(F.col(id_column), F.col(text_column)), size, percent, id_column, text_column)
    copies = _rows(work._of(work.found, COPIES), ["uid", "stands", "n"])
    # texts without shingles are copies of each other by their bytes only, and link with nothing
    copies = copies.withColumn("stands", F.when(F.col("n") > 0, F.col("stands")).otherwise(F.col("uid")))
    labelled = copies.join(work.joined(), F.col("stands") == F.col("node"), "left").select(
        "uid", F.col("n").alias("n_shingles"), F.coalesce("component", "stands").alias("component"))
    names = work.rows.select("uid", "id")
    return labelled.join(names, "uid").join(
        names.select(F.col("uid").alias("component"), F.col("id").alias("component_id")), "component").select(
        F.col("id").alias(id_column), "n_shingles", "component_id")


def _drop(kinds):
    if TEXTS not in kinds:
        return
    t = kinds[TEXTS]
    if LABELS in kinds:
        t = t.filter(pa.array(~np.isin(column(t, "uid"), column(kinds[LABELS], "node")))).combine_chunks()
    for batch in t.select(["uid", "value", "row"]).to_batches():
        yield batch.drop_columns(["uid"])


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all columns, less those that link, directly or not, with one of smaller id.

    Texts without shingles link with nothing, so each stays, copies too.
    """
    work = _Work(docs, size, percent, id_column, text_column)
    others = work.joined().filter("node != component")
    row = work.rows.schema["row"].dataType.simpleString()
    kept = by_bucket(work.texts.unionByName(_blobs(others, "node", LABELS, work.buckets)), _drop, f"value binary, row {row}")
    columns = [F.col("value").cast("string").alias(c) if c == text_column else F.col("row")[c].alias(c) for c in docs.columns]
    kept = kept.select(*columns)
    blank = docs.filter(F.col(text_column).isNull() | (F.length(F.regexp_replace(F.col(text_column).cast("string"), "[ \\t-\\r]", "")) == 0))
    shingled = kept.filter(F.length(F.regexp_replace(F.col(text_column), "[ \\t-\\r]", "")) > 0)
    return shingled.unionByName(blank.withColumn(text_column, F.col(text_column).cast("string")))
