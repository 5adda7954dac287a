"""Benchmark decontamination with suffix arrays over shards of the training text.

Each task turns a shard of documents into a suffix array of words. Every suffix of every test item is looked up in it
by binary search; the documents' positions in the found range are verbatim matches, and matches that go on from one
word to the next are joined to the longest ones. Suffixes of training text that do not begin like any test suffix
cannot match and are left out of the array.

Test items are the stated query set. They are sent to the shards in blocks of at most ``BLOCK_BYTES`` of text, one pass
over the documents a block, so that what is broadcast has a fixed bound.

Defined results: words are runs of a-z (after lower-casing A-Z), 0-9 and non-ASCII characters. A window is
``window`` consecutive words of an item, or the whole item if it has fewer. Null or empty texts have no words; items
without words match nothing. Items are told apart by their id, as text (null: empty); repeated items count once.
Documents map one to one, so repeated rows and null or repeated ids are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.llm.bytes_np import LOWER, U, flat, window_hashes, word_hashes, word_spans
from lendframe.llm.lattice import Sorted
from lendframe.llm.packed import gathered, map_batches

BLOCK_BYTES, SHARD_BYTES = 8 << 20, 4 << 20
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True
MATCH = "array<struct<item_id:string,item_word:long,doc_word:long,n_words:long>>"


def _words(texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts one after the other, and n + 1 offsets."""
    data, offsets = flat(texts)
    data = LOWER[data]
    start, end, text = word_spans(data, offsets, WORD_BYTES)
    counts = np.bincount(text, minlength=len(offsets) - 1) if len(offsets) > 1 else np.zeros(0, np.int64)
    # 0 stands for the end of a text
    return np.maximum(word_hashes(data, start, end), U(1)), np.append(0, np.cumsum(counts))


def _suffixes(words: np.ndarray, at: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """The first ``depth`` words of each suffix, a row for each; 0 behind a text's end."""
    padded = np.append(words, np.zeros(depth, U))
    out = np.empty((len(at), depth), U)
    for j in range(depth):
        out[:, j] = np.where(at + j < end, padded[at + j], U(0))
    return out


class TestSuffixes:
    """Distinct windows of the test items, each at all of its places."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(ids)}
        self.ids = np.array(ids, object)
        words, offsets = _words(pa.array([t for _, t in items], pa.string()))
        sizes = np.diff(offsets)
        need = np.minimum(sizes, window)
        starts = [np.arange(a, a + n - w + 1) for a, n, w in zip(offsets[:-1].tolist(), sizes.tolist(), need.tolist()) if n]
        owner = np.repeat(np.arange(len(items)), np.where(sizes > 0, sizes - need + 1, 0))
        at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        rows = _suffixes(words, at, at + need[owner], window)
        self.rows, inverse = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
        self.need = (self.rows != 0).sum(axis=1)
        order = np.argsort(inverse.ravel(), kind="stable")
        self.place_start = np.searchsorted(inverse.ravel()[order], np.arange(len(self.rows) + 1))
        self.place_item = np.array([number[items[i][0]] for i in owner[order].tolist()], np.int64)
        self.place_word = (at - offsets[owner])[order]
        # how the suffixes of training text must begin
        self.head = int(min(3, self.need.min())) if len(self.rows) else 0
        if self.head:
            keys = np.unique(np.concatenate([window_hashes(r[:self.head], self.head) for r in self.rows]))
            self.heads = Sorted(keys, np.ones(len(keys), np.int8), bits=22)

    def search(self, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window the range of the sorted suffixes that begin with it."""
        edges = []
        for upper in (False, True):
            low, high = np.zeros(len(self.rows), np.int64), np.full(len(self.rows), len(suffixes))
            while (open_ := low < high).any():
                mid = (low + high) // 2
                seen = suffixes[np.minimum(mid, len(suffixes) - 1)]
                differs = (seen != self.rows) & (np.arange(self.window) < self.need[:, None])
                first = differs.argmax(axis=1)
                row = np.arange(len(self.rows))
                equal = ~differs.any(axis=1)
                right = np.where(equal, upper, seen[row, first] < self.rows[row, first])
                low, high = np.where(open_ & right, mid + 1, low), np.where(open_ & ~right, mid, high)
            edges.append(low)
        return edges[0], edges[1]

    def matches(self, texts) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Words of each text, and the longest verbatim matches by text."""
        words, offsets = _words(texts)
        none = {k: np.zeros(0, np.int64) for k in ("text", "item", "item_word", "doc_word", "n_words")}
        counts = np.diff(offsets)
        if not self.head or len(words) < self.head:
            return counts, none
        at = np.flatnonzero(self.heads.find(window_hashes(words, self.head), 0))
        end = offsets[np.searchsorted(offsets, at, side="right")]
        at, end = at[at + self.head <= end], end[at + self.head <= end]
        if not len(at):
            return counts, none
        suffixes = _suffixes(words, at, end, self.window)
        order = np.lexsort(suffixes.T[::-1])
        low, high = self.search(suffixes[order])
        found = np.flatnonzero(high > low)
        if not len(found):
            return counts, none
        size = (high - low)[found]
        rank = np.repeat(low[found] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        window, place = np.repeat(found, size), at[order][rank]
        # a window stands at one or more places of the items
        times = (self.place_start[window + 1] - self.place_start[window])
        where = np.repeat(self.place_start[window] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        place, window = np.repeat(place, times), np.repeat(window, times)
        item, item_word, need = self.place_item[where], self.place_word[where], self.need[window]
        # windows that follow each other in text and item make one match
        order = np.lexsort((place, place - item_word, item))
        place, item, item_word, need = place[order], item[order], item_word[order], need[order]
        text = np.searchsorted(offsets, place, side="right") - 1
        goes_on = (item[1:] == item[:-1]) & (place[1:] == place[:-1] + 1) & (item_word[1:] == item_word[:-1] + 1) & (text[1:] == text[:-1])
        first = np.flatnonzero(np.append(True, ~goes_on))
        last = np.append(first[1:], len(place)) - 1
        order = np.argsort(text[first], kind="stable")
        first, last = first[order], last[order]
        return counts, {"text": text[first], "item": item[first], "item_word": item_word[first],
                        "doc_word": place[first] - offsets[text[first]], "n_words": place[last] + need[last] - place[first]}


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> list[DataFrame]:
    items = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item_id"),
                             F.col(text_column).cast("string").alias("text")).filter("length(text) > 0").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i) for i in range(blocks)]


def _scan(docs: DataFrame, suffixes: TestSuffixes, text_column: str) -> DataFrame:
    """``row`` (the document), ``n_words`` and ``matches`` with one block of test items."""
    sent = docs.sparkSession.sparkContext.broadcast(suffixes)
    narrow = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = f"row {narrow.schema['row'].dataType.simpleString()}, n_words long, matches {MATCH}"

    def run(batches):
        own = sent.value
        for shard in gathered(batches, SHARD_BYTES):
            rows = shard.column("row").combine_chunks()
            n_words, m = own.matches(rows.field(text_column).cast(pa.string()))
            cuts = np.searchsorted(m["text"], np.arange(len(n_words) + 1))
            entries = pa.StructArray.from_arrays(
                [pa.array(own.ids[m["item"]], pa.string()), *(pa.array(m[k], pa.int64()) for k in ("item_word", "doc_word", "n_words"))],
                names=["item_id", "item_word", "doc_word", "n_words"])
            yield pa.record_batch([rows, pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), entries)],
                                  names=["row", "n_words", "matches"])

    return narrow.transform(map_batches, run, schema)


def _load(block: DataFrame, window: int) -> TestSuffixes:
    return TestSuffixes([(r.item_id, r.text) for r in block.collect()], window)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_column: str = "doc_id", text_column: str = "text",
            item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """Per document: id, n_words, and ``matches``, the longest runs of words that it shares with a test item."""
    blocks = _blocks(benchmark, item_column, item_text_column)
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    if len(blocks) == 1:
        return _scan(narrow, _load(blocks[0], window), "text").select(F.col("row.id").alias(id_column), "n_words", "matches")
    found = [_scan(narrow, _load(b, window), "text").select("row.id", F.sha2("row.text", 256).alias("digest"), "n_words", "matches")
             for b in blocks]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    joined = every.groupBy("id", "digest", "n_words").agg(
        F.array_distinct(F.flatten(F.collect_list("matches"))).alias("matches"), (F.count("*") / len(blocks)).cast("int").alias("copies"))
    return joined.select(F.col("id").alias(id_column), "n_words", "matches", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


def words_hit(found: Column) -> Column:
    """Words of a document that lie in any of its matches."""
    spans = F.array_sort(F.transform(found, lambda m: F.struct(m.doc_word.alias("a"), (m.doc_word + m.n_words).alias("b"))))
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, start, lambda s, x: F.struct(
        F.greatest(s.upto, x.b).alias("upto"), (s.n + F.greatest(F.lit(0), x.b - F.greatest(s.upto, x.a))).alias("n")), lambda s: s.n)


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_column: str = "doc_id") -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match."""
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m.item_id)))
    return matches(docs, benchmark, window, id_column).select(
        id_column, "n_words", words_hit(F.col("matches")).alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.size("matches") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.n_words)), F.lit(0)).cast("long").alias("longest_match"))


def remove_affected(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_column: str = "text") -> DataFrame:
    """The documents, all columns, that share no window with a test item."""
    for block in _blocks(benchmark, "item_id", "text"):
        docs = _scan(docs, _load(block, window), text_column).filter(F.size("matches") == 0).select("row.*")
    return docs
