"""Frequent phrases and their collocation scores by dynamic itemset counting over cyclic shard scans.

Documents are dealt to shards once, as blocks of numbered words. A scan reads one shard, the next scan the next one, around and around. Words are
counted from the first scan on. A longer phrase is activated at the end of the scan after which both its subphrases (without
its last word, without its first) have reached the threshold, and is counted over the following scans until it has seen
each shard once: one full cycle, whatever shard it began with. So lengths are counted side by side, and the scans end
when no phrase is left that has not completed its cycle.

Which subphrases have reached the threshold, and since which scan, stands in a table of a fixed number of slots per
phrase length, by hash. Phrases that share a slot are activated together, at the earlier time, but none before its subphrases
are active themselves: that counts a phrase too many, never one too few, and each one counted completes its own cycle, so all
counts are exact. The slots pass the
driver as bitmaps of a fixed size. Phrases themselves are told apart by their texts. They are counted in each batch first, then
dealt in packed form to buckets, each a range of slots, where they meet the counts of earlier scans.

Words and pieces are those of the contract: A-Z lowered, pieces end at ``. , ; : ! ?`` and at bytes 0x0A to 0x0D, words are
runs of other bytes but blank and tab. Everything is per language.

Defined results: null text has no words, null language is ``und``; repeated rows and ids count as documents of their
own; an empty table has no phrases; ties go as the ranking says. Other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.bytes_np import LOWER, ODD, U, flat, word_hashes, word_spans
from lendframe.llm.packed import BLOB_SCHEMA, blob_batch, bucket_count, by_bucket, column, deal, gathered, map_batches, pack, unpack, unpacked
from lendframe.staging import discard, staged

#: Shards of one cycle, slots of a phrase length (as a power of two), bytes of text that become one block of each shard, bytes of text for a bucket.
SHARDS, SLOT_BITS, TEXT_BYTES, BUCKET_BYTES = 4, 24, 32 << 20, 256 << 20
#: Parts of each language's ranking.
RANK_PARTS = 64
#: Kinds of packed rows: counts that are not complete, complete ones at or above the threshold, words of a language, slots reached.
OPEN, DONE, TOTAL, REACHED = range(4)

ENDS = np.zeros(256, bool)
ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
WORD = ~ENDS
WORD[[0x20, 0x09]] = False


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(31))) * ODD
    return h ^ (h >> U(29))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of the keys in order of appearance, and the place of each number's first key."""
    found = pa.array(keys).dictionary_encode()
    numbers = found.indices.to_numpy()
    first = np.zeros(len(found.dictionary), np.int64)
    first[numbers[::-1]] = np.arange(len(numbers))[::-1]
    return numbers.astype(np.int64), first


@dataclass
class Block:
    """Words of some texts by number, whether the next word follows in its piece, and per number its language, text and hash."""

    units: np.ndarray
    follows: np.ndarray
    lang: pa.Array
    text: pa.Array
    hash: np.ndarray

    def packed(self) -> dict[str, bytes]:
        return {"units": pack({"unit": self.units.astype(np.int32), "follows": pa.array(self.follows)}),
                "names": pack({"lang": self.lang, "text": self.text, "hash": self.hash})}

    @classmethod
    def of(cls, units: bytes, names: bytes) -> Block:
        u, n = unpack([units]), unpack([names])
        return cls(column(u, "unit").astype(np.int64), u.column("follows").to_numpy(), n.column("lang").combine_chunks(), n.column("text").combine_chunks(), column(n, "hash"))


def words_of(texts: pa.Array, langs: pa.Array) -> Block:
    data, offsets = flat(texts)
    data = LOWER[data]
    start, end, doc = word_spans(data, offsets, WORD)
    ended = np.searchsorted(np.flatnonzero(ENDS[data]), start)
    follows = np.append((ended[1:] == ended[:-1]) & (doc[1:] == doc[:-1]), False)[:len(start)]
    bounds = np.append(0, np.cumsum(end - start)).astype(np.int64)
    inside = WORD[data]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
    found = found.dictionary_encode()
    codes, texts_ = found.indices.to_numpy().astype(np.int64), found.dictionary
    lang = langs.dictionary_encode()
    lang_of = lang.indices.to_numpy().astype(np.int64)[doc]
    units, first = _distinct(lang_of * max(1, len(texts_)) + codes)
    letters, at = flat(texts_)
    text_hash = word_hashes(letters, at[:-1], at[1:])
    names, at = flat(lang.dictionary.cast(pa.binary()))
    lang_hash = word_hashes(names, at[:-1], at[1:])
    hashes = _mix(text_hash[codes[first]] ^ _mix(lang_hash[lang_of[first]] + ODD))
    return Block(units, follows, lang.dictionary.take(pa.array(lang_of[first])), texts_.take(pa.array(codes[first])), hashes)


def shard_counts(block: Block, scan: int, shards: int, most_words: int, steps: list[np.ndarray]):
    """Counts of the phrases that are active in this scan, one dictionary of columns for each length.

    ``steps[k - 1]`` holds for each slot the scan at whose end a phrase of k words there reached the threshold, or 0.
    ``tag`` is slot, first scan and length of a phrase in one number.
    """
    units, follows, unit_text, unit_hash = block.units, block.follows, block.text, block.hash
    if not len(units):
        return
    bits = U(64 - (len(steps[0]) - 1).bit_length())

    def made(words, firsts, slots, since, counts):
        """Columns of distinct phrases, by the place of a first word of each."""
        joined = [unit_text.take(pa.array(units[firsts + k])) for k in range(words)]
        phrase = pa.compute.binary_join_element_wise(*joined, pa.scalar(b" ", pa.large_binary())) if words > 1 else joined[0]
        return {"lang": block.lang.take(pa.array(units[firsts])), "phrase": phrase.cast(pa.string()),
                "tag": (slots << 16) | (since << 8) | words, "n": counts.astype(np.int64)}

    place = np.arange(len(units))  # first words of the phrases of this length
    number = units  # distinct number of each of them
    begun = np.zeros(len(unit_hash), np.int64)  # scan since which each number is found here
    first = np.zeros(len(unit_hash), np.int64)
    first[units[::-1]] = place[::-1]
    hashes = unit_hash
    slots = (hashes >> bits).astype(np.int64)
    if scan <= shards:
        yield made(1, first, slots, np.zeros(len(first), np.int64), np.bincount(units, minlength=len(first)))
    for words in range(2, most_words + 1):
        reached = steps[words - 2][slots][number]
        # a phrase one word longer: its two subphrases begin at neighbouring words
        next_to = np.flatnonzero(place[1:] == place[:-1] + 1)
        whole = next_to[follows[place[next_to] + words - 2] & (reached[next_to] > 0) & (reached[next_to + 1] > 0)]
        if not len(whole):
            return
        # a slot that others share may have been reached before a subphrase was found at all
        since = np.maximum(np.maximum(reached[whole], reached[whole + 1]), np.maximum(begun[number[whole]], begun[number[whole + 1]])).astype(np.int64)
        last_word = units[place[whole] + words - 1]
        longer, first_of = _distinct((number[whole] << 32) | last_word)
        hashes = _mix(hashes[number[whole[first_of]]] * U(0xD6E8FEB86659FD93) ^ unit_hash[last_word[first_of]])
        place, number, since = place[whole], longer, since[first_of]
        begun = since
        slots = (hashes >> bits).astype(np.int64)
        active = np.flatnonzero((since < scan) & (scan <= since + shards))
        if len(active):
            yield made(words, place[first_of[active]], slots[active], since[active], np.bincount(number, minlength=len(first_of))[active])


_unpacked: list = [None, None]


def _steps_of(shared) -> list[np.ndarray]:
    """Slot tables of a broadcast, unpacked once a worker."""
    if _unpacked[0] != shared.value[0]:
        _unpacked[:] = [shared.value[0], [np.frombuffer(zlib.decompress(x), np.uint8) for x in shared.value[1]]]
    return _unpacked[1]


def _bucket(slots: np.ndarray, slot_bits: int, buckets: int) -> np.ndarray:
    """Buckets are ranges of slots."""
    return ((slots * buckets) >> slot_bits).astype(np.int32)


def phrase_counts(docs: DataFrame, least: int = 30, most_words: int = 4, shards: int = SHARDS, slot_bits: int = SLOT_BITS,
                  lang_column: str = "lang", text_column: str = "text", id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(``lang``, ``phrase``, ``words``, ``n``) of all phrases that occur ``least`` times, and (``lang``, ``total``) words of each language."""
    spark = docs.sparkSession
    dealt = staged(_blocks(docs, shards, lang_column, text_column, id_column), "shards", partition_by=["shard"])
    size = dealt.agg(F.sum("bytes")).first()[0] or 0
    buckets = min(1 << slot_bits, max(bucket_count(spark), -(-size // BUCKET_BYTES)))
    steps = [np.zeros(1 << slot_bits, np.uint8) for _ in range(most_words - 1)]
    scans: list[DataFrame] = []
    scan = last_activation = 0
    while scan < last_activation + shards:
        scan += 1
        shared = spark.sparkContext.broadcast((f"{dealt.staged_path}:{scan}", [zlib.compress(s.tobytes(), 1) for s in steps]))

        def count(batches, scan=scan, shared=shared):
            for batch in batches:
                for units, names in zip(batch.column("units"), batch.column("names")):
                    for made in shard_counts(Block.of(units.as_py(), names.as_py()), scan, shards, most_words, _steps_of(shared)):
                        yield from deal(_bucket(made["tag"] >> 16, slot_bits, buckets), made, OPEN)

        shard = dealt.filter(F.col("shard") == (scan - 1) % shards).select("units", "names")
        rows = shard.transform(map_batches, count, BLOB_SCHEMA)
        if scans:
            rows = rows.unionByName(scans[-1].filter(F.col("kind") == OPEN).select("bucket", "kind", "blob"))
        now = staged(by_bucket(rows, _add_up(scan, least, shards, slot_bits, buckets, most_words), BLOB_SCHEMA), f"scan{scan}", partition_by=["kind"])
        shared.destroy()
        scans.append(now)
        if _activate(now, steps, scan, slot_bits, buckets):
            last_activation = scan
    discard(dealt)
    packed = reduce(DataFrame.unionByName, [s.filter(F.col("kind").isin(DONE, TOTAL)).select("kind", "blob") for s in scans[shards - 1:]])
    schema = "lang string, phrase string, words int, n long"

    def rows_of(kind):
        def run(batches):
            for table in unpacked(batches):
                words = pa.array((column(table, "tag") & 255).astype(np.int32))
                yield from pa.table([table.column("lang"), table.column("phrase"), words, table.column("n")], names=["lang", "phrase", "words", "n"]).to_batches()

        return packed.filter(F.col("kind") == kind).select("blob").mapInArrow(run, schema)

    return rows_of(DONE), rows_of(TOTAL).groupBy("lang").agg(F.sum("n").alias("total"))


def _blocks(docs: DataFrame, shards: int, lang_column: str, text_column: str, id_column: str) -> DataFrame:
    """Numbered words of the documents, some blocks for each shard."""
    spread = F.pmod(F.xxhash64(F.col(id_column).cast("string"), text_column), F.lit(shards)).cast("int")
    narrow = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
                         F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"), spread.alias("shard"))
    schema = pa.schema([("shard", pa.int32()), ("bytes", pa.int64()), ("units", pa.binary()), ("names", pa.binary())])

    def number(batches):
        for rows in gathered(batches, TEXT_BYTES):
            shard = rows.column("shard").to_numpy()
            for k in range(shards):
                own = rows.filter(pa.array(shard == k)).combine_chunks()
                if own.num_rows:
                    text = own.column("text").combine_chunks()
                    block = words_of(text, own.column("lang").combine_chunks())
                    yield pa.RecordBatch.from_pylist([{"shard": k, "bytes": text.nbytes, **block.packed()}], schema=schema)

    return narrow.transform(map_batches, number, "shard int, bytes long, units binary, names binary")


def _add_up(scan: int, least: int, shards: int, slot_bits: int, buckets: int, most_words: int):
    """Sums of one bucket: what is complete leaves, what is not goes on, and slots that have reached the threshold are noted."""
    def add_up(kinds):
        table = kinds[OPEN].group_by(["lang", "phrase"]).aggregate([("n", "sum"), ("tag", "min")]).combine_chunks()
        if not table.num_rows:
            return
        table = table.rename_columns([{"n_sum": "n", "tag_min": "tag"}.get(c, c) for c in table.column_names])
        tag, n = column(table, "tag"), column(table, "n")
        words, since, slot = tag & 255, (tag >> 8) & 255, tag >> 16
        bucket = int(_bucket(slot[:1], slot_bits, buckets)[0])
        complete, enough = since + shards == scan, n >= least
        out = []

        def put(kind, rows):
            out.append((bucket, kind, pack({c: rows.column(c).combine_chunks() for c in ("lang", "phrase", "tag", "n")})))

        if not complete.all():
            put(OPEN, table.filter(pa.array(~complete)))
        if scan >= shards:
            put(DONE, table.filter(pa.array(complete & enough)))
        if scan == shards:
            of_lang = table.filter(pa.array(words == 1)).group_by("lang").aggregate([("n", "sum")])
            empty = pa.array([""] * of_lang.num_rows, pa.string())
            put(TOTAL, pa.table({"lang": of_lang.column("lang"), "phrase": empty, "tag": np.zeros(of_lang.num_rows, np.int64), "n": of_lang.column("n_sum")}))
        # bitmaps of the bucket's own slots, one for each length
        start, stop = _slot_range(bucket, slot_bits, buckets)
        bitmaps = np.zeros((most_words - 1, stop - start), bool)
        hit = enough & (words < most_words)
        bitmaps[words[hit] - 1, slot[hit] - start] = True
        out.append((bucket, REACHED, zlib.compress(np.packbits(bitmaps, axis=1).tobytes(), 1)))
        yield blob_batch(out)

    return add_up


def _slot_range(bucket: int, slot_bits: int, buckets: int) -> tuple[int, int]:
    return -(-(bucket << slot_bits) // buckets), -(-((bucket + 1) << slot_bits) // buckets)


def _activate(now: DataFrame, steps: list[np.ndarray], scan: int, slot_bits: int, buckets: int) -> bool:
    """Note the slots that have reached the threshold; whether any is new. What comes here is one bit a slot, whatever the input."""
    fresh = False
    for r in now.filter(F.col("kind") == REACHED).select("bucket", "blob").collect():
        start, stop = _slot_range(r.bucket, slot_bits, buckets)
        bits = np.frombuffer(zlib.decompress(bytes(r.blob)), np.uint8).reshape(len(steps), -1)
        for table, row in zip(steps, np.unpackbits(bits, axis=1)[:, :stop - start]):
            new = start + np.flatnonzero(row)
            new = new[table[new] == 0]
            table[new] = scan
            fresh |= len(new) > 0
    return fresh


def _texts_of(words: Column, start, size) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, least: int = 30, most_words: int = 4, cover_percent: int = 80, most: int = 2000, **columns) -> DataFrame:
    """The first ``most`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = phrase_counts(docs, least, most_words, **columns)
    return ranked(scored(counts, most_words, cover_percent), totals, most)


def scored(counts: DataFrame, most_words: int = 4, cover_percent: int = 80) -> DataFrame:
    """Candidates that no longer phrase stands for, with their lowest-scoring cut: lang, phrase, a, l, r, score."""
    split = F.split("phrase", " ")
    phrases = counts.filter("words >= 2").select("lang", "phrase", F.col("n").alias("a"), "words", split.alias("_w"))
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), _texts_of(F.col("_w"), F.lit(1), k).alias("left"), _texts_of(F.col("_w"), k + 1, F.col("words") - k).alias("right")))
    each = phrases.select("lang", "phrase", "a", F.inline(cuts))
    known = counts.select("lang", F.col("phrase").alias("_part"), F.col("n").alias("_n"))
    for side, name in (("left", "l"), ("right", "r")):
        each = each.join(known.withColumnsRenamed({"_part": side, "_n": name}), ["lang", side])
    score = F.expr("(cast(2000000 as decimal(38, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    best = each.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_b"))
    sizes = F.sequence(F.lit(2), F.col("words") - 1)
    inner = F.flatten(F.transform(sizes, lambda s: F.transform(
        F.sequence(F.lit(1), F.col("words") - s + 1), lambda i: _texts_of(F.col("_w"), i, s))))
    longer = phrases.filter("words >= 3").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("_longer")).groupBy(
        "lang", "phrase").agg(F.max("_longer").alias("_longer"))
    left = best.join(longer, ["lang", "phrase"], "left").filter(
        F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("a") * cover_percent))
    return left.select("lang", "phrase", "a", F.col("_b.l").alias("l"), F.col("_b.r").alias("r"), F.col("_b.score").alias("score"))


def ranked(found: DataFrame, totals: DataFrame, most: int) -> DataFrame:
    """First of each part of a language, then first of the language, so that no language is sorted in one task."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = found.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    first = part.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_r") <= most)
    by_lang = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= most)
    return by_lang.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
