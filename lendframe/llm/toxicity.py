"""Toxicity by class-conditional Kneser-Ney models of words and word pairs.

Counts are gathered over all labelled documents that may teach: in how many toxic and ordinary documents each word and
each pair of neighbouring words occurs. Counting documents, not places, is the continuation count of Kneser-Ney smoothing
with documents as contexts: a word that one text repeats stays rare. Either class discounts its counts by the amount
that Kneser and Ney derive from how many expressions occur once and twice. What is taken off a word goes to the counts of
both classes together, what is taken off a pair is dealt by its class's likelihood of the word that ends it. So a rare
expression has nearly the same likelihood in both classes and says nothing, and an unknown pair says what its word says.

The score compares the two log-likelihoods for each token: the part of their difference above ``MARGIN`` is summed and
divided by the number of tokens. Differences below it are left out, as the mix of common words differs between any two sets
of texts. A logistic curve turns this into a probability. It is fitted on at most ``calibration_rows`` teaching documents (by
a hash of their ids), each read with its own share of the counts taken away.

All expressions are counted and smoothed, whatever their counts. Sent out are those that can change a score: a word of no
toxic document is never above the margin, nor is any pair that it ends; and a pair is left out where neither it nor its word
is above the margin, also when a document's own share is taken away. The rest goes in blocks of about ``BLOCK_ROWS``
expressions, one pass over the documents for each, dealt by the last word (16 bits of its hash) so that the passes add up.

Defined results: null, empty and wordless texts score as texts without any telling expression. Without teaching
documents of both classes all scores are the share of toxic ones (0.5 without any). Rows map one to one; repeated rows
and null or repeated ids are kept. Labels of ids without a document are ignored; of several labels the largest counts.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.bytes_np import LOWER, ODD, U, flat, word_hashes, word_spans
from lendframe.llm.folds import held_out, logistic, teaching_labels
from lendframe.llm.lattice import Sorted
from lendframe.llm.packed import BLOB_SCHEMA, bucket_count, bucket_of, by_bucket, column, deal, gathered, mix, map_batches, pack, unpack, unpacked
from lendframe.staging import staged

MARGIN, LEAST_DOCUMENTS, BLOCK_ROWS, PART_BYTES = 1.5, 1, 2_000_000, 4 << 20
#: Bits of the table that tells most documents without a label (as a power of two).
LABEL_BITS = 26
TEXTS, MARKS, COUNTS, SAMPLE, MODEL, SUMS = range(6)
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True
COUNT_NAMES = ["toxic", "ordinary", "word_toxic", "word_ordinary"]
SUM_NAMES = ["kind_of", "toxic", "ordinary", "toxic_once", "toxic_twice", "ordinary_once", "ordinary_twice", "rows"]


def tokens(texts):
    """Of each token its text, its word's hash, and the hash of the pair that it ends; a text's first token has none (0)."""
    data, offsets = flat(texts)
    data = LOWER[data]
    start, end, text = word_spans(data, offsets, WORD_BYTES)
    words = np.maximum(word_hashes(data, start, end), U(1))
    pairs = np.zeros(len(words), U)
    pairs[1:] = np.where(text[1:] == text[:-1], np.maximum(mix(words[:-1] * ODD ^ words[1:]), U(1)), U(0))
    return text, words, pairs


def _labelled(marks: DataFrame) -> np.ndarray:
    """A table of bits by the hash of an id: set for all labelled ids, and for few others. Its size is fixed."""
    def run(batches):
        table = np.zeros(1 << LABEL_BITS - 3, np.uint8)
        for t in batches:
            slots = t.column("hash").to_numpy().view(U) >> U(64 - LABEL_BITS)
            np.bitwise_or.at(table, slots >> U(3), (1 << (slots & U(7))).astype(np.uint8))
        yield pa.RecordBatch.from_pydict({"bits": [zlib.compress(table.tobytes(), 1)]})

    out = np.zeros(1 << LABEL_BITS - 3, np.uint8)
    for r in marks.select(F.xxhash64("id").alias("hash")).mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(zlib.decompress(bytes(r.bits)), np.uint8)
    return out


def _by_id(rows: DataFrame, kind: int, buckets: int, labelled=None) -> DataFrame:
    def run(batches):
        for t in gathered(batches, PART_BYTES):
            hashes = column(t, "hash").view(U)
            if labelled is not None:
                slots = hashes >> U(64 - LABEL_BITS)
                may = (labelled.value[slots >> U(3)] >> (slots & U(7)).astype(np.uint8)) & 1 > 0
                t, hashes = t.filter(pa.array(may)).combine_chunks(), hashes[may]
            yield from deal(bucket_of(hashes, buckets), {c: t.column(c).combine_chunks() for c in t.column_names if c != "hash"}, kind)

    return rows.withColumn("hash", F.xxhash64("id")).transform(map_batches, run, BLOB_SCHEMA)


def _by_expression(text: np.ndarray, expression: np.ndarray, last: np.ndarray, label: np.ndarray):
    """Distinct expressions in the order of their last words, those words, and the number of texts of either class."""
    order = np.lexsort((text, expression, last))
    text, expression, last = text[order], expression[order], last[order]
    if not len(text):
        return expression, last, np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.append(True, (expression[1:] != expression[:-1]) | (last[1:] != last[:-1]))
    first = new | np.append(True, text[1:] != text[:-1])
    toxic, starts = label[text[first]], np.flatnonzero(new[first])
    n_toxic = np.add.reduceat(toxic, starts)
    return expression[new], last[new], n_toxic, np.diff(np.append(starts, len(toxic))) - n_toxic


def _added(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, the place of each one's first, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    dealt = keys[order]
    starts = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1]))[:len(keys)]
    sums = [np.add.reduceat(c[order].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64) for c in counts]
    return dealt[starts], order[starts], *sums


def _count(buckets: int, sample_share: float):
    """Words of a bucket's labelled documents with the number of documents of either class, and with the pairs that they end."""
    def run(kinds):
        if TEXTS not in kinds or MARKS not in kinds:
            return
        marks = dict(zip(kinds[MARKS].column("id").to_pylist(), kinds[MARKS].column("label").to_pylist()))
        label = np.array([marks.get(i, -1) for i in kinds[TEXTS].column("id").to_pylist()])
        known = np.flatnonzero(label >= 0)
        if not len(known):
            return
        texts, label = kinds[TEXTS].take(pa.array(known)).combine_chunks(), label[known]
        # the documents themselves, under kind 0
        documents = [0, label.sum(), (label == 0).sum(), 0, 0, 0, 0, 0]
        yield from deal(np.zeros(1, np.int32), {c: np.array([v], np.int64) for c, v in zip(SUM_NAMES, documents)}, SUMS)
        text, words, pairs = tokens(texts.column("value"))
        word, _, toxic, ordinary = _by_expression(text, words, words, label)
        pair, last, pair_toxic, pair_ordinary = _by_expression(text[pairs > 0], pairs[pairs > 0], words[pairs > 0], label)
        ends = pa.array(np.append(np.searchsorted(last, word), len(last)).astype(np.int32))
        yield from deal(bucket_of(word, buckets), {
            "word": word, "toxic": toxic.astype(np.uint32), "ordinary": ordinary.astype(np.uint32),
            "pairs": pa.ListArray.from_arrays(ends, pa.array(pair)),
            "pairs_toxic": pa.ListArray.from_arrays(ends, pa.array(pair_toxic.astype(np.uint32))),
            "pairs_ordinary": pa.ListArray.from_arrays(ends, pa.array(pair_ordinary.astype(np.uint32)))}, COUNTS)
        hashes = column(texts, "spread").view(U) if sample_share < 1 else np.zeros(len(label), U)
        chosen = np.flatnonzero((mix(hashes) >> U(11)).astype(float) < sample_share * 2.0 ** 53)
        if len(chosen):
            yield from deal(np.zeros(len(chosen), np.int32), {"value": texts.column("value").take(pa.array(chosen)).combine_chunks(),
                                                              "label": label[chosen].astype(np.int8)}, SAMPLE)
    return run


def _add_counts(kinds):
    """Counts over all documents: the sums that discounts follow from, and the expressions whose last word is in toxic documents."""
    if COUNTS in kinds:
        t = kinds[COUNTS]
        word, _, toxic, ordinary = _added(*(column(t, c) for c in ("word", "toxic", "ordinary")))
        lists = [t.column(c).combine_chunks() for c in ("pairs", "pairs_toxic", "pairs_ordinary")]
        pair, first, pair_toxic, pair_ordinary = _added(*(x.flatten().to_numpy() for x in lists))
        of = np.searchsorted(word, np.repeat(column(t, "word"), np.diff(lists[0].offsets.to_numpy()))[first])
        for k, a, b in ((1, toxic, ordinary), (2, pair_toxic, pair_ordinary)):
            sums = [k, a.sum(), b.sum(), (a == 1).sum(), (a == 2).sum(), (b == 1).sum(), (b == 2).sum(), len(a)]
            yield from deal(np.zeros(1, np.int32), {c: np.array([v], np.int64) for c, v in zip(SUM_NAMES, sums)}, SUMS)
        last = (mix(word) >> U(48)).astype(np.uint16)
        # by words, so that what belongs to the word is the same in neighbouring rows
        by_word = np.argsort(of, kind="stable")
        of, pair, pair_toxic, pair_ordinary = (x[by_word] for x in (of, pair, pair_toxic, pair_ordinary))
        of = np.append(np.arange(len(word)), of)
        keep = toxic[of] >= LEAST_DOCUMENTS
        model = {"expression": np.append(word, pair), "last": last[of], "kind_of": np.repeat(np.array([1, 2], np.int8), [len(word), len(pair)]),
                 "toxic": np.append(toxic, pair_toxic), "ordinary": np.append(ordinary, pair_ordinary),
                 "word_toxic": toxic[of], "word_ordinary": ordinary[of]}
        yield from deal(np.zeros(int(keep.sum()), np.int32), {c: v[keep] for c, v in model.items()}, MODEL)
    for kind, names in ((SUMS, SUM_NAMES), (SAMPLE, ["value", "label"])):
        if kind in kinds:
            t = kinds[kind]
            yield from deal(np.zeros(t.num_rows, np.int32), {c: t.column(c).combine_chunks() for c in names}, kind)


class Smoothing:
    """Log-likelihood differences of expressions from their counts in either class."""

    def __init__(self, sums: dict[int, dict[str, int]]):
        self.kinds = {}
        for k in (1, 2):
            s = sums.get(k) or dict.fromkeys(SUM_NAMES, 0)
            classes = []
            for c in ("toxic", "ordinary"):
                once, twice = s[f"{c}_once"], s[f"{c}_twice"]
                classes.append((max(s[c], 1), once / (once + 2 * twice) if once and twice else 0.75))
            taken = sum(min(d, 1.0) * (s[f"{c}_once"] + 2 * s[f"{c}_twice"]) for c, (_, d) in zip(("toxic", "ordinary"), classes))
            both = max(s["toxic"] + s["ordinary"], 1)
            self.kinds[k] = (classes, min(max(taken / both, 0.05), 0.9), both + 0.5 * max(s["rows"], 1))

    def _words(self, toxic: np.ndarray, ordinary: np.ndarray) -> list[np.ndarray]:
        classes, rest, total = self.kinds[1]
        shared = rest * (toxic + ordinary + 0.5) / total
        return [(1 - rest) * np.maximum(c - d, 0) / n + shared for c, (n, d) in zip((toxic, ordinary), classes)]

    def words(self, toxic: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
        of_toxic, of_ordinary = self._words(toxic, ordinary)
        return np.log(of_toxic) - np.log(of_ordinary)

    def pairs(self, toxic: np.ndarray, ordinary: np.ndarray, word_toxic: np.ndarray, word_ordinary: np.ndarray) -> np.ndarray:
        """The same for pairs, given the counts of the words that end them."""
        classes, rest, total = self.kinds[2]
        lower = self._words(word_toxic, word_ordinary)
        shared = rest * (toxic + ordinary + 0.5) / total / ((lower[0] + lower[1]) / 2)
        logs = [np.log((1 - rest) * np.maximum(c - d, 0) / n + shared * w) for c, (n, d), w in zip((toxic, ordinary), classes, lower)]
        return logs[0] - logs[1]

    def telling(self, table: pa.Table) -> np.ndarray:
        """Which expressions can be above the margin or take their word from there: by all counts, or without one document's."""
        counts = [column(table, c).astype(np.int64) for c in COUNT_NAMES]
        out = column(table, "kind_of") == 1
        for own in ((0, 0), (1, 0), (0, 1)):
            a, b, c, d = (np.maximum(n - own[i % 2], 0) for i, n in enumerate(counts))
            out |= (self.pairs(a, b, c, d) > MARGIN) | (self.words(c, d) > MARGIN)
        return out


class Block:
    """Expressions with their counts, looked up for all tokens of a batch."""

    def __init__(self, table: pa.Table, smoothing: Smoothing):
        self.smoothing = smoothing
        self.find, self.toxic, self.ordinary = {}, {}, {}
        for k in (1, 2):
            of = column(table, "kind_of") == k
            keys = column(table, "expression")[of]
            self.find[k] = Sorted(keys, np.arange(len(keys), dtype=np.int32), bits=22)
            self.toxic[k], self.ordinary[k], *word = (column(table, c)[of].astype(np.int32) for c in COUNT_NAMES)
        self.word = word  # counts of the words that end the pairs

    def excess(self, texts, label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each text, and the sum of what their differences exceed the margin by.

        With ``label`` the texts are teaching documents, and their own count is taken off.
        """
        text, words, pairs = tokens(texts)
        out = np.zeros(len(words))
        for k, keys in ((1, words), (2, pairs)):
            at = self.find[k].find(keys, -1)
            hit = np.flatnonzero(at >= 0)
            counts = [c[at[hit]] for c in (self.toxic[k], self.ordinary[k], *(self.word if k == 2 else ()))]
            if label is not None:
                own = label[text[hit]]
                counts = [np.maximum(c - (1 - own if i % 2 else own), 0) for i, c in enumerate(counts)]
            out[hit] = np.maximum((self.smoothing.words if k == 1 else self.smoothing.pairs)(*counts) - MARGIN, 0)
        n = len(texts)
        return np.bincount(text, minlength=n), np.bincount(text, out, minlength=n).astype(float)


def _feature(count: np.ndarray, excess: np.ndarray) -> np.ndarray:
    return np.log(excess / np.maximum(count, 1) + 1e-3)


class ToxicityModel:
    """Counted expressions in the shared folder, their smoothing, and the curve from difference to probability."""

    def __init__(self, rows: DataFrame, smoothing: Smoothing, n_rows: int, prior: float):
        self.rows, self.smoothing, self.blocks = rows, smoothing, max(1, -(-n_rows // BLOCK_ROWS))
        self.slope, self.constant = 0.0, float(np.log(prior / (1 - prior)))

    def block(self, number: int) -> Block:
        """One block of the model on the driver; at most about ``BLOCK_ROWS`` expressions, by the hash of the last word."""
        blocks = self.blocks

        def run(batches):
            for t in unpacked(batches):
                mine = column(t, "last").astype(np.int64) % blocks == number
                yield pa.RecordBatch.from_pydict({
                    "expression": column(t, "expression")[mine].view(np.int64), "kind_of": column(t, "kind_of")[mine].astype(np.int32),
                    **{c: column(t, c)[mine] for c in COUNT_NAMES}})

        counts = ", ".join(f"{c} long" for c in COUNT_NAMES)
        held = self.rows.transform(map_batches, run, f"expression long, kind_of int, {counts}").toArrow()
        keys = column(held.combine_chunks(), "expression").view(U) if held.num_rows else np.zeros(0, U)
        return Block(pa.table({"expression": keys, **{c: held.column(c).to_numpy() for c in ("kind_of", *COUNT_NAMES)}}), self.smoothing)

    def scored(self, docs: DataFrame, text_column: str = "text") -> DataFrame:
        """``row`` (the document, all columns) and ``score``."""
        frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.lit(0.0).alias("excess"))
        kind = frame.schema["row"].dataType.simpleString()
        for number in range(self.blocks):
            sent = docs.sparkSession.sparkContext.broadcast(self.block(number))
            if number:
                frame = staged(frame, "partly-scored")
            frame = self._pass(frame, sent, kind, text_column, number == self.blocks - 1)
        return frame

    def _pass(self, frame: DataFrame, sent, kind: str, text_column: str, last: bool) -> DataFrame:
        slope, constant = self.slope, self.constant

        def run(batches):
            for t in gathered(batches, PART_BYTES):
                row = t.column("row").combine_chunks()
                count, excess = sent.value.excess(row.field(text_column).cast(pa.string()))
                excess = excess + t.column("excess").to_numpy()
                if last:
                    score = 1 / (1 + np.exp(-(slope * _feature(count, excess) + constant)))
                    yield pa.record_batch([row, pa.array(score)], names=["row", "score"])
                else:
                    yield pa.record_batch([row, pa.array(excess)], names=["row", "excess"])

        return frame.transform(map_batches, run, f"row {kind}, score double" if last else f"row {kind}, excess double")


def _calibrate(model: ToxicityModel, sample: DataFrame) -> None:
    counts, sums, labels = 0, 0, None
    for number in range(model.blocks):
        sent = sample.sparkSession.sparkContext.broadcast(model.block(number))

        def run(batches, sent=sent):
            for t in unpacked(batches):
                label = column(t, "label").astype(np.int64)
                count, excess = sent.value.excess(t.column("value"), label)
                yield pa.record_batch([pa.array(count), pa.array(excess), pa.array(label)], names=["n", "excess", "label"])

        # the bounded sample, in the order of its files
        got = sample.select("blob").transform(map_batches, run, "n long, excess double, label long").toArrow()
        counts, sums, labels = column(got, "n"), sums + column(got, "excess"), column(got, "label")
    if labels is not None and 0 < labels.sum() < len(labels):
        slope, constant = logistic(_feature(counts, sums)[:, None], labels)
        if slope > 0:
            model.slope, model.constant = float(slope), float(constant)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_column: str = "doc_id", text_column: str = "text",
        calibration_rows: int = 4000) -> ToxicityModel:
    """Count expressions over all teaching documents and fit the curve on a bounded sample of them."""
    spark = docs.sparkSession
    buckets = bucket_count(spark)
    marks = staged(teaching_labels(labels, label, id_column).select(F.col("id").cast("string").alias("id"), "label"), "labels")
    n_marks = marks.count()
    texts = docs.filter(F.col(id_column).isNotNull() & ~held_out(id_column)).select(
        F.col(id_column).cast("string").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("value"))
    texts = texts.withColumn("spread", F.xxhash64("id", "value"))
    # only documents that can have a label are shuffled
    dealt = _by_id(texts, TEXTS, buckets, spark.sparkContext.broadcast(_labelled(marks))).unionByName(_by_id(marks, MARKS, buckets))
    counted = by_bucket(dealt, _count(buckets, calibration_rows / max(n_marks, calibration_rows)), BLOB_SCHEMA)
    found = staged(by_bucket(counted, _add_counts, BLOB_SCHEMA), "expressions", ["kind"])
    sums = {}
    for r in found.filter(F.col("kind") == SUMS).select("blob").collect():
        for s in unpack([bytes(r.blob)]).to_pylist():
            own = sums.setdefault(s["kind_of"], dict.fromkeys(SUM_NAMES, 0))
            for c in SUM_NAMES[1:]:
                own[c] += s[c]
    documents = sums.get(0, dict.fromkeys(SUM_NAMES, 0))
    every = documents["toxic"] + documents["ordinary"]
    prior = documents["toxic"] / every if every else 0.5
    smoothing = Smoothing(sums)

    def tell(batches):
        for t in unpacked(batches):
            kept = t.filter(pa.array(smoothing.telling(t))).combine_chunks()
            yield pa.RecordBatch.from_pydict({"n": [kept.num_rows], "blob": [pack({c: kept.column(c).combine_chunks() for c in kept.column_names})]})

    telling = staged(found.filter(F.col("kind") == MODEL).select("blob").transform(map_batches, tell, "n long, blob binary"), "telling")
    n_rows = telling.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    model = ToxicityModel(telling.select("blob"), smoothing, n_rows, min(max(prior, 1e-3), 1 - 1e-3))
    _calibrate(model, found.filter(F.col("kind") == SAMPLE))
    return model


def report(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, held_out, score, predicted (1 if score >= 0.5)."""
    model = fit(docs, labels, "toxic", id_column, text_column)
    narrow = docs.select(F.col(id_column), F.col(text_column))
    scored = model.scored(narrow.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    return scored.select(F.col("row.id").alias(id_column), "score").select(
        id_column, held_out(id_column).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def ordinary_only(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all columns, that are not predicted toxic."""
    return fit(docs, labels, "toxic", id_column, text_column).scored(docs, text_column).filter("score < 0.5").select("row.*")
