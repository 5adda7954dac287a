"""Quality by a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes read the text byte by byte, with one more input that says whether the eight bytes at a place
stood there a short way before. Chunks of ``CHUNK`` bytes, each overlapping the next by half, cover the whole document;
each filter keeps its largest answer in each chunk. The mean and the maximum of those over all chunks, weighted, make
one probability. A text of any length is read whole, in slices of bounded size.

The network is trained here on at most ``sample_rows`` labelled documents, chosen by a hash of their ids among those of
at most ``SAMPLE_BYTES`` bytes; both bounds limit what the driver holds. Scoring is a narrow pass over all documents.

Defined results: null and empty texts have no chunks and get the probability that the constant stands for. Without
teaching documents every score is 0.5. Rows map one to one; repeated rows and null or repeated ids are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.bytes_np import U, flat
from lendframe.llm.folds import held_out, teaching_labels
from lendframe.llm.token_counts import parts
from lendframe.llm.packed import map_batches

WIDTH, FILTERS, CHUNK = 6, 16, 256
HALF = CHUNK // 2
#: How far back the repeat input looks.
BACK = (4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 18, 20, 24)
SLICE_BYTES, SAMPLE_BYTES = 256 << 10, 64 << 10


def laid_out(texts):
    """Bytes of all texts, each padded with zeros to whole half chunks and one filter width more; the repeat input;
    the text of each half chunk."""
    data, offsets = flat(texts)
    sizes = np.diff(offsets)
    halves = -(-sizes // HALF)
    start = (np.cumsum(halves) - halves) * HALF
    total = int(halves.sum()) * HALF
    out = np.zeros(total + WIDTH + 8, np.uint8)
    if len(data):
        out[np.repeat(start - offsets[:-1], sizes) + np.arange(len(data))] = data
    eights = np.ndarray(total + WIDTH, U, out, strides=(1,))
    seen = np.zeros(total, bool)
    for back in BACK:
        seen[back:] |= eights[back:total] == eights[:max(total - back, 0)]
    seen &= out[:total] != 0
    return out, seen.astype(np.uint8), np.repeat(np.arange(len(sizes)), halves)


class Network:
    """Weights: ``table`` [place in the filter, byte, filter], ``repeat`` [filter], ``bias``, and the combining weights."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.repeat = rng.normal(0, 0.3, FILTERS).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.combine = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.constant = np.zeros(1, np.float32)
        self.pairs = None

    def parameters(self):
        return [self.table, self.repeat, self.bias, self.combine, self.constant]

    def _answers(self, data: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Each filter's answer at each place."""
        n = len(seen)
        if self.pairs is None:
            # two neighbouring bytes looked up at once
            self.pairs = [(self.table[j][:, None, :] + self.table[j + 1][None, :, :]).reshape(65536, FILTERS) for j in range(0, WIDTH, 2)]
            self.flags = np.stack([self.bias, self.bias + self.repeat])
        both = data[:-1].astype(np.uint16) << 8 | data[1:]
        out = self.flags[seen]
        held = np.empty((n, FILTERS), np.float32)
        for k, table in enumerate(self.pairs):
            np.take(table, both[2 * k:2 * k + n], axis=0, out=held, mode="clip")
            out += held
        return out

    @staticmethod
    def _chunks(half: np.ndarray, of: np.ndarray):
        """Chunks are two neighbouring half chunks of one text, or the only one; the last chunk of a text ends it."""
        last = np.append(of[1:] != of[:-1], True) if len(of) else np.zeros(0, bool)
        first = np.append(True, of[1:] != of[:-1]) if len(of) else last
        left = np.flatnonzero(~last | first)
        right = np.where(last[left], left, left + 1)
        return left, right

    def features(self, texts) -> np.ndarray:
        """Mean and maximum over its chunks of each filter's largest answer, for each text."""
        data, seen, of = laid_out(texts)
        half = np.zeros((len(of), FILTERS), np.float32)
        step = SLICE_BYTES // HALF
        for a in range(0, len(of), step):
            b = min(a + step, len(of))
            answers = self._answers(data[a * HALF:b * HALF + WIDTH], seen[a * HALF:b * HALF])
            half[a:b] = answers.reshape(b - a, HALF, FILTERS).max(axis=1)
        return self._pooled(half, of, len(texts))[0]

    def _pooled(self, half, of, n):
        left, right = self._chunks(half, of)
        best = np.maximum(np.maximum(half[left], half[right]), 0)
        out = np.zeros((n, 2 * FILTERS), np.float32)
        owner = of[left]
        if len(left):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            out[owner[starts], :FILTERS] = np.add.reduceat(best, starts) / np.diff(np.append(starts, len(left)))[:, None]
            out[owner[starts], FILTERS:] = np.maximum.reduceat(best, starts)
        return out, best, left, right, owner

    def probability(self, texts) -> np.ndarray:
        return self._curve(self.features(texts) @ self.combine + self.constant[0])

    @staticmethod
    def _curve(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -30, 30)))

    def gradients(self, texts, labels: np.ndarray):
        """Gradients of the mean log loss, in the order of ``parameters``."""
        data, seen, of = laid_out(texts)
        answers = self._answers(data[:len(seen) + WIDTH], seen).reshape(len(of), HALF, FILTERS)
        at = answers.argmax(axis=1)
        half = np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0]
        pooled, best, left, right, owner = self._pooled(half, of, len(labels))
        error = (self._curve(pooled @ self.combine + self.constant[0]) - labels).astype(np.float32) / len(labels)
        chunks = np.bincount(owner, minlength=len(labels)).astype(np.float32)
        top = (best == pooled[owner, FILTERS:]).astype(np.float32)
        if len(owner):
            starts = np.append(True, owner[1:] != owner[:-1])
            top /= np.add.reduceat(top, np.flatnonzero(starts))[np.cumsum(starts) - 1]
        up = error[owner, None] * (self.combine[:FILTERS] / np.maximum(chunks[owner], 1)[:, None]
                                   + self.combine[FILTERS:] * top)
        up *= best > 0
        winner = np.where(half[left] >= half[right], left[:, None], right[:, None])
        place = (winner * HALF + at[winner, np.arange(FILTERS)]).ravel()
        up, which = up.ravel(), np.tile(np.arange(FILTERS), len(left))
        table = np.zeros_like(self.table)
        for j in range(WIDTH):
            table[j] = np.bincount(data[place + j].astype(np.int64) * FILTERS + which, up, minlength=256 * FILTERS).reshape(256, FILTERS)
        repeat = np.bincount(which, up * seen[place], minlength=FILTERS) if len(place) else np.zeros(FILTERS)
        bias = np.bincount(which, up, minlength=FILTERS) if len(place) else np.zeros(FILTERS)
        return [table, repeat.astype(np.float32), bias.astype(np.float32), pooled.T @ error, error.sum(keepdims=True)]

    def train(self, texts: pa.Array, labels: np.ndarray, epochs: int = 12, batch: int = 24, rate: float = 0.02, seed: int = 3) -> None:
        """Adam over shuffled batches, with the rate falling to nothing."""
        rng = np.random.default_rng(seed)
        share = np.clip(labels.mean(), 0.02, 0.98)
        self.constant[0] = np.log(share / (1 - share))
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        step, steps = 0, epochs * -(-len(labels) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for a in range(0, len(order), batch):
                rows = order[a:a + batch]
                step += 1
                now = rate * (1 - step / (steps + 1))
                for p, g, m, v in zip(self.parameters(), self.gradients(texts.take(pa.array(rows)), labels[rows]), first, second):
                    g = g + 1e-5 * p
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= (now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
                self.pairs = None


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text_column: str = "text",
        sample_rows: int = 2000) -> Network | None:
    """Train on a bounded sample of the labelled rows that may teach. None without any."""
    marks = teaching_labels(labels, label, id_column)
    total = marks.count()
    if not total:
        return None
    # about so many rows by a hash of their ids, and no more of them
    chosen = marks.withColumn("spread", F.xxhash64("id", F.lit(11)))
    cut = int(-(1 << 63) + (1 << 64) * min(1.0, 1.2 * sample_rows / total)) - 1
    chosen = chosen.filter(F.col("spread") <= cut).orderBy("spread", "id").limit(sample_rows)
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")).filter(
        (F.octet_length("text") <= SAMPLE_BYTES) & ~held_out("id"))
    # at most sample_rows ids are broadcast
    got = texts.join(F.broadcast(chosen.select("id", "label")), "id").groupBy("id").agg(
        F.min("text").alias("text"), F.max("label").alias("label")).orderBy("id").toArrow().combine_chunks()
    if not got.num_rows:
        return None
    network = Network()
    network.train(got.column("text").combine_chunks(), got.column("label").to_numpy().astype(np.float32))
    network.pairs = None
    return network


def scored(docs: DataFrame, network: Network | None, text_column: str = "text") -> DataFrame:
    """``row`` (the document, all columns) and ``score``."""
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    if network is None:
        return frame.select("row", F.lit(0.5).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            texts = batch.column("row").field(text_column).cast(pa.string())
            for a, b in parts(pa.compute.binary_length(texts).fill_null(0).to_pylist(), 4 * SLICE_BYTES):
                scores = sent.value.probability(texts.slice(a, b - a))
                yield pa.record_batch([batch.column("row").slice(a, b - a), pa.array(scores)], names=["row", "score"])

    return frame.transform(map_batches, run, f"row {frame.schema['row'].dataType.simpleString()}, score double")


def report(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per document: id, held_out, score, predicted (1 if score >= threshold)."""
    network = fit(docs, labels, "quality", id_column, text_column)
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return scored(narrow, network).select(F.col("row.id").alias(id_column), "score").select(
        id_column, held_out(id_column).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
