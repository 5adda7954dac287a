"""Exact token counts of a byte-level BPE vocabulary, without encoding texts one by one.

The pre-tokenizer's pattern cuts a text into words. For each distinct word a prefix dynamic program keeps the token
count of every prefix, so the count of a text is a sum, and the place where a token budget ends is read from the
counts of one word. Every worker keeps the words it has met, up to a bound that only limits memory.

Defined results: null text counts as empty, with no tokens. Special strings of the vocabulary are one token each.
Rows map one to one, so repeated rows and null or repeated ids are kept. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.lattice import byte_vocabulary
from lendframe.llm.packed import map_batches

#: Pattern of the byte-level pre-tokenizer (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a worker remembers, and bytes of text that it takes at a time.
REMEMBERED, TEXT_BYTES = 800_000, 4 << 20


class Counter:
    """Token counts of words and texts under one vocabulary."""

    def __init__(self, path: str):
        self.vocabulary, specials = byte_vocabulary(path)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def words(self, text: str) -> list[str | None]:
        """Words in order; None stands for a special string."""
        if self.special is None:
            return self.pattern.findall(text)
        parts = self.special.split(text)
        if len(parts) == 1:
            return self.pattern.findall(text)
        out: list[str | None] = []
        for i, part in enumerate(parts):
            out += [None] if i % 2 else self.pattern.findall(part)
        return out

    def prefix_counts(self, words: list[str]) -> list[np.ndarray]:
        """For each word the token count of every prefix, in bytes; entry 0 is the empty prefix."""
        raw = [w.encode() for w in words]
        out: list[np.ndarray] = [np.zeros(1, np.int32)] * len(raw)
        for n, members in self.vocabulary.groups(np.array([len(r) for r in raw], np.int64)):
            if n:
                units = np.frombuffer(b"".join(raw[i] for i in members.tolist()), np.uint8).reshape(len(members), n)
                for i, row in zip(members.tolist(), self.vocabulary.segment(units)[1]):
                    out[i] = row
        return out

    def learn(self, words: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = [w for w in words if w not in self.known]
        raw = [w.encode() for w in new]
        for n, members in self.vocabulary.groups(np.array([len(r) for r in raw], np.int64)):
            units = np.frombuffer(b"".join(raw[i] for i in members.tolist()), np.uint8).reshape(len(members), n)
            for i, c in zip(members.tolist(), self.vocabulary.segment(units)[1][:, n].tolist()):
                self.known[new[i]] = c

    def word_ends(self, word: str) -> list[int]:
        """Byte offsets at which the word's tokens end."""
        units = np.frombuffer(word.encode(), np.uint8)[None, :]
        ids = self.vocabulary.back(self.vocabulary.segment(units)[0])[0]
        return list(accumulate(self.vocabulary.lengths[ids].tolist()))

    def count(self, texts: list[str], limit: int) -> tuple[list[int], list[int]]:
        """Tokens of each text, and the bytes that its first ``limit`` tokens cover."""
        split = [self.words(t) for t in texts]
        self.learn({w for ws in split for w in ws if w is not None})
        totals, fits = [], []
        for text, ws in zip(texts, split):
            counts = [1 if w is None else self.known[w] for w in ws]
            total = sum(counts)
            totals.append(total)
            if total <= limit:
                fits.append(len(text.encode()))
                continue
            before = size = 0
            specials = iter(self.special.findall(text)) if self.special and None in ws else iter(())
            for w, c in zip(ws, counts):
                s = next(specials) if w is None else w
                if before + c > limit:
                    if w is not None and limit > before:
                        size += self.word_ends(w)[limit - before - 1]
                    break
                before, size = before + c, size + len(s.encode())
            fits.append(size)
        return totals, fits


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's own counter, made once."""
    if path not in _counters:
        _counters.clear()
        _counters[path] = Counter(path)
    return _counters[path]


def parts(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows of about ``limit`` bytes."""
    a = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= limit:
            yield a, i + 1
            a, held = i + 1, 0
    if a < len(sizes):
        yield a, len(sizes)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit (n_tokens > limit), fits_bytes (bytes of the first ``limit`` tokens)."""
    narrow = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    schema = f"{id_column} {narrow.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean, fits_bytes long"

    def run(batches):
        own = counter(path)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).to_pylist()
            for a, b in parts(sizes, TEXT_BYTES):
                texts = batch.column("text").slice(a, b - a).to_pylist()
                totals, fits = own.count(texts, limit)
                yield pa.record_batch(
                    [batch.column("id").slice(a, b - a), pa.array(sizes[a:b], pa.int64()), pa.array(totals, pa.int64()),
                     pa.array([t > limit for t in totals], pa.bool_()), pa.array(fits, pa.int64())],
                    names=[id_column, "n_bytes", "n_tokens", "over_limit", "fits_bytes"])

    return narrow.transform(map_batches, run, schema)
