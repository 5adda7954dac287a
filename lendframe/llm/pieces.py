"""SentencePiece encoding and decoding as Spark jobs around batched numpy segmentation.

A text is prefixed with a word mark, its spaces become word marks, and it is cut before each run of marks that
follows other characters: no piece of such a vocabulary crosses those places. Distinct words go through the lattice
by equal length (``lattice.py``), so the numbers equal those of the library that the model file belongs to.

Defined results: null and empty texts have no tokens and decode to the empty text. Characters outside the vocabulary
become their bytes. A text that holds the word mark itself decodes to a space there, as in the library. Rows map one to
one; repeated rows and null or repeated ids are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.lattice import piece_vocabulary
from lendframe.llm.token_counts import parts
from lendframe.llm.packed import map_batches

MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
REMEMBERED, TEXT_BYTES = 500_000, 2 << 20


def _taken(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + size]`` one after the other."""
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(int(size.sum()))]


class Codec:
    """Words and texts to piece numbers and back, under one model file."""

    def __init__(self, path: str, kind: str = "bpe"):
        self.vocabulary, self.names, self.byte_ids = piece_vocabulary(path, kind)
        back = {i: b for b, i in self.byte_ids.items()}
        raw = [bytes([back[i]]) if i in back else b"" if re.fullmatch(r"<s>|</s>|<unk>|<pad>", n) else n.replace(MARK, " ").encode()
               for i, n in enumerate(self.names)]
        self.piece_size = np.array([len(r) for r in raw], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.size = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]

    def learn(self, words: set[str]) -> None:
        """Segment the words not met before and keep their numbers."""
        new = [w for w in words if w not in self.known]
        made: list[np.ndarray] = [None] * len(new)
        for n, members in self.vocabulary.groups(np.array([len(w) for w in new], np.int64)):
            joined = "".join(new[i] for i in members.tolist())
            units = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(members), n)
            last = self.vocabulary.segment(units)[0]
            odd = (last == self.vocabulary.unknown).any(axis=1).tolist()
            for i, ids, has in zip(members.tolist(), self.vocabulary.back(last), odd):
                made[i] = self._bytes(new[i], ids) if has else ids
        for w in new:
            self.known[w] = len(self.known)
        self.flat.append(np.concatenate([np.zeros(0, np.int32), *made]).astype(np.int32))
        self.size.append(np.array([len(x) for x in made], np.int64))
        self.flat, self.size = [np.concatenate(self.flat)], [np.concatenate(self.size)]

    def _bytes(self, word: str, ids: np.ndarray) -> np.ndarray:
        out, at = [], 0
        for i in ids.tolist():
            if i == self.vocabulary.unknown:
                raw = word[at].encode()
                out += [self.byte_ids[b] for b in raw] if self.byte_ids else [0]
            else:
                out.append(i)
            at += int(self.vocabulary.lengths[i])
        return np.array(out, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all texts one after the other, and the count of each text."""
        split = [_WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.forget()
        self.learn({w for ws in split for w in ws})
        flat, size = self.flat[0], self.size[0]
        start = np.cumsum(size) - size
        words = np.array([self.known[w] for ws in split for w in ws], np.int64)
        ends = np.cumsum([len(ws) for ws in split])
        tokens = np.append(0, np.cumsum(size[words]))
        cut = tokens[ends] if len(ends) else np.zeros(0, np.int64)
        return _taken(flat, start[words], size[words]), np.diff(cut, prepend=0)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Texts in UTF-8 from piece numbers; the word mark put before each text is taken away."""
        size = self.piece_size[ids]
        raw = _taken(self.piece_bytes, self.piece_start[ids], size).tobytes()
        ends = np.append(0, np.cumsum(size))[np.cumsum(counts)] if len(counts) else np.zeros(0, np.int64)
        out, a = [], 0
        for b in ends.tolist():
            out.append(raw[a + (raw[a:a + 1] == b" "):b])
            a = b
        return out


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, kind: str = "bpe") -> Codec:
    """The worker's own codec, made once."""
    if (path, kind) not in _codecs:
        _codecs.clear()
        _codecs[path, kind] = Codec(path, kind)
    return _codecs[path, kind]


def encode(docs: DataFrame, path: str, kind: str = "bpe", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, tokens (piece numbers), round_trip (the tokens decode to the very text)."""
    narrow = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    schema = (f"{id_column} {narrow.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, "
              "tokens array<int>, round_trip boolean")

    def run(batches):
        own = codec(path, kind)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).to_pylist()
            for a, b in parts(sizes, TEXT_BYTES):
                texts = batch.column("text").slice(a, b - a).to_pylist()
                ids, counts = own.encode(texts)
                same = [d == t.encode() for d, t in zip(own.decode(ids, counts), texts)]
                tokens = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch(
                    [batch.column("id").slice(a, b - a), pa.array(sizes[a:b], pa.int64()), pa.array(counts, pa.int64()),
                     tokens, pa.array(same, pa.bool_())],
                    names=[id_column, "n_bytes", "n_tokens", "tokens", "round_trip"])

    return narrow.transform(map_batches, run, schema)


def decode(rows: DataFrame, path: str, kind: str = "bpe", id_column: str = "doc_id", tokens_column: str = "tokens") -> DataFrame:
    """Per row: id and text of its piece numbers. Null tokens give the empty text."""
    narrow = rows.select(F.col(id_column).alias("id"), F.coalesce(F.col(tokens_column), F.array().cast("array<int>")).alias("tokens"))
    schema = f"{id_column} {narrow.schema['id'].dataType.simpleString()}, text string"

    def run(batches):
        own = codec(path, kind)
        for batch in batches:
            lists = batch.column("tokens")
            counts = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = [raw.decode("utf-8", "replace") for raw in own.decode(ids, counts)]
            yield pa.record_batch([batch.column("id"), pa.array(texts, pa.string())], names=[id_column, "text"])

    return narrow.transform(map_batches, run, schema)
