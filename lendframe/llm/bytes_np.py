"""Byte texts as numpy columns: buffers of a batch, words, and rolling hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
ODD = U(0x9E3779B97F4A7C15)
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and n + 1 offsets. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Start and end of each maximal run of word bytes that lies in one text, and the text's number.

    ``is_word`` says of each byte value whether it belongs to words.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] |= inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] |= inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``data``; spans of equal bytes get equal hashes."""
    if not len(start):
        return np.zeros(0, U)
    out = np.zeros(len(start), U)
    size = end - start
    # eight bytes a step: every span takes part while it has bytes left
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, U, padded, strides=(1,))
    live = np.arange(len(start))
    at, left = start.copy(), size.copy()
    while len(live):
        chunk = eights[at].copy()
        short = left < 8
        chunk[short] &= (U(1) << (left[short].astype(U) * U(8))) - U(1)
        h = (out[live] ^ chunk) * ODD
        h ^= h >> U(32)
        h *= U(0xD6E8FEB86659FD93)
        out[live] = h ^ (h >> U(29))
        keep = left > 8
        live, at, left = live[keep], at[keep] + 8, left[keep] - 8
    out = (out ^ size.astype(U)) * U(0xBF58476D1CE4E5B9)
    return out ^ (out >> U(31))


def window_hashes(tokens: np.ndarray, k: int) -> np.ndarray:
    """Order-aware hash of each run of ``k`` tokens (64-bit each); len(tokens) - k + 1 values."""
    n = len(tokens) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    made = np.zeros(n, U)
    done, size, block, rest = 0, 1, tokens, k
    while rest:
        if rest & 1:
            made = (made ^ block[done:done + n]) * ODD
            made ^= made >> U(29)
            done += size
        rest >>= 1
        if rest:
            right = block[size:]
            block = (block[:len(right)] * U(0xD6E8FEB86659FD93)) ^ (right + (right >> U(31)))
            block = block * ODD
            size *= 2
    made *= U(0xBF58476D1CE4E5B9)
    return made ^ (made >> U(32))


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values, by block prefixes and suffixes."""
    m = len(values) - w + 1
    pad = -len(values) % w
    blocks = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, U)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:m], ahead[w - 1:w - 1 + m])
