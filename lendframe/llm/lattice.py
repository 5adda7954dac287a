"""Segmenting words into vocabulary pieces by dynamic programming over all their prefixes at once.

Words of equal length advance together. Hashes of their substrings probe a sorted table of piece keys; for every
prefix the best last piece is kept, so the tokens of each prefix follow from back pointers.

A byte-pair vocabulary has one valid segmentation: the one in which every two neighbours would also stay apart if
merged alone. That is checked on the symbols that meet at their border, from single symbols up to the whole pieces.
A unigram vocabulary has scores instead, and the highest sum wins.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
FAR = np.int64(1) << 60
#: Cells of one length group that are worked on together.
CELLS = 1 << 21


def _key(hashes: np.ndarray, length: int) -> np.ndarray:
    x = (hashes ^ U(length * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(31))


def _rolling(units: np.ndarray) -> np.ndarray:
    """Prefix hashes of each row of units, one column more than ``units``."""
    out = np.zeros((units.shape[0], units.shape[1] + 1), U)
    for i in range(units.shape[1]):
        out[:, i + 1] = out[:, i] * BASE + units[:, i].astype(U) + U(1)
    return out


def _power(n: int) -> np.uint64:
    return U(pow(int(BASE), n, 1 << 64))


class Sorted:
    """Sorted keys with values; a bit table answers most absent keys without a search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = 21):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = U(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[(self._spread(self.keys)) >> self.shift] = True

    @staticmethod
    def _spread(keys: np.ndarray) -> np.ndarray:
        return keys * U(0xD6E8FEB86659FD93)

    def find(self, keys: np.ndarray, absent: int) -> np.ndarray:
        out = np.full(keys.shape, absent, self.values.dtype)
        hit = np.flatnonzero(self.seen[self._spread(keys.ravel()) >> self.shift])
        if len(hit) and len(self.keys):
            wanted = keys.ravel()[hit]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            same = self.keys[at] == wanted
            out.ravel()[hit[same]] = self.values[at[same]]
        return out


@dataclass
class Vocabulary:
    """Pieces as runs of units (bytes or code points), with merge ranks or scores.

    ``unknown`` is the number given to a unit that no piece holds; it stands alone.
    """

    pieces: list[tuple[int, ...]]
    ids: np.ndarray
    scores: np.ndarray | None
    pairs: dict[tuple[int, int], int] | None
    trees: dict[int, tuple[int, int]] | None
    rank: dict[int, int] | None
    longest: int = 0
    unknown: int = 0
    _known: tuple = field(default=None, repr=False)

    def __post_init__(self):
        self.unknown = int(self.ids.max()) + 1 if len(self.ids) else 0
        self.longest = max(map(len, self.pieces), default=1)
        keys = np.zeros(len(self.pieces), U)
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(self.pieces):
            by_length.setdefault(len(p), []).append(i)
        for n, members in by_length.items():
            rows = np.array([self.pieces[i] for i in members], np.int64).reshape(len(members), n)
            keys[members] = _key(_rolling(rows)[:, n], n)
        self.lengths = np.zeros(self.unknown + 1, np.int32)
        self.lengths[self.ids] = [len(p) for p in self.pieces]
        self.lengths[self.unknown] = 1
        self.table = Sorted(keys, self.ids.astype(np.int32))
        if self.scores is not None:
            self.score_of = np.full(self.unknown + 1, self.scores.min() - 10.0 if len(self.scores) else -10.0)
            self.score_of[self.ids] = self.scores
        if self.pairs is not None:
            a = np.array([k[0] for k in self.pairs], U) if self.pairs else np.zeros(0, U)
            b = np.array([k[1] for k in self.pairs], U) if self.pairs else np.zeros(0, U)
            self.merge = Sorted((a << U(32)) | b, np.array(list(self.pairs.values()), np.int64))
            self._spines()
            # the arrays hold all of it; every worker has its own
            self.pairs = self.trees = self.rank = None
            self._known = (np.zeros(0, U), np.zeros(0, bool))

    def _spines(self) -> None:
        """For each piece the symbols at its right and left border, from a single unit up to the piece itself,
        and the rank of the merge that ends each of them."""
        sides = []
        for side in (1, 0):
            start, symbols, ends = np.zeros(self.unknown + 2, np.int64), [], []
            for t in range(self.unknown + 1):
                chain = [t]
                while (tree := self.trees.get(chain[-1])) is not None:
                    chain.append(tree[side])
                chain.reverse()
                symbols += chain
                ends += [self.rank[up] for up in chain[1:]] + [FAR]
                start[t + 1] = len(symbols)
            sides.append((start[:-1], np.array(symbols, np.int64), np.array(ends, np.int64)))
        self.right, self.left = sides

    def _apart(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether two neighbouring pieces stay two when their units are merged by rank, leftmost first."""
        rs, rsym, rend = self.right
        ls, lsym, lend = self.left
        i, j = rs[first], ls[second]
        out, live = np.ones(len(first), bool), np.arange(len(first))
        while len(live):
            ends_i, ends_j = rend[i], lend[j]
            rank = self.merge.find((rsym[i].astype(U) << U(32)) | lsym[j].astype(U), FAR)
            broken = (rank < FAR) & (rank < ends_i) & (rank <= ends_j)
            out[live[broken]] = False
            keep = ~broken & ~((ends_i == FAR) & (ends_j == FAR))
            up = ends_i <= ends_j
            i, j, live = (i + up)[keep], (j + ~up)[keep], live[keep]
        return out

    def apart(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """As ``_apart``, with the pairs met so far kept."""
        wanted = (first.astype(U) << U(32)) | second.astype(U)
        keys, inverse = np.unique(wanted, return_inverse=True)
        known, values = self._known
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        have = known[at] == keys if len(known) else np.zeros(len(keys), bool)
        out = np.zeros(len(keys), bool)
        out[have] = values[at[have]] if len(known) else False
        new = keys[~have]
        if len(new):
            made = self._apart((new >> U(32)).astype(np.int64), (new & U(0xFFFFFFFF)).astype(np.int64))
            out[~have] = made
            if len(known) > 4_000_000:  # forget, so that memory stays bounded
                known, values = known[:0], values[:0]
            where = np.searchsorted(known, new)
            self._known = (np.insert(known, where, new), np.insert(values, where, made))
        return out[inverse]

    def segment(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best last piece of every prefix of each row: numbers and token counts, a column for each prefix.

        Column 0 is the empty prefix. All rows have the same length.
        """
        m, n = units.shape
        rolled = _rolling(units)
        last = np.full((m, n + 1), -1, np.int32)
        count = np.zeros((m, n + 1), np.int32)
        found = {}
        for size in range(1, min(n, self.longest) + 1):
            ids = self.table.find(_key(rolled[:, size:] - rolled[:, :-size] * _power(size), size), -1)
            if size == 1:
                ids[ids < 0] = self.unknown
            where = np.flatnonzero((ids >= 0).any(axis=0))
            for p in where.tolist():
                found.setdefault(p + size, []).append((size, ids[:, p]))
        best = np.zeros((m, n + 1)) if self.scores is not None else None
        for i in range(1, n + 1):
            if best is not None:
                value = np.full(m, -np.inf)
                for size, ids in found[i]:
                    own = np.where(ids >= 0, best[:, i - size] + self.score_of[ids], -np.inf)
                    better = own > value
                    value[better] = own[better]
                    last[better, i] = ids[better]
                    count[better, i] = count[better, i - size] + 1
                best[:, i] = value
                continue
            open_ = np.ones(m, bool)
            for size, ids in reversed(found[i]):
                rows = np.flatnonzero(open_ & (ids >= 0))
                if not len(rows):
                    continue
                if size < i:
                    rows = rows[self.apart(last[rows, i - size], ids[rows])]
                last[rows, i] = ids[rows]
                count[rows, i] = count[rows, i - size] + 1
                open_[rows] = False
        return last, count

    def back(self, last: np.ndarray) -> list[np.ndarray]:
        """Piece numbers of each whole row, in order, from the back pointers."""
        m, n = last.shape[0], last.shape[1] - 1
        at, steps = np.full(m, n), []
        while (at > 0).any():
            ids = np.where(at > 0, last[np.arange(m), at], -1)
            steps.append(ids)
            at = at - np.where(ids >= 0, self.lengths[ids], 0)
        if not steps:
            return [np.zeros(0, np.int32)] * m
        table = np.array(steps[::-1]).T
        return [row[row >= 0] for row in table]

    def groups(self, sizes: np.ndarray):
        """Numbers of words of equal length, in parts of bounded size."""
        order = np.argsort(sizes, kind="stable")
        dealt = sizes[order]
        cuts = np.append(np.flatnonzero(dealt[1:] != dealt[:-1]) + 1, len(dealt))
        a = 0
        for b in cuts.tolist():
            if b > a:
                n = int(dealt[a])
                step = max(1, CELLS // max(1, n * min(n, self.longest)))
                for c in range(a, b, step):
                    yield n, order[c:min(b, c + step)]
            a = b


def byte_vocabulary(path: str) -> tuple[Vocabulary, list[str]]:
    """A byte-level merge vocabulary and the special strings that stand for one token each."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    vocab, merges = data["model"]["vocab"], data["model"]["merges"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbol = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in printable)}
    byte = {c: b for b, c in symbol.items()}
    pieces = [tuple(byte[c] for c in p) for p in vocab if all(c in byte for c in p)]
    ids = np.array([i for p, i in vocab.items() if all(c in byte for c in p)], np.int64)
    pairs, trees, rank = {}, {}, {}
    for r, pair in enumerate(merges):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        whole = vocab[a + b]
        pairs[vocab[a], vocab[b]] = r
        if whole not in trees:
            trees[whole], rank[whole] = (vocab[a], vocab[b]), r
    return Vocabulary(pieces, ids, None, pairs, trees, rank), [t["content"] for t in data["added_tokens"]]


def _merged(units: tuple[str, ...], rank: dict[str, int]):
    """Trees left after merging neighbours by rank, leftmost first."""
    nodes = [(u, None, None) for u in units]
    while len(nodes) > 1:
        best = min((rank.get(nodes[i][0] + nodes[i + 1][0], FAR), i) for i in range(len(nodes) - 1))
        if best[0] == FAR:
            break
        i = best[1]
        nodes[i:i + 2] = [(nodes[i][0] + nodes[i + 1][0], nodes[i][0], nodes[i + 1][0])]
    return nodes


def piece_vocabulary(path: str, kind: str = "bpe"):
    """Vocabulary of a SentencePiece model over code points; also the piece strings and the ids of bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names, bytes_, normal = [], {}, []
    for i in range(model.get_piece_size()):
        names.append(model.id_to_piece(i))
        if model.is_byte(i):
            bytes_[int(names[i][3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            normal.append(i)
    units = lambda i: tuple(map(ord, names[i]))
    if kind == "unigram":
        ids = np.array(normal)
        scores = np.array([model.get_score(i) for i in normal])
        return Vocabulary([units(i) for i in normal], ids, scores, None, None, None), names, bytes_
    number = {names[i]: i for i in normal}
    # merges go by score, the highest first
    order = {names[i]: r for r, i in enumerate(sorted((i for i in normal if len(names[i]) > 1), key=lambda i: -model.get_score(i)))}
    trees, rank, reached = {}, {}, []
    for i in normal:
        nodes = _merged(tuple(names[i]), order)
        if len(nodes) == 1:
            reached.append(i)
            if nodes[0][1] is not None:
                trees[i], rank[i] = (number.get(nodes[0][1], -1), number.get(nodes[0][2], -1)), order[names[i]]
    known = {names[i] for i in reached}
    pairs = {(number[w[:c]], number[w[c:]]): r for w, r in order.items() if w in known
             for c in range(1, len(w)) if w[:c] in known and w[c:] in known}
    return Vocabulary([units(i) for i in reached], np.array(reached), None, pairs, trees, rank), names, bytes_
