"""The vocabularies' own libraries as encoders from texts to numpy, made once a worker.

A byte-level vocabulary file whose merges are in the order of their numbers gives the same tokens by ranks, several
times faster; tests compare both over all characters. Any other file goes through its library.
"""

from __future__ import annotations

import json

import numpy as np

from lendframe.llm.token_counts import PATTERN

MARK = "▁"
#: From so many blanks in a row on, a text goes through the file's own library: the other's pattern might give up.
MANY_BLANKS = " " * 50_000


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others are moved up."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class BytePairs:
    """Token numbers of a byte-level vocabulary file (.json)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.specials = {t["content"]: t["id"] for t in said["added_tokens"]}
        letters = byte_letters()
        vocabulary = {t: i for t, i in said["model"]["vocab"].items() if t not in self.specials}
        self.bytes_of: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items()
                                           if all(c in letters for c in t)}
        self.ranked = self._ranked(said, vocabulary) if len(self.bytes_of) == len(vocabulary) else None

    def _ranked(self, said: dict, vocabulary: dict[str, int]):
        merges = [m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"]]
        made = [vocabulary[a + b] for a, b in merges]
        cutter = said["pre_tokenizer"] or {}
        plain_tokens = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in said["added_tokens"])
        if (said["normalizer"] or said["model"].get("ignore_merges") or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space")
                or not cutter.get("use_regex", True) or made != sorted(set(made)) or len(made) + 256 != len(vocabulary) or not plain_tokens):
            return None
        import tiktoken

        return tiktoken.Encoding("file", pat_str=PATTERN, special_tokens=self.specials,
                                 mergeable_ranks={raw: i for i, raw in self.bytes_of.items()})

    def encode(self, text: str, specials: bool = True) -> np.ndarray:
        """Numbers of one text; its special strings are tokens of their own, or plain text."""
        if self.ranked is not None and MANY_BLANKS not in text:
            return self.ranked.encode_to_numpy(text, allowed_special="all" if specials else set(), disallowed_special=())
        self.library.encode_special_tokens = not specials
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def byte_table(self) -> list[bytes]:
        """Bytes of each token number, special strings as they are written."""
        known = self.bytes_of | {i: t.encode() for t, i in self.specials.items()}
        return [known.get(i, b"") for i in range(max(known) + 1)]


class Pieces:
    """Piece numbers of a model file (.model)."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)

    def byte_table(self) -> list[bytes]:
        """Bytes of each piece number: word marks as spaces, byte pieces as their byte."""
        own = self.library
        return [bytes([int(own.id_to_piece(i)[3:5], 16)]) if own.is_byte(i) else own.id_to_piece(i).replace(MARK, " ").encode()
                for i in range(own.get_piece_size())]


_made: dict[tuple[type, str], object] = {}


def made_once(kind: type, path: str):
    """The worker's own encoder of a file."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]
