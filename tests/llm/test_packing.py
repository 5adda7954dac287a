"""Packing against the library's tokens, a plain best-fit, and the rules of a sequence."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from lendframe.llm import packing
from lendframe.llm.encoders import BytePairs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts():
    random.seed(3)
    words = ["alpha", "Beta's", " ", "\n", "ñandú", "12", "漢", "<|endoftext|>", "…", "we'll"]
    made = [" ".join(random.choices(words, k=random.choice([0, 1, 5, 40, 300]))) for _ in range(120)]
    return made + [None, "", "same", "same", "word " * 2500, "x" * 5000, " " * 60_000]


def test_byte_pairs_are_those_of_the_library(texts):
    own, library = BytePairs(PATH), Tokenizer.from_file(PATH)
    assert isinstance(own.ranked, tiktoken.Encoding)
    for t in texts:
        assert own.encode(t or "").tolist() == library.encode(t or "", add_special_tokens=False).ids
    letters = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x1F000, 0x1F700)]
    odd = [f"a{c}b 1{c}2 {c} .{c}. {c}{c}  {c}\n{c}" for c in letters]
    for t, encoded in zip(odd, library.encode_batch(odd, add_special_tokens=False)):
        assert own.encode(t).tolist() == encoded.ids
    library.encode_special_tokens = True
    for t in texts:
        assert own.encode(t or "", specials=False).tolist() == library.encode(t or "", add_special_tokens=False).ids


def test_other_vocabulary_files_go_through_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = BytePairs(path), Tokenizer.from_file(path)
    assert own.ranked is None
    assert own.encode("Some  Words here").tolist() == library.encode("Some  Words here", add_special_tokens=False).ids


def rows_of(spark, texts):
    rows = [(None if i % 9 == 4 else i // 2, t, "n", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, open int")


def test_pieces_and_sequences(spark, texts):
    docs = rows_of(spark, texts)
    got = packing.pack(docs, PATH, capacity=64, with_ids=True).cache()
    library = Tokenizer.from_file(PATH)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        for k, (at, size) in enumerate(packing.cut(len(ids), 64)):
            own = ids[at:at + size]
            want.append((r.doc_id, k, at, size, zlib.crc32(np.array(own, "<u4").tobytes()), own))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    rows = got.collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in rows], key=key) == sorted(want, key=key)
    laid = {}
    for r in rows:
        laid.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    for parts in laid.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    joined = {r.sequence_id: r.ids for r in packing.sequences(got).collect()}
    assert joined == {s: [i for _, _, ids in sorted(p) for i in ids] for s, p in laid.items()}
    assert len(laid) <= 1.03 * sum(r.length for r in rows) / 64 + 1
    got.unpersist()


def test_bins_of_finished_packers_meet_again(spark, monkeypatch):
    monkeypatch.setattr(packing, "FEW", 1)
    monkeypatch.setattr(packing, "JOINED", 3)
    random.seed(8)
    texts = ["a b" * random.randint(1, 30) for _ in range(400)]
    cut_pieces = packing.staged(packing.pieces(rows_of(spark, texts), PATH, 100), "pieces")
    apart = packing.placed(cut_pieces, 100, open_bins=8, window=8, packer_rows=20).collect()
    total = sum(r.length for r in apart)
    assert len(apart) == cut_pieces.count() and total == cut_pieces.groupBy().sum("length").first()[0]
    ends = {}
    for r in apart:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    # twenty packers of eight open bins each would leave far more of them half full
    assert len(ends) <= 1.1 * total / 100


def test_best_fit_takes_the_fullest_bin_and_closes_the_fullest():
    packer = packing.Packer(10, open_bins=2)
    assert packer.put(6, "a") == [] and packer.put(7, "b") == []
    assert packer.put(3, "c") == [[(0, "b"), (7, "c")]]  # fits 7 exactly, though 6 came first
    assert packer.put(8, "d") == [] and packer.put(9, "e") == [[(0, "d")]]  # the fullest of 6 and 8
    assert sorted(packer.rest()) == [[(0, "a")], [(0, "e")]]


@pytest.mark.parametrize("open_bins", [1, 3, 50])
def test_packer_equals_a_plain_search(open_bins):
    random.seed(open_bins)
    packer, plain, closed, gone = packing.Packer(30, open_bins), [], [], []
    for i in range(500):
        size = random.randint(1, 30)
        closed += packer.put(size, (i, size))
        fits = [b for b in plain if sum(s for _, s in b) + size <= 30]
        if fits:
            # of equally full ones the one filled last
            most = max(sum(s for _, s in b) for b in fits)
            chosen = [b for b in fits if sum(s for _, s in b) == most][-1]
            plain.remove(chosen)
        else:
            if len(plain) == open_bins:
                most = max(sum(s for _, s in b) for b in plain)
                full = [b for b in plain if sum(s for _, s in b) == most][-1]
                plain.remove(full)
                gone.append(full)
            chosen = []
        chosen.append((i, size))
        (gone if sum(s for _, s in chosen) == 30 else plain).append(chosen)
    assert [[b for _, b in c] for c in closed] == gone


def test_empty_table_and_binary_ids(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert packing.pack(none, PATH).collect() == []
    one = packing.pack(spark.createDataFrame([("x", None)], "doc_id string, text string"), PATH).collect()
    assert [(r.doc_id, r.piece, r.start, r.length, r.offset) for r in one] == [("x", 0, 0, 1, 0)]
