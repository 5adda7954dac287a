"""Token counts and SentencePiece numbers against the libraries that own the vocabularies."""

import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lendframe.llm import pieces, token_counts
from lendframe.llm.lattice import Vocabulary

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    letters = "abeihtnosr  \n\t!1é漢▁'"
    made = ["".join(random.choices(letters, k=random.randint(0, 300))) for _ in range(150)]
    return made + ["", None, " ", "a" * 3000, "<|endoftext|>x<|endoftext|>", "it's we'll  <s> </s>", "word " * 900, "x\u0000y",
                   "▁ lead", "  two", "end  ", "same", "same", "\U0001f600 ok"]


def frame(spark, texts):
    rows = [(i if i % 7 else None, t, "n") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counts_equal_library(spark, texts):
    library = Tokenizer.from_file(BPE)
    want = []
    for i, t in enumerate(texts):
        encoded = library.encode(t or "", add_special_tokens=False)
        size = len((t or "").encode())
        fits = size if len(encoded.ids) <= 40 else None
        want.append((i if i % 7 else None, size, len(encoded.ids), len(encoded.ids) > 40, fits))
    got = token_counts.token_counts(frame(spark, texts), BPE, limit=40).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:4] == w[:4] and (w[4] is None or g[4] == w[4])


def test_budget_ends_where_tokens_end():
    library, own = Tokenizer.from_file(BPE), token_counts.Counter(BPE)
    text = "antidisestablishment <|endoftext|> of the unthinkable, 12345 cafés"
    ids = library.encode(text, add_special_tokens=False).ids
    for limit in range(1, len(ids)):
        _, fits = own.count([text], limit)
        head = text.encode()[:fits[0]]
        assert head == library.decode(ids[:limit], skip_special_tokens=False).encode()[:len(head)]
        assert len(library.encode(head.decode("utf-8", "ignore"), add_special_tokens=False).ids) <= limit + 1


def test_prefix_counts_are_those_of_each_prefix():
    library, own = Tokenizer.from_file(BPE), token_counts.Counter(BPE)
    for word in ("unthinkable", " thtionhand", "aaaaaaaaaaaaaaaaaaa"):
        counts = own.prefix_counts([word])[0]
        assert counts.tolist() == [len(library.encode(word[:i], add_special_tokens=False).ids) for i in range(len(word) + 1)]


def test_pieces_equal_library(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.encode(frame(spark, texts), PIECES).collect()
    want = [(i if i % 7 else None, library.encode(t or "")) for i, t in enumerate(texts)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, list(r.tokens)) for r in got], key=key) == sorted(want, key=key)
    assert all(r.n_tokens == len(r.tokens) for r in got)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t in enumerate(texts):
        if i % 7:
            assert by_id[i].round_trip == (pieces.MARK not in (t or ""))


def test_decode_inverts_encode(spark, texts):
    plain = [t.replace(pieces.MARK, "") if t else t for t in texts]
    rows = spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string")
    back = pieces.decode(pieces.encode(rows, PIECES), PIECES).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in enumerate(plain)}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.encode(none, PIECES).count() == 0 and token_counts.token_counts(none, BPE).count() == 0


def test_unigram_scores_pick_the_best_path():
    import itertools

    import numpy as np

    random.seed(2)
    words = sorted({"".join(random.choices("abc", k=random.randint(1, 4))) for _ in range(25)} | set("abc"))
    score = {w: -random.random() * len(w) for w in words}
    v = Vocabulary([tuple(map(ord, w)) for w in words], np.arange(len(words)), np.array([score[w] for w in words]), None, None, None)
    for _ in range(40):
        text = "".join(random.choices("abc", k=7))
        last, _ = v.segment(np.array([[ord(c) for c in text]]))
        got = sum(score[words[i]] for i in v.back(last)[0])
        best = -1e9
        for cuts in itertools.product([0, 1], repeat=6):
            parts, a = [], 0
            for i, c in enumerate([*cuts, 1], 1):
                if c:
                    parts.append(text[a:i])
                    a = i
            if all(p in score for p in parts):
                best = max(best, sum(score[p] for p in parts))
        assert got == pytest.approx(best)


def test_a_worker_holds_a_vocabulary_as_arrays_only():
    import public_tokenizers
    from lendframe.llm.lattice import piece_vocabulary

    vocabulary = piece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))[0]
    assert vocabulary.pairs is vocabulary.trees is vocabulary.rank is None
    assert vocabulary.table.seen.nbytes + vocabulary.merge.seen.nbytes <= 4 << 20
