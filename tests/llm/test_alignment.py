"""Alignment and its pair counts against plain Python with the libraries that own the vocabularies."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lendframe.llm import alignment
from lendframe.llm.encoders import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    """The rows of the operator by two passes over dictionaries."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    letters, names = byte_letters(), {i: t for t, i in first.get_vocab().items()}
    a_bytes = lambda i: bytes(letters[c] for c in names[i])
    b_bytes = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    held, documents = [], Counter()
    for doc_id, text in rows:
        source = (" " + text).encode() if text else b""
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        if not text or b"".join(map(a_bytes, a)) != source or b"".join(map(b_bytes, b)) != source:
            held.append((doc_id, None, None, None, None))
            continue
        ends_a, ends_b = (np.cumsum([len(f(i)) for i in ids]).tolist() for f, ids in ((a_bytes, a), (b_bytes, b)))
        both, groups, i, j = set(ends_a) & set(ends_b), [], 0, 0
        for end in sorted(both):
            x, y = i, j
            while i < len(a) and ends_a[i] <= end:
                i += 1
            while j < len(b) and ends_b[j] <= end:
                j += 1
            groups.append((a[x:i], b[y:j]))
        links = Counter((p, q) for xs, ys in groups for p in xs for q in ys)
        documents.update(links.keys())
        held.append((doc_id, a, b, groups, links))
    most = Counter()
    for (p, _), n in documents.items():
        most[p] = max(most[p], n)
    out = []
    for doc_id, a, b, groups, links in held:
        if a is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), sum(links.values()), sum(n for k, n in links.items() if documents[k] == most[k[0]]),
                    sum(n * documents[k] for k, n in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def rows():
    random.seed(21)
    words = ["the", "Thinking", "über", "1234", "don't", "漢字", "<|endoftext|>", "</s>", "\n", "\t", "😀", "naïve"]
    made = [" ".join(random.choices(words, k=random.choice([1, 4, 30, 200]))) for _ in range(60)]
    # long runs that the two sides cut differently, blanks, marks that cannot be told from spaces, bytes
    made += ["x" * 3000, "123456789" * 300, " " * 700, "a▁b", "\x00\r\n", "same words here", "same words here", "ab" * 2000]
    return [(None if i % 11 == 5 else i // 2, t) for i, t in enumerate(made)] + [(900, None), (901, "")]


key = lambda r: (r[0] is None, r[0] or 0, r[1:])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, n_a int, radix string").repartition(3)


def test_rows_equal_plain_counting(spark, rows):
    got = alignment.alignments(frame(spark, rows), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)


def test_small_blocks_runs_and_groups(spark, rows, monkeypatch):
    """Many runs of a radix: merged in rounds, dealt to salted parts, links in slices."""
    for name, value in (("TEXT_BYTES", 2000), ("GROUP_BYTES", 4000), ("GROUP_BLOCKS", 2), ("FAN_IN", 2), ("RUN_ROWS", 16),
                        ("HELD_ROWS", 64), ("LINKS", 100), ("LISTED", 50)):
        monkeypatch.setattr(alignment, name, value)
    small = rows[:30] + rows[-10:]
    got = alignment.alignments(frame(spark, small), A, B).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain(small), key=key)


def test_merge_counts_each_pair_once(monkeypatch):
    monkeypatch.setattr(alignment, "RUN_ROWS", 7)
    monkeypatch.setattr(alignment, "HELD_ROWS", 20)
    rng = np.random.default_rng(4)
    want, runs = Counter(), []
    for _ in range(23):
        pairs = np.unique(rng.integers(0, 400, rng.integers(1, 120)))
        n = rng.integers(1, 9, len(pairs))
        want.update(dict(zip(pairs.tolist(), n.tolist())))
        runs.append(alignment.run_of(pairs, n=n))
    stretches = list(alignment.merged(runs))
    assert len(stretches) > 3
    keys = np.concatenate([k for k, _ in stretches])
    assert (np.diff(keys) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([n for _, n in stretches]).tolist())) == dict(want)
    assert list(alignment.merged([])) == []
    again = list(alignment.merged([alignment.joined_run(iter(stretches))]))
    assert np.array_equal(np.concatenate([k for k, _ in again]), keys)


def test_best_is_known_across_stretches():
    b = alignment.B_BITS
    pairs = np.array([(1 << b) | 5, (1 << b) | 6, (1 << b) | 7, (2 << b) | 1, (2 << b) | 9])
    counts = np.array([3, 8, 8, 1, 1])
    for cut in range(1, 5):
        got = list(alignment.with_best(iter([(pairs[:cut], counts[:cut]), (pairs[cut:], counts[cut:])])))
        assert np.concatenate([best for _, _, best in got]).tolist() == [False, True, True, True, True]
        assert np.concatenate([k for k, _, _ in got]).tolist() == pairs.tolist()


def test_empty_table(spark):
    assert alignment.alignments(spark.createDataFrame([], "doc_id string, text string"), A, B).collect() == []
