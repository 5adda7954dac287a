"""Cut texts against a plain scan over all strings of the length."""

import hashlib
import random

import numpy as np
import pytest

from lendframe.llm import suffix_dedup


def brute(docs, length):
    """docs: (id, text) in order; report rows in that order."""
    seen, out = set(), []
    for i, t in docs:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, np.int64)
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if s in seen:
                gone[p] += 1
                gone[p + length if p + length < len(gone) else -1] -= 1
            seen.add(s)
        mask = np.cumsum(gone[:-1]) > 0
        kept = bytes(np.frombuffer(raw, np.uint8)[~mask])
        spans = int((np.diff(np.append(0, mask.astype(int))) == 1).sum())
        out.append((i, len(raw), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdeé ", k=random.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(random.randint(15, 60)) for _ in range(8)]
    docs = []
    for _ in range(70):
        parts = []
        for _ in range(random.randint(1, 5)):
            s = random.choice(shared)
            a = random.randint(0, len(s) // 2)
            parts += [text(random.randint(0, 20)), s[a:random.randint(a, len(s))]]
        docs.append("".join(parts))
    docs += [docs[3]] * 5 + [docs[4][:-7] + "x"] * 3 + ["", None, "ab" * 500, "a" * 700, "abc" * 400 + docs[5], "a" * 99, "a" * 100, "a" * 101,
                                                         "ab" * 60, "x" * 3 + "ab" * 55, docs[6] * 3, text(4000)]
    order = list(range(len(docs)))
    random.shuffle(order)
    return [docs[i] for i in order]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_report_equals_plain_scan(spark, seed):
    docs = list(enumerate(corpus(seed)))
    rows = [(i, t, "x") for i, t in docs]
    random.shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string").repartition(5)
    got = sorted(map(tuple, suffix_dedup.report(d).collect()))
    assert got == brute(docs, 100)


def test_null_and_repeated_ids(spark):
    t = corpus(9)
    docs = sorted([(None, t[0]), (None, t[0]), (4, t[0] + t[1]), (4, t[1]), (4, t[1]), (2, t[1]), (7, None)],
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(map(tuple, suffix_dedup.report(d).collect()), key=repr)
    assert got == sorted(brute(docs, 100), key=repr)


def test_texts_keep_other_columns(spark):
    d = spark.createDataFrame([(1, "é" * 80 + "tail", "a", 3), (2, "x" + "é" * 80, "b", 4), (3, None, None, None)],
                              "doc_id long, text string, row string, kept int")
    got = suffix_dedup.without_repeats(d).orderBy("doc_id").collect()
    assert d.columns == suffix_dedup.without_repeats(d).columns
    # strings of 100 bytes repeat inside the run of one letter, from its second byte pair on
    assert [(r.doc_id, r.row, r.kept) for r in got] == [(1, "a", 3), (2, "b", 4), (3, None, None)]
    assert got[1].text.startswith("x") and "é" * 50 not in got[1].text and got[2].text == ""


def test_suffix_order():
    rng = np.random.default_rng(0)
    for n in [*range(1, 40), 500]:
        for top in (1, 2, 4):
            t = rng.integers(1, top + 1, n)
            assert suffix_dedup.suffix_order(t).tolist() == sorted(range(n), key=lambda i: t[i:].tolist())


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.report(d).count() == 0
