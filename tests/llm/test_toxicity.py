"""Toxicity scores: counts against plain ones, held-out accuracy on texts with planted words, and odd tables."""

import os
import random
import zlib

import numpy as np
import pytest

from lendframe.llm import toxicity
from lendframe.llm.folds import logistic

FOLDER = "/root/testdata/sf0.01"


def corpus(n, seed=1):
    random.seed(seed)
    vocab = ["".join(random.choices("abcdefgh", k=random.randint(3, 7))) for _ in range(2000)]
    docs, labels = [], []
    for i in range(n):
        words = random.choices(vocab, k=random.randint(5, 120))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(1 + len(words) // 30):
                words.insert(random.randrange(len(words) + 1), random.choice(["Fool", "creep", "zounds"]))
        docs.append((i, " ".join(words), "en"))
        if i % 3 == 0 or random.random() < 0.5:
            labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus(900)
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int"), docs, dict(labels)


def test_held_out_texts(tables):
    d, l, docs, labels = tables
    got = {r.doc_id: r for r in toxicity.report(d, l).collect()}
    assert len(got) == len(docs)
    for i, _, _ in docs:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i].predicted == (got[i].score >= 0.5)
    held = [i for i, _, _ in docs if got[i].held_out]
    right = np.mean([got[i].predicted == (i % 6 == 0) for i in held])
    assert right > 0.97


def test_counts_are_those_of_all_teaching_documents(tables, monkeypatch):
    d, l, docs, labels = tables
    model = toxicity.fit(d, l)
    block = model.block(0)
    teach = [(t.lower().split(), labels[i]) for i, t, _ in docs if i in labels and zlib.crc32(str(i).encode()) % 5]
    words = sorted({w for ws, _ in teach for w in ws})
    import pyarrow as pa

    _, hashes, _ = toxicity.tokens(pa.array(words))
    at = block.find[1].find(hashes, -1)
    for w, k in zip(words, at.tolist()):
        toxic, ordinary = (sum(w in ws for ws, y in teach if y == c) for c in (1, 0))
        assert (k >= 0) == (toxic >= toxicity.LEAST_DOCUMENTS)
        if k >= 0:
            assert (block.toxic[1][k], block.ordinary[1][k]) == (toxic, ordinary)
    whole = {r.row.doc_id: r.score for r in model.scored(d).collect()}
    model.blocks = 3
    parts = {r.row.doc_id: r.score for r in model.scored(d).collect()}
    assert parts == pytest.approx(whole)


def test_odd_rows_and_tables(spark, tables):
    _, l, _, _ = tables
    odd = spark.createDataFrame([(None, None, "a"), (None, "fool " * 3000, "b"), (1, "", "c"), (1, "", "c"), (2, " \n", "d")],
                                "doc_id long, text string, row string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.report(odd, none).collect()] == [0.5] * 5
    assert toxicity.ordinary_only(odd, l).count() == 5 or toxicity.ordinary_only(odd, l).columns == odd.columns
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.report(empty, l).count() == 0
    nulls = spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 0)], "doc_id long, toxic int")
    assert toxicity.report(odd, nulls).count() == 5


def test_filter_keeps_clean_documents(tables):
    d, l, docs, _ = tables
    left = {r.doc_id for r in toxicity.ordinary_only(d, l).collect()}
    clean = [i for i, _, _ in docs if i % 6]
    assert len(left & set(clean)) >= 0.99 * len(clean) and len(left) < 0.87 * len(docs)


def test_logistic_recovers_a_curve():
    rng = np.random.default_rng(0)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    assert logistic(x[:, None], y) == pytest.approx([2, -1], abs=0.2)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_given_labels(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.report(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93


def test_scores_are_those_of_all_counts(tables):
    """Every text's excess by plain counting of all words and pairs, those of a single document too."""
    import math
    from collections import Counter

    import pyarrow as pa

    d, l, docs, labels = tables
    block = toxicity.fit(d, l).block(0)
    counts = [(Counter(), Counter()), (Counter(), Counter())]  # of words and pairs: toxic, ordinary
    for i, t, _ in docs:
        if i in labels and zlib.crc32(str(i).encode()) % 5:
            ws = t.lower().split()
            for of, found in zip(counts, (ws, zip(ws, ws[1:]))):
                of[1 - labels[i]].update(set(found))
    smooth = []
    for of in counts:
        sizes = [max(sum(c.values()), 1) for c in of]
        once, twice = ([sum(n == k for n in c.values()) for c in of] for k in (1, 2))
        off = [a / (a + 2 * b) if a and b else 0.75 for a, b in zip(once, twice)]
        both = max(sum(sizes), 1)
        rest = min(max(sum(min(x, 1) * (a + 2 * b) for x, a, b in zip(off, once, twice)) / both, 0.05), 0.9)
        smooth.append((sizes, off, rest, both + 0.5 * max(len(set(of[0]) | set(of[1])), 1)))

    def likelihoods(k, key, lower):
        sizes, off, rest, total = smooth[k]
        n = [c[key] for c in counts[k]]
        return [(1 - rest) * max(c - x, 0) / size + rest * (sum(n) + 0.5) / total * w for c, x, size, w in zip(n, off, sizes, lower)]

    def excess(ws):
        out = 0.0
        for k, w in enumerate(ws):
            of_word = likelihoods(0, w, (1, 1))
            pair = (ws[k - 1], w) if k else None
            if pair in counts[1][0] or pair in counts[1][1]:
                mean = sum(of_word) / 2
                of_word = likelihoods(1, pair, [x / mean for x in of_word])
            out += max(math.log(of_word[0]) - math.log(of_word[1]) - toxicity.MARGIN, 0)
        return out

    texts = [t for _, t, _ in docs[:300]]
    n, got = block.excess(pa.array(texts))
    assert n.tolist() == [len(t.split()) for t in texts]
    assert got == pytest.approx([excess(t.lower().split()) for t in texts])
    assert sum(c == 1 for c in counts[0][0].values()) > 20
