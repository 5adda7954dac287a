"""The quality network: answers against a plain loop, gradients against differences, held-out accuracy, odd tables."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lendframe.llm import quality

FOLDER = "/root/testdata/sf0.01"
TEXTS = ["plain words here", "", "x" * 700, "ab " * 300, "é漢" * 90, "one more text " + "z$" * 40, None]


def plain_features(network, text):
    raw = (text or "").encode()
    n_half = -(-len(raw) // quality.HALF)
    out = np.zeros(2 * quality.FILTERS)
    if not n_half:
        return out
    padded = raw + bytes(n_half * quality.HALF - len(raw))
    # behind a text the next one's bytes may stand; the tests use one text at a time
    padded += bytes(quality.WIDTH + 8)
    best = []
    for h in range(n_half):
        answers = []
        for i in range(h * quality.HALF, (h + 1) * quality.HALF):
            a = network.bias.astype(float).copy()
            for j in range(quality.WIDTH):
                a += network.table[j, padded[i + j]]
            if padded[i] and any(i >= d and padded[i:i + 8] == padded[i - d:i - d + 8] for d in quality.BACK):
                a += network.repeat
            answers.append(a)
        best.append(np.max(answers, axis=0))
    chunks = [np.maximum(best[i], best[i + 1]) for i in range(n_half - 1)] or best
    chunks = np.maximum(np.array(chunks), 0)
    return np.append(chunks.mean(axis=0), chunks.max(axis=0))


def test_features_equal_plain_loop():
    network = quality.Network()
    for t in TEXTS:
        got = network.features(pa.array([t], pa.string()))[0]
        assert got == pytest.approx(plain_features(network, t), abs=1e-4)


def test_gradients_equal_differences():
    network = quality.Network()
    texts, labels = pa.array(TEXTS[:4]), np.array([1, 0, 1, 0], np.float32)

    def loss():
        network.pairs = None
        p = network.probability(texts)
        return -np.mean(np.where(labels == 1, np.log(p), np.log(1 - p)))

    rng = np.random.default_rng(0)
    for p, g in zip(network.parameters(), network.gradients(texts, labels)):
        flat_p, flat_g = p.reshape(-1), np.asarray(g).reshape(-1)
        some = np.flatnonzero(np.abs(flat_g) > 1e-3)
        for i in rng.permutation(some)[:6]:
            old = flat_p[i]
            flat_p[i] = old + 1e-3
            up = loss()
            flat_p[i] = old - 1e-3
            down = loss()
            flat_p[i] = old
            assert flat_g[i] == pytest.approx((up - down) / 2e-3, rel=0.1, abs=2e-3)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.report(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9


def test_odd_rows_and_tables(spark):
    docs = spark.createDataFrame([(None, None, 1), (None, "a" * 200_000, 2), (3, "", 3), (3, "", 3), (4, "ok text", 4)], "doc_id long, text string, value int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.report(docs, none).collect()] == [0.5] * 5
    some = spark.createDataFrame([(3, 1), (4, 0), (4, None), (None, 1)], "doc_id long, quality int")
    got = quality.report(docs, some).collect()
    assert len(got) == 5 and len({r.score for r in got if r.doc_id == 3}) == 1
    assert quality.report(spark.createDataFrame([], "doc_id long, text string"), some).count() == 0
