"""Vector links against all pairs, and recall on pairs that are just similar enough."""

import numpy as np
import pytest

from lendframe.llm import embedding_dedup


def brute(rows, least):
    """rows: (id, vector); ids are distinct."""
    n = len(rows)
    good = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v) for _, v in rows]
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                linked[i, j] = linked[j, i] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in np.flatnonzero(linked[i]):
                if label[j] < label[i]:
                    label[i], changed = label[j], True
    order = sorted(range(n), key=lambda i: rows[i][0])
    assert order == list(range(n))
    return [(rows[i][0], int(linked[i].sum()), rows[label[i]][0], label[i] == i) for i in range(n)]


def vectors(seed=0, n=150, dim=16, spread=0.02):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dim))
    out = [base[rng.integers(12)] + spread * rng.normal(size=dim) if rng.random() < 0.5 else rng.normal(size=dim) for _ in range(n)]
    return [v.astype(np.float32).astype(float).tolist() for v in out]


@pytest.fixture(params=[1024, 8])
def block(request, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", request.param)


def test_report_equals_all_pairs(spark, block):
    vs = vectors()
    vs += [vs[0], vs[0], vs[1], None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15,
           [2 * c for c in vs[0]], vs[0][:8], [1e30] + [0.0] * 15]
    rows = [(3 * i, v) for i, v in enumerate(vs)]
    d = spark.createDataFrame([(i, v, 9) for i, v in rows], "vec_id long, embedding array<float>, n_links int").repartition(4)
    got = sorted(map(tuple, embedding_dedup.report(d, recall=0.999999).collect()))
    assert got == brute(rows, 0.9)


def test_recall_of_pairs_that_are_just_similar_enough(spark):
    rng = np.random.default_rng(5)
    n, dim = 4000, 64
    a = rng.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(n, dim))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = rng.uniform(0.9001, 0.92, size=(n, 1))
    near = cosine * a + np.sqrt(1 - cosine ** 2) * b
    rows = [(i, v.tolist()) for i, v in enumerate(a)] + [(n + i, v.tolist()) for i, v in enumerate(near)]
    got = embedding_dedup.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    found = sum(r.n_links for r in got) / (2 * n)
    assert 0.93 <= found <= 1.0
    assert all(r.component_id in (r.vec_id, r.vec_id - n) for r in got)


def test_repeated_and_null_ids(spark):
    d = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.1]), (2, [0.0, 1.0]), (3, None)], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, embedding_dedup.report(d).collect()), key=repr)
    assert got == sorted([(None, 2, None, True), (None, 2, None, False), (2, 2, None, False), (2, 0, 2, True), (3, 0, 3, True)], key=repr)


def test_empty_table(spark):
    assert embedding_dedup.report(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_collision_chance():
    rng = np.random.default_rng(1)
    for distance in (0.4, 1.4):
        x = rng.normal(size=200_000) * distance
        b = rng.random(200_000) * 2
        assert np.mean(np.floor((x + b) / 2) == np.floor(b / 2)) == pytest.approx(embedding_dedup.collision(distance), abs=0.005)
