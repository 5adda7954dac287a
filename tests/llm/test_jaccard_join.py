"""Groups of similar documents against a comparison of all pairs, and components against union-find."""

import random
import re

import pytest

from lendframe.llm import jaccard_join
from lendframe.llm.components import components


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, size):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(docs, size=5, percent=75):
    sets = [shingle_set(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [(docs[i][0], len(sets[i]), docs[root(i)][0]) for i in range(len(docs))]


def corpus(seed):
    random.seed(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "漢"]
    base = [random.choices(vocab, k=random.randint(3, 120)) for _ in range(25)]
    passage = random.choices(vocab, k=40)
    docs = []
    for _ in range(160):
        w = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 1, 2, 4])):
            w[random.randrange(len(w))] = random.choice(vocab)
        if random.random() < 0.3:
            w = w[:20] + passage + w[20:60]
        text = random.choice([" ", "  ", "\n", "\t "]).join(w)
        docs.append(text.upper() if random.random() < 0.2 else text)
    docs += ["one two", "ONE  two", "one", "one", None, None, "", "", " \n ", "a a a a a a a a a a", "a a a a a", docs[0], docs[0], docs[1] + " ", "z " * 5000]
    random.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_all_pairs(spark, seed):
    docs = corpus(seed)
    rows = [(i, t, 5) for i, t in docs]
    random.shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int").repartition(4)
    assert sorted(map(tuple, jaccard_join.report(d).collect())) == brute(docs)


def test_common_shingles_change_costs_only(spark, monkeypatch):
    import numpy as np

    docs = corpus(3)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    rng = np.random.default_rng(1)
    monkeypatch.setattr(jaccard_join, "_estimates", lambda found: rng.integers(0, 3, 1 << 20).astype(np.float32) * 50)
    assert sorted(map(tuple, jaccard_join.report(d).collect())) == brute(docs)


def test_longer_prefixes_where_shingles_are_common():
    import numpy as np

    of = np.repeat([0, 1], 20)
    common = np.concatenate([np.zeros(20), np.full(20, 200.0)]).astype(np.float32)
    k, length = jaccard_join.prefix_lengths(of, common, np.array([20, 20]), 75)
    assert k[0] == 1 and length[0] == 6 and k[1] > 1 and length[1] == 5 + k[1]


def test_one_of_each(spark):
    docs = corpus(4)
    d = spark.createDataFrame([(i, t, f"r{i}") for i, t in docs], "doc_id long, text string, row string")
    left = jaccard_join.one_of_each(d)
    want = {i for (i, _), (_, n, c) in zip(docs, brute(docs)) if i == c}
    assert left.columns == d.columns
    got = left.collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want)
    assert all(r.text == dict(docs)[r.doc_id] and r.row == f"r{r.doc_id}" for r in got)


def test_null_and_repeated_ids(spark):
    t = "a b c d e f g h"
    d = spark.createDataFrame([(None, t), (None, t), (3, t), (3, "x y z q r s"), (3, "x y z q r s"), (5, None)], "doc_id long, text string")
    got = sorted(map(tuple, jaccard_join.report(d).collect()), key=repr)
    assert got == sorted([(None, 4, None)] * 2 + [(3, 4, None)] + [(3, 2, 3)] * 2 + [(5, 0, 5)], key=repr)


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.report(d).count() == 0 and jaccard_join.one_of_each(d).count() == 0


def test_components(spark):
    random.seed(1)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (500, None)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        if b is not None and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: root(i) for i in list(parent)}


def test_similar_sets_share_what_is_asked_for():
    import numpy as np

    rng = np.random.default_rng(2)
    met = 0
    for _ in range(3000):
        n = int(rng.integers(1, 40))
        x = rng.choice(200, n, replace=False)
        y = np.unique(np.append(rng.choice(x, max(1, n - int(rng.integers(0, 6))), replace=False), rng.choice(200, int(rng.integers(0, 5)), replace=False)))
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        met += 1
        sets, sizes, ks = [np.sort(x), np.sort(y)], np.array([len(x), len(y)]), rng.integers(1, 5, 2)
        need = -(-75 * sizes // 100)
        ks = np.minimum(ks, need)
        prefixes = [s[:size - w + k] for s, size, w, k in zip(sets, sizes, need, ks)]
        least = jaccard_join.least_shared(sizes[:1], ks[:1], sizes[1:], ks[1:], 75)[0]
        assert len(np.intersect1d(*prefixes)) >= least
    assert met > 500
