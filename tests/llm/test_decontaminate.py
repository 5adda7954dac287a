"""Matches with test items against a plain search for every window."""

import random
import re

import pytest

from lendframe.llm import decontaminate

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    out = []
    for i, t in docs:
        d, hit, ids = words(t), set(), set()
        for item, bt in items:
            b = words(bt)
            n = min(window, len(b))
            for j in range(len(b) - n + 1) if n else ():
                for k in range(len(d) - n + 1):
                    if d[k:k + n] == b[j:j + n]:
                        hit.update(range(k, k + n))
                        ids.add(str(item) if item is not None else "")
        out.append((i, len(d), len(hit), ",".join(sorted(ids))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data():
    random.seed(4)
    vocab = ["ab", "Cd", "é", "x1", "漢字", "to", "be", "zz"]
    text = lambda n: random.choice([" ", ", ", "\n"]).join(random.choices(vocab, k=n))
    items = [(k, text(random.randint(4, 30))) for k in range(12)] + [(20, "qq rr"), (21, "solo"), (22, None), (23, ""), (3, text(9)), (None, "qq rr ss tt")]
    docs = []
    for i in range(80):
        parts = [text(random.randint(0, 40))]
        for _ in range(random.randint(0, 2)):
            parts += [random.choice(items)[1] or "", text(5)]
        docs.append((i, " ".join(parts)))
    docs += [(200, None), (201, ""), (202, "Solo"), (203, "qq  RR!"), (None, "qq rr"), (5, docs[5][1]), (204, "ab " * 4000)]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_report_equals_plain_search(spark, data, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    docs, items = data
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, matches int")
    b = spark.createDataFrame(items, "item_id long, text string")
    from pyspark.sql import functions as F

    got = decontaminate.matches(d, b, window=6).select(
        "doc_id", "n_words", decontaminate.words_hit(F.col("matches")).alias("n_hit"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m.item_id))), ",").alias("items"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, 6)
    want = {(i, t) for (i, t), r in zip(docs, [brute([x], items, 6)[0] for x in docs]) if r[2] == 0}
    left = decontaminate.remove_affected(d, b, window=6)
    assert left.columns == d.columns and {(r.doc_id, r.text) for r in left.collect()} == want


def test_longest_matches_and_places(spark):
    d = spark.createDataFrame([(1, "x y A b c d e f g h q")], "doc_id long, text string")
    b = spark.createDataFrame([(7, "z a b c d e f g h")], "item_id long, text string")
    row = decontaminate.matches(d, b, window=4).first()
    assert [tuple(m) for m in row.matches] == [("7", 1, 2, 8)]


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontaminate.report(d, b).count() == 0
    assert tuple(decontaminate.report(one, b).first())[:4] == (1, 2, 0, 0)
