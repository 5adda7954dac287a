"""Phrase mining against counting everything, and its scans against the rule of one full cycle."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lendframe.llm import phrases


def plain_counts(rows, most_words=4):
    found, totals = Counter(), Counter()
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, most_words + 1):
                for i in range(len(words) - k + 1):
                    found[lang, tuple(words[i:i + k])] += 1
    return found, {k: n for k, n in totals.items() if n}


def plain_ranking(rows, least, most, cover=80):
    found, totals = plain_counts(rows)
    candidates = {k: n for k, n in found.items() if n >= least and len(k[1]) > 1}
    longer = Counter()
    for (lang, words), n in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                key = lang, words[i:i + k]
                longer[key] = max(longer[key], n)
    out = defaultdict(list)
    for (lang, words), a in candidates.items():
        if longer[lang, words] and 100 * longer[lang, words] >= cover * a:
            continue
        cuts = [(found[lang, words[:k]], found[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((2000000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, x, y, totals[lang], -s)
                  for lang, rows_ in out.items() for i, (s, a, p, x, y) in enumerate(sorted(rows_)[:most], 1))


@pytest.fixture(scope="module")
def rows():
    random.seed(11)
    out = []
    for i in range(300):
        lang = random.choice(["en", "de", None, "en"])
        words = random.choices(["Of", "the", "new", "York", "Ünï", "a\x00b", "x|y"], [5, 5, 2, 2, 1, 1, 1], k=random.randint(0, 40))
        if random.random() < 0.4:
            words[3:3] = ["of", "the", "new", "york", "city"]
        out.append((lang, "".join(w + random.choice([" ", " ", "\t", ", ", ".", "\n", "  ", "\v"]) for w in words)))
    # a phrase that stands in few documents
    out += [("en", "late bird sings here")] * 40
    # one whose words reach the threshold in the second of three shards
    out += [("en", "scarce pair")] * 12
    return out + [("fr", None), (None, ""), ("de", "." * 50), ("en", "same of the same"), ("en", "same of the same"), ("und", "of the " * 50)]


def frame(spark, rows):
    made = [(i // 2 if i % 5 else None, lang, t, "p", 7) for i, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(made, "doc_id long, lang string, text string, phrase string, n int")


def test_ranking_equals_counting_everything(spark, rows):
    got = phrases.collocations(frame(spark, rows), least=8, most=30).collect()
    assert sorted(map(tuple, got)) == plain_ranking(rows, 8, 30)


def test_few_slots_only_count_more(spark, rows):
    """With 16 slots nearly all phrases share theirs: results stay."""
    got = phrases.collocations(frame(spark, rows), least=8, most=30, slot_bits=4).collect()
    assert sorted(map(tuple, got)) == plain_ranking(rows, 8, 30)


@pytest.mark.parametrize("shards", [1, 3])
def test_counts_for_other_cycles(spark, rows, shards):
    counts, totals = phrases.phrase_counts(frame(spark, rows), least=8, shards=shards)
    found, words = plain_counts(rows)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in counts.collect()} == {k: n for k, n in found.items() if n >= 8}
    assert {r.lang: r.total for r in totals.collect()} == words


def test_each_phrase_is_counted_over_one_full_cycle(rows):
    """A model of the scans: whatever the scan of activation, a phrase meets every shard once, and ends."""
    shards, bits = 3, 12
    parts = [rows[i::shards] for i in range(shards)]
    steps = [np.zeros(1 << bits, np.uint8) for _ in range(3)]
    seen, counts, last, scan = defaultdict(list), Counter(), 0, 0
    while scan < last + shards:
        scan += 1
        part = parts[(scan - 1) % shards]
        block = phrases.words_of(pa.array([t or "" for _, t in part]), pa.array([x or "und" for x, _ in part]))
        block = phrases.Block.of(**block.packed())
        slots = {}
        for made in phrases.shard_counts(block, scan, shards, 4, steps):
            for lang, phrase, tag, n in zip(made["lang"].to_pylist(), made["phrase"].to_pylist(), made["tag"].tolist(), made["n"].tolist()):
                seen[lang, phrase].append((scan, (tag >> 8) & 255))
                counts[lang, phrase] += n
                slots[lang, phrase] = tag & 255, tag >> 16
        for key, (words, slot) in slots.items():
            if counts[key] >= 8 and words <= 3 and not steps[words - 1][slot]:
                steps[words - 1][slot], last = scan, scan
    for scans in seen.values():
        assert len({since for _, since in scans}) == 1
        assert all(since < s <= since + shards for s, since in scans)
    starts = {since for (_, phrase), scans in seen.items() if len(phrase.split(" ")) == 2 for _, since in scans}
    assert len(starts) > 1  # lengths are interleaved: pairs begin at different scans
    found, _ = plain_counts(rows)
    assert all(counts[lang, " ".join(w)] == n for (lang, w), n in found.items() if n >= 8)


def test_scores_of_large_counts_are_exact(spark):
    big = 9_000_000_000_000_000
    counts = spark.createDataFrame([("x", "a", 1, 2 * big), ("x", "b", 1, big + 1), ("x", "a b", 2, big)], "lang string, phrase string, words int, n long")
    got = phrases.scored(counts).first()
    assert (got.a, got.l, got.r, got.score) == (big, 2 * big, big + 1, 2000000 * big // (3 * big + 1))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert phrases.collocations(none).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, None, None)], none.schema)).collect() == []


def test_shared_slots_do_not_begin_a_phrase_before_its_words(spark):
    """Slots of pairs are reached at once by other pairs, words only after some scans: a phrase counts from when both are there."""
    rng = random.Random(5)
    rows = [("en", " ".join(rng.choices("abcdefgh", k=30))) for _ in range(200)]
    for i in range(40):
        rows += [("en", f"late{i} bird{i} sings{i} here{i}")] * 12
    counts, _ = phrases.phrase_counts(frame(spark, rows), least=8, slot_bits=6)
    found, _ = plain_counts(rows)
    assert {(r.lang, r.phrase): r.n for r in counts.collect()} == {(lang, " ".join(w)): n for (lang, w), n in found.items() if n >= 8}
