import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.operators import ranks

RANKS = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]


def frame(spark, groups):
    rows = [(k, None if v is None else float(v)) for k, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "key string, value double")


def quantiles(df, **options):
    return {(r["key"], r["probability"]): r["quantile"]
            for r in ranks.exact_quantiles(df, RANKS, **options).collect()}


@pytest.fixture
def groups():
    rng = np.random.RandomState(0)
    return {
        "normal": rng.randn(1500) * 1e4,
        "hot": np.concatenate([np.full(900, 42.0), rng.rand(300) * 100]),
        "tiny": rng.rand(200) * 1e-5,
        "ties": rng.randint(-3, 4, 500),
        "zeros": [0.0, -0.0, 0.0],
        "one": [7.25],
        "with_null": [None, 1.0, 4.0, None],
        "close": 50000 + rng.rand(400) * 1e-3,
        "large": rng.rand(50) * 1e15,
    }


@pytest.mark.parametrize("accuracy", [ranks._ACCURACY, 50])
def test_quantiles_equal_linear_interpolation(spark, monkeypatch, groups, accuracy):
    """Also with a coarse sketch, whose brackets hold many values."""
    monkeypatch.setattr(ranks, "_ACCURACY", accuracy)
    found = quantiles(frame(spark, groups))
    for key, values in groups.items():
        clean = [v for v in values if v is not None]
        for p in RANKS:
            assert np.isclose(found[key, p], np.quantile(clean, p), rtol=1e-12, atol=1e-12), (key, p)


def test_null_group_has_its_own_quantiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "key string, value double")
    assert quantiles(df)[None, 0.5] == 2.0


def test_all_null_or_empty_gives_no_rows(spark):
    assert quantiles(frame(spark, {"x": [None, None]})) == {}


def test_quantile_map(spark):
    rng = np.random.RandomState(1)
    data = rng.randn(700, 2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in data], "a double, b double")
    found = ranks.quantile_map(df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None).cast("double")}, (0.01, 0.5))
    assert ("none", 0.5) not in found
    for i, c in enumerate("ab"):
        for p in (0.01, 0.5):
            assert np.isclose(found[c, p], np.quantile(data[:, i], p), rtol=1e-12)


@pytest.mark.parametrize("name", ["close", "two_ends", "wide"])
def test_pieces_keep_the_order_and_are_even(spark, name):
    rng = np.random.RandomState(2)
    values = {"close": 1 - rng.rand(6000) * 1e-3, "two_ends": np.append(rng.rand(3000) * 1e-4, 1 - rng.rand(3000) * 1e-4),
              "wide": np.concatenate([rng.randn(1200) * 10.0 ** e for e in range(-8, 13, 5)])}[name]
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    rows = sorted((r.v, r._b) for r in ranks.in_pieces(df, ["k"], "v").collect())
    numbers = [b for _, b in rows]
    assert numbers == sorted(numbers)
    sizes = np.bincount(numbers)
    assert len(sizes) == ranks._PIECES and sizes.max() <= 2 * len(values) / ranks._PIECES + 1


def test_running_counts(spark):
    rng = np.random.RandomState(3)
    values = np.round(np.concatenate([rng.randn(400), np.zeros(300)]), 2)
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    counted = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    rows = {r["v"]: r for r in ranks.running_counts(counted, ["k"], "v", ["n"]).collect()}
    distinct = sorted(set(values + 0.0))
    for v, following in zip(distinct, [*distinct[1:], None]):
        assert rows[v]["n_upto"] == int((values <= v).sum())
        assert rows[v]["n_total"] == len(values)
        assert rows[v]["next_value"] == following


def test_quotas_are_exact_and_reproducible(spark):
    df = spark.range(900).select(
        "id", (F.col("id") % 10 < 7).cast("int").alias("y"),
        ranks.seeded_order(F.col("id"), 5).alias("o"))
    rows = df.collect()
    for quotas in ({0: 20, 1: 333}, {0: 0, 1: 1}, {0: 270, 1: 630}, {0: 9999, 1: 5}):
        cuts = ranks.quota_cuts(df, "y", "o", quotas)
        taken = {r["id"] for r in df.filter(ranks.within_quota("y", "o", cuts)).collect()}
        expected = set()
        for y, n in quotas.items():
            ordered = sorted((r for r in rows if r["y"] == y), key=lambda r: r["o"])
            expected |= {r["id"] for r in ordered[:n]}
        assert taken == expected


def test_global_rank_is_a_permutation(spark):
    df = spark.range(500).withColumn("o", ranks.seeded_order(F.col("id"), 1))
    rows = ranks.global_rank(df, "o", "r").collect()
    assert [r["r"] for r in sorted(rows, key=lambda r: r["o"])] == list(range(1, 501))


@pytest.fixture
def narrow_rounds(monkeypatch):
    """Sketches so coarse and windows so small that ranks are narrowed in several rounds."""
    monkeypatch.setattr(ranks, "_ACCURACY", 20)
    monkeypatch.setattr(ranks, "_RANKED", 4)


def test_selection_in_many_rounds(spark, groups, narrow_rounds):
    groups = {k: groups[k] for k in ("hot", "ties", "with_null", "one")} | {
        "far": np.concatenate([[-1e300, 1e300, 1e-300, -1e-300], np.logspace(-20, 20, 160)]),
               "edge": np.concatenate([np.full(500, 3.0), np.linspace(3.0000001, 3.1, 40), np.full(500, 3.2)])}
    rows = frame(spark, groups).cache()
    one = ranks.quantile_map(rows, {k: F.when(F.col("key") == k, F.col("value")) for k in groups}, RANKS)
    for key, values in groups.items():
        clean = [v for v in values if v is not None]
        for p in RANKS:
            assert np.isclose(one[key, p], np.quantile(clean, p), rtol=1e-12, atol=1e-12), (key, p)


def test_brackets_of_named_expressions_in_many_rounds(spark, groups, monkeypatch):
    """Brackets that hold too much are counted and bracketed again, also where they miss their rank."""
    monkeypatch.setattr(ranks, "_SKETCH", 20)
    monkeypatch.setattr(ranks, "_HELD", 4)
    monkeypatch.setattr(ranks, "_TURNED", 2)
    groups = {k: groups[k] for k in ("hot", "ties", "with_null", "one")} | {"far": np.logspace(-20, 20, 160)}
    rows = frame(spark, groups).cache()
    values = {k: F.when(F.col("key") == k, F.col("value")) for k in groups}
    keep, missed = ranks._rank_brackets, []

    def beside(source, few):
        # the first brackets lie beside their ranks: below them, or above
        wrong = [(h, q if missed else [q[0], q[0]] if i % 2 else [q[1], q[1]]) for i, (h, q) in enumerate(few)]
        missed.append(len(few))
        keep(source, wrong)

    monkeypatch.setattr(ranks, "_rank_brackets", beside)
    found = ranks.quantile_map(rows, values, RANKS)
    assert len(missed) > 1
    for key, held in groups.items():
        clean = [v for v in held if v is not None]
        for p in RANKS:
            assert np.isclose(found[key, p], np.quantile(clean, p), rtol=1e-12, atol=1e-12), (key, p)


def test_brackets_take_one_scan_for_all_columns(spark, monkeypatch):
    """No aggregate per column: those cost a reading of the rows for every few columns."""
    monkeypatch.setattr(ranks, "_aggregated", lambda *_: pytest.fail("an aggregate per column"))
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("a"), (-F.col("id")).cast("double").alias("b"))
    found = ranks.quantile_map(df, {"a": F.col("a"), "b": F.col("b")}, (0.5, 1.0))
    assert found == {("a", 0.5): 500.5, ("a", 1.0): 1000.0, ("b", 0.5): -500.5, ("b", 1.0): -1.0}


def test_groups_are_narrowed_by_pieces(spark, groups, narrow_rounds, monkeypatch):
    monkeypatch.setattr(ranks, "_PIECES", 8)
    found = quantiles(frame(spark, groups))
    for key, values in groups.items():
        clean = [v for v in values if v is not None]
        for p in RANKS:
            assert np.isclose(found[key, p], np.quantile(clean, p), rtol=1e-12, atol=1e-12), (key, p)


def test_many_groups_are_not_broadcast(spark, groups, monkeypatch):
    monkeypatch.setattr(ranks, "_BROADCAST_GROUPS", 3)
    found = quantiles(frame(spark, groups))
    assert all(np.isclose(found[k, 0.5], np.median([x for x in v if x is not None])) for k, v in groups.items())


def shuffled_children(df):
    """What stands below each shuffle of a plan."""
    lines = [line.strip(" :+-*") for line in df._jdf.queryExecution().executedPlan().toString().splitlines()]
    return [lines[i + 1] for i, line in enumerate(lines) if line.startswith("Exchange hashpartitioning")]


def test_only_counts_are_shuffled(spark, groups, monkeypatch):
    """Also where the planner would not broadcast by itself: below every shuffle stands a partial aggregate."""
    seen = []
    keep = ranks.staged

    def spy(df, name, **options):
        seen.append(df)
        return keep(df, name, **options)

    monkeypatch.setattr(ranks, "staged", spy)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        quantiles(frame(spark, groups))
        for df in seen:
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in text and "Window" not in text
            assert all("partial_" in child or "functions=[]" in child for child in shuffled_children(df)), text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(seen) >= 3
