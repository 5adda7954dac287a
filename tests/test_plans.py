"""Shapes of plans that must hold at any data size."""

import pytest
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.operators import cache, cleaning, drift, evaluation, leakage, profiling, ranks, sampling
from lendframe.plans.cleaner import clean
from lendframe.plans.features import add_features
from lendframe.staging import staged, staging_root


@pytest.fixture
def plan(capsys):
    def text(df, mode="simple"):
        capsys.readouterr()
        df.explain(mode)
        return capsys.readouterr().out

    return text


@pytest.fixture(scope="module")
def prepared(sample):
    return staged(cleaning.prepare(sample), "prepared")


def test_cleaning_and_features_are_one_narrow_pass(prepared, plan):
    text = plan(add_features(cleaning.project(prepared, cleaning.measure(prepared)), 1000.0))
    for node in ("Exchange", "Join", "Sort", "Python"):
        assert node not in text


def test_scan_reads_only_the_needed_columns(sample, plan):
    rows = staged(clean(sample), "clean")
    text = plan(rows.filter(F.col(S.TARGET_CLASS) == 1).select("monthly_salary"), "formatted")
    assert "ReadSchema: struct<monthly_salary:double,emi_eligibility:int>" in text
    assert "EqualTo(emi_eligibility,1)" in text


def test_copies_are_merged_before_the_shuffle(sample, plan):
    text = plan(cleaning.drop_exact_duplicates(sample))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_no_products_of_rows(sample, prepared, plan, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cleaned = clean(sample)
        scored = cleaned.select(F.lit("m").alias("model"), F.col(S.TARGET_CLASS).alias("label"),
                                (F.col("credit_score") / 900).alias("score"))
        frames = [
            profiling.cleaning_report(sample, cleaned), profiling.scenario_summary(cleaned),
            profiling.distribution_stats(cleaned), evaluation.eval_classifier(scored),
            leakage.overlap(cleaned, cleaned, S.REQUEST_COLUMNS),
            drift.drift_columns(cleaned, cleaned, S.REQUEST_COLUMNS),
        ]
        for df in frames:
            text = plan(df)
            assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_samples_are_filters(prepared, plan):
    """The split is a filter on a hash: neither side is shuffled or sorted."""
    rows = cleaning.encode_target(prepared)
    train, test = sampling.stratified_split(rows)
    for df in (train, test, sampling.class_sample(rows, 2)):
        text = plan(df)
        assert "Exchange" not in text and "Window" not in text


def test_hot_value_costs_one_row_per_task(spark):
    """A third of all rows hold one value, one class and one group."""
    n = 30_000
    df = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id") * 0.5).alias("value"))
    found = {r["key"]: r["quantile"] for r in ranks.exact_quantiles(df, [0.5]).collect()}
    assert found["hot"] == 7.0 and len(found) == 51
    hit = spark.range(9_000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user_id"),
        F.timestamp_micros(F.col("id") * 60_000_000).alias("ts"))
    replayed = cache.replay(hit, ttl=86400)
    # the busy key sees an event every three minutes for 9000 minutes: a miss per day begun
    assert replayed.filter("user_id = 1 and not cache_hit").count() == 7


class _Session:
    """A session with the given setting and master."""

    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_staging_uses_the_folder_of_the_session(spark):
    assert staging_root(_Session("hdfs://shared/dir/", "yarn")) == "hdfs://shared/dir"
    with pytest.raises(ValueError, match="share"):
        staging_root(_Session(None, "yarn"))
    own = staging_root(_Session(None, "local[2]"))
    assert own == staging_root(_Session(None, "local[2]"))
    out = staged(spark.range(5).toDF("x"), "five")
    assert out.count() == 5 and staging_root(spark) in out.inputFiles()[0]
