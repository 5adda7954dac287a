import random

import pytest
from pyspark.sql import functions as F

from lendframe.operators import cache, serving
from lendframe.streaming import jobs

HOUR = 3600


def events(spark, rows):
    """Rows of (event_id, user_id, seconds)."""
    return spark.createDataFrame(rows, "event_id long, user_id long, s double").withColumn(
        "ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long"))).drop("s")


def by_hand(rows, ttl=24 * HOUR):
    until, out = {}, {}
    for event, user, s in sorted(rows, key=lambda r: (r[2], r[0])):
        out[event] = user in until and s < until[user]
        if not out[event]:
            until[user] = s + ttl
    return out


def got(df):
    return {r["event_id"]: r["cache_hit"] for r in df.collect()}


@pytest.fixture(scope="module")
def visits():
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, 4]), round(rng.random() * 20 * 24 * HOUR, 3)) for i in range(600)]
    # exact ends of a lifetime, ties, and long pauses
    rows += [(1000, 9, 0.0), (1001, 9, 24 * HOUR - 0.001), (1002, 9, 24.0 * HOUR), (1003, 9, 48.0 * HOUR),
             (1004, 9, 48.0 * HOUR), (1005, 9, 500.0 * HOUR), (1006, 9, 500.5 * HOUR)]
    return rows


def test_replay_equals_the_rule(spark, visits):
    rows = events(spark, visits)
    assert got(cache.replay(rows)) == by_hand(visits)


@pytest.mark.parametrize("ttl", [60, HOUR])
def test_replay_of_a_busy_key_with_short_lifetimes(spark, ttl):
    """One key, events all day, an outlier years later, and events before 1970."""
    rng = random.Random(8)
    rows = [(i, 1, round(rng.random() * 24 * HOUR, 3)) for i in range(1500)] + [(9000, 1, 4e8), (9001, 1, -5000.5), (9002, 1, -4990.0)]
    assert got(cache.replay(events(spark, rows), ttl=ttl)) == by_hand(rows, ttl)


def test_events_without_a_key_are_misses(spark):
    rows = [(1, None, 0.0), (2, None, 1.0), (3, 5, 0.0), (4, 5, 1.0)]
    assert got(cache.replay(events(spark, rows))) == {1: False, 2: False, 3: False, 4: True}


def test_replay_goes_on_from_earlier_misses(spark, visits):
    middle = 9.7 * 24 * HOUR
    early, late = [r for r in visits if r[2] < middle], [r for r in visits if r[2] >= middle]
    prior = cache.replay_misses(events(spark, early)).select("user_id", "_at")
    rows = events(spark, late)
    after = cache.replay_misses(rows, prior=prior)
    want = by_hand(visits)
    assert got(cache.mark_hits(rows, after)) == {e: want[e] for e, _, _ in late}


@pytest.mark.parametrize("ttl, span", [(600, 20_000), (600, 4_000), (61, 30_000), (5_000, 12_000)])
def test_replay_across_blocks(spark, ttl, span):
    """Few and many events a lifetime, equal times, whole seconds so that lifetimes end at events, and earlier misses."""
    rng = random.Random(ttl + span)
    rows = [(i, 1 + i % 4, float(rng.randrange(-span // 3, span))) for i in range(400)] + [(1000 + i, 9, i * ttl * 3.0) for i in range(40)]
    assert got(cache.replay(events(spark, rows), ttl=ttl)) == by_hand(rows, ttl)
    early, late = [r for r in rows if r[2] < span / 2], [r for r in rows if r[2] >= span / 2]
    prior = cache.replay_misses(events(spark, early), ttl=ttl).select("user_id", "_at")
    want = by_hand(rows, ttl)
    assert got(cache.replay(events(spark, late), ttl=ttl, prior=prior)) == {e: want[e] for e, _, _ in late}


def test_replay_of_repeated_rows(spark):
    """An event that stands twice misses or hits twice, and is not multiplied."""
    rows = [(i, 1, i * 7.0 * HOUR) for i in range(12)]
    twice = cache.replay(events(spark, rows + rows)).collect()
    want = by_hand(rows)
    assert sorted((r["event_id"], r["cache_hit"]) for r in twice) == sorted((e, want[e]) for e, _, _ in rows + rows)


def test_replay_of_events_without_a_time(spark):
    """A key with such an event has no first miss, other keys are not touched."""
    rows = [(1, 1, 0.0), (2, 1, None), (3, 2, 0.0), (4, 2, 1.0)]
    assert got(cache.replay(events(spark, rows))) == {1: True, 2: True, 3: False, 4: True}


def test_replay_shuffles_few_rows_again(spark, monkeypatch):
    """Only the places where a chain may enter a block are joined, round after round."""
    written = []

    def counted(df, *more, **named):
        out = whole(df, *more, **named)
        written.append(out.count())
        return out

    whole = cache.staged
    monkeypatch.setattr(cache, "staged", counted)
    rows = [(i, i % 10, i // 10 * 900.0) for i in range(10 * 4 * 100)]  # every quarter of an hour, for a hundred hours
    assert got(cache.replay(events(spark, rows), ttl=HOUR)) == by_hand(rows, HOUR)
    assert sum(written) < 1.2 * len(rows) and max(written) < len(rows) / 4


def test_replay_of_nothing(spark):
    assert cache.replay(events(spark, [])).count() == 0


def test_bucket_quantile_rule(spark):
    # 10 below .05, 10 in (.05, .1], none above
    row = spark.range(1).select(*[F.lit(n).alias(f"le_{i}") for i, n in enumerate([10, 20, 20, 20, 20, 20, 20])],
                                F.lit(20).alias("le_inf"))
    assert row.select(serving.bucket_quantile(0.5)).first()[0] == pytest.approx(0.05)
    assert row.select(serving.bucket_quantile(0.75)).first()[0] == pytest.approx(0.075)
    above = row.withColumn("le_inf", F.lit(100))
    assert above.select(serving.bucket_quantile(0.99)).first()[0] == 5.0


def test_latency_delta_over_hours(spark):
    rows = [(i, 1, 1000.0 * i) for i in range(12)] + [(100, 2, 5.0), (200, None, 1.0), (201, None, 9000.0)]
    df = events(spark, rows).withColumn("seconds", F.col("event_id") * 1.5)
    deltas = {r["event_id"]: r["delta"] for r in serving.latency_delta(df).collect()}
    assert deltas[0] is None and deltas[100] is None and deltas[200] is None and deltas[201] == 1.5
    assert all(deltas[i] == 1.5 for i in range(1, 12))


@pytest.fixture
def event_files(spark, tmp_path):
    folder = str(tmp_path / "events")
    for part in range(3):
        (spark.range(part * 200, part * 200 + 200).select(
            F.col("id").alias("event_id"),
            F.timestamp_micros(F.col("id") * 97_000_000).cast("timestamp_ntz").alias("ts"),
            (F.col("id") % 7).alias("user_id"),
            F.when(F.col("id") % 5 == 0, "error").otherwise("view").alias("event_type"),
            (F.col("id") * 13 % 490 + 0.5).alias("value"), F.lit("{}").alias("props"))
         .coalesce(1).write.mode("append").parquet(folder))
    return folder


@pytest.mark.parametrize("metric, keys", [
    (serving.request_rate, ["window_start", "endpoint"]),
    (serving.latency_quantiles, ["window_start", "endpoint"]),
    (serving.zone_totals, ["conf_zone"]),
])
def test_stream_equals_table(spark, event_files, metric, keys):
    stream = serving.requests(jobs.event_stream(spark, event_files, "*.parquet", files_per_batch=1))
    streamed = jobs.stream_metric(stream, metric, keys, "test")
    table = metric(serving.requests(spark.read.parquet(event_files).withColumn("ts", F.col("ts").cast("timestamp"))))
    assert sorted(map(tuple, streamed.select(table.columns).collect())) == sorted(map(tuple, table.collect()))


def test_stream_replay_equals_table(spark, event_files):
    stream = jobs.event_stream(spark, event_files, "*.parquet", files_per_batch=1)
    table = spark.read.parquet(event_files).withColumn("ts", F.col("ts").cast("timestamp"))
    ttl = 1800
    assert got(jobs.stream_replay(stream, ttl)) == got(cache.replay(table, ttl=ttl))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    folder = str(tmp_path / "late")

    def add(seconds):
        rows = [(i, s) for i, s in enumerate(seconds)]
        (spark.createDataFrame(rows, "event_id long, s long").select(
            "event_id", F.timestamp_micros(F.col("s") * 1_000_000).cast("timestamp_ntz").alias("ts"),
            F.lit(1).cast("long").alias("user_id"), F.lit("view").alias("event_type"),
            F.lit(1.0).alias("value"), F.lit("{}").alias("props")).coalesce(1).write.mode("append").parquet(folder))

    add([0, 10, 20000])
    add([20010])
    # the watermark of one micro-batch filters the rows of the next but one
    add([30, 40])
    stream = jobs.event_stream(spark, folder, "*.parquet", files_per_batch=1)
    counts = serving.request_rate(serving.requests(stream))
    out, query = jobs.run_available(counts, "late")
    assert jobs.late_rows(query) >= 1
    first = jobs.latest(spark, out, ["window_start", "endpoint"], counts.schema).filter(
        "window_start = '1970-01-01 00:00:00'").first()
    assert first["requests"] == 2


def test_request_stream_answers_every_request(spark, sample, tmp_path):
    """Copies are answered too, bad requests are set aside, and the plan holds no state."""
    from pyspark.ml import PipelineModel

    from lendframe.operators import scoring
    from lendframe.plans.cleaner import LoanCleaner
    from lendframe.plans.features import FeatureBuilderModel

    cleaner = LoanCleaner().fit(sample).for_inference()
    model = PipelineModel([cleaner, FeatureBuilderModel()._set(expenseFallback=20000.0)])
    raw = sample.unionByName(sample.limit(2)).unionByName(sample.limit(1).withColumn("requested_amount", F.lit(-5.0)))
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    assert "Deduplicate" not in model.transform(stream)._jdf.queryExecution().analyzed().toString()
    scored, refused = jobs.stream_requests(stream, model.transform, scoring.score_with_rules)
    valid, bad = jobs.judge_requests(raw)
    want = scoring.score_with_rules(model.transform(valid))
    assert sorted(scored.drop("batch").collect()) == sorted(want.collect()) and scored.count() == 12
    assert [r["problems"] for r in refused.collect()] == [["requested_amount"]] and bad.count() == 1


def test_one_file_is_scored_by_all_cores(spark, sample, tmp_path):
    """A file of one row group is one task of the scan; the work on its rows is dealt over more."""
    from lendframe.operators import scoring

    sample.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(sample.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    scored = jobs.stream_score(stream, scoring.score_with_rules)
    assert len(scored.inputFiles()) > 1
    assert sorted(scored.collect()) == sorted(scoring.score_with_rules(sample).collect())
    scored, _ = jobs.stream_requests(stream, lambda rows: rows, scoring.score_with_rules)
    assert len(scored.inputFiles()) > 1 and scored.count() == 10
