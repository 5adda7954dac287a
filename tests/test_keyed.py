"""Cache replay with keyed state: against the table form, across restarts, with late events."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendframe.operators import cache
from lendframe.staging import staging_path
from lendframe.streaming import jobs, keyed

TTL = 3600
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
START = dt.datetime(2024, 1, 1)


def events(spark, rows):
    """(id, minute, user) to events."""
    return spark.createDataFrame([(i, START + dt.timedelta(minutes=m), u, "click", 1.0, "{}") for i, m, u in rows], SCHEMA)


def arrive(spark, folder, rows):
    events(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def replay(spark, folder, **places):
    return keyed.keyed_replay(jobs.event_stream(spark, folder, "*.parquet", files_per_batch=1), ttl=TTL, **places)


@pytest.fixture
def utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_equals_the_table_form(spark, utc):
    first = [(i, i * 7 % 300, i % 4 if i % 10 else None) for i in range(80)]
    second = [(100 + i, 300 + i * 11 % 400, i % 5) for i in range(80)]
    folder = staging_path(spark, "events")
    arrive(spark, folder, first)
    arrive(spark, folder, second)
    hits, progress = replay(spark, folder)
    want = cache.replay(events(spark, first + second), ttl=TTL)
    assert {(r.event_id, r.cache_hit) for r in hits.collect()} == {(r.event_id, r.cache_hit) for r in want.collect()}
    assert progress.agg(F.sum("rows"), F.sum("late")).first()[1] == 0


def test_restart_goes_on_from_the_checkpoint_and_late_events_are_counted(spark, utc):
    folder = staging_path(spark, "events")
    places = {"checkpoint": staging_path(spark, "keyed-checkpoint"), "out": staging_path(spark, "keyed-out")}
    arrive(spark, folder, [(1, 0, 7), (2, 50, 7), (3, 55, 8)])
    replay(spark, folder, **places)
    # a new run: user 7 hits by the state of the first run, then its entry ends; event 9 comes two micro-batches late
    arrive(spark, folder, [(4, 59, 7), (5, 61, 7), (6, 500, 9)])
    arrive(spark, folder, [(10, 495, 8), (11, 500, None)])
    arrive(spark, folder, [(9, 100, 7)])
    hits, progress = replay(spark, folder, **places)
    found = {r.event_id: r.cache_hit for r in hits.collect()}
    assert found == {1: False, 2: True, 3: False, 4: True, 5: False, 6: False, 10: False, 11: False}
    assert progress.agg(F.sum("late")).first()[0] == 1
    # entries that ended before the watermark are gone from the store
    assert progress.orderBy(F.col("batch").desc()).first().held <= 4
