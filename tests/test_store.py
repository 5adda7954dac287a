"""The keyed store: changes whole or not at all, and only in the buckets that they touch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lendframe.operators import cache
from lendframe.sources.store import FeatureStore
from lendframe.staging import staging_path


def entries(spark, ids, value, hour=0):
    rows = spark.createDataFrame([(f"C{i}" if i is not None else None, n, float(value)) for n, i in enumerate(ids)],
                                 "customer_id string, application_id long, x double")
    return cache.batch_write(rows, ["x"], written_at=F.lit(dt.datetime(2024, 1, 1, hour)))


@pytest.fixture
def store(spark):
    made = FeatureStore(spark, staging_path(spark, "store"), buckets=8)
    made.upsert(entries(spark, range(40), 1))
    return made


def values(store, version=None):
    return {r.digest: r.payload for r in store.read(version).collect()}


def files(store):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(f"{store.root}/data")
            for f in names if f.endswith(".parquet")}


def test_untouched_buckets_keep_their_files(spark, store):
    before, held = files(store), store.manifest()
    version = store.upsert(entries(spark, [3], 2))
    after, now = files(store), store.manifest()
    assert {f: t for f, t in after.items() if f in before} == before
    touched = {b for b in now if now[b][0] == version}
    assert len(touched) == 1 and all(now[b] == held[b] for b in now if b not in touched)
    assert all(f"version={version}/bucket={next(iter(touched))}/" in f for f in after if f not in before)
    assert len(values(store)) == 40 and sum("2.0" in v for v in values(store).values()) == 1
    # the version before is as it was
    assert all("1.0" in v for v in values(store, version - 1).values())


def test_a_change_without_its_manifest_is_not_seen(spark, store, monkeypatch):
    seen, held = values(store), store.manifest()
    monkeypatch.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
    changed = store._read(held)
    with pytest.raises(RuntimeError):
        store._replace(changed.limit(1), held, {0, 1})
    monkeypatch.undo()
    assert values(store) == seen and store.manifest() == held
    # the next change takes the place of what was left behind
    store.upsert(entries(spark, [5], 9))
    assert len(values(store)) == 40 and sum("9.0" in v for v in values(store).values()) == 1


def test_of_two_writers_one_fails(spark, store, monkeypatch):
    monkeypatch.setattr(FeatureStore, "versions", lambda self: [])
    with pytest.raises(Exception, match="(?i)exists"):
        store._replace(store._read({}), {}, {0})


def test_invalidate_expire_and_vacuum(spark, store):
    customers = spark.createDataFrame([("C1",), ("C2",), (None,), ("nobody",)], "customer_id string")
    assert store.invalidate(customers) == 2
    assert len(values(store)) == 38
    assert store.invalidate(customers) == 2 and store.upsert(entries(spark, [None], 1)) == 2
    store.upsert(entries(spark, [7, 8], 3, hour=20))
    life = dt.timedelta(days=1)
    store.expire(F.lit(dt.datetime(2024, 1, 1, 10) + life))
    assert len(values(store)) == 2
    store.vacuum(keep=1)
    assert len(store.versions()) == 1 and len(values(store)) == 2
    named = {f"version={v}/bucket={b}/" for b, (v, _) in store.manifest().items()}
    assert all(any(n in f for n in named) for f in files(store))
    # all gone
    store.expire(F.lit(dt.datetime(2030, 1, 1)))
    assert values(store) == {}
    assert len(FeatureStore(spark, staging_path(spark, "store")).read().collect()) == 0


def test_rows_of_a_staged_file_are_bounded(spark):
    """A well compressed table is read by several tasks, and comes back whole."""
    from lendframe.staging import staged

    back = staged(spark.range(1000).coalesce(1), "bounded", rows_per_file=100)
    assert len(back.inputFiles()) == 10 and back.rdd.getNumPartitions() > 1
    assert sorted(r.id for r in back.collect()) == list(range(1000))
