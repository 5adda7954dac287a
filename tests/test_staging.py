"""What is written on the way, how, and that it does not stay."""

import os
import time

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from lendframe import staging
from lendframe.llm import components, jaccard_join

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_wide_stages_are_written_by_small_methods(spark, monkeypatch):
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *args, **options: seen.append(spark.conf.get(LIMIT, None)) or write(self, *args, **options))
    assert staging.staged(spark.range(3), "rows").count() == 3
    assert seen == ["8000"] and spark.conf.get(LIMIT, None) is None
    with staging.small_methods(spark):
        with pytest.raises(ZeroDivisionError), staging.small_methods(spark):
            1 / 0
        assert spark.conf.get(LIMIT) == "8000"
    assert spark.conf.get(LIMIT, None) is None
    spark.conf.set(LIMIT, "9000")
    try:
        staging.staged(spark.range(3), "rows")
        assert seen[1] == "9000" == spark.conf.get(LIMIT)
    finally:
        spark.conf.unset(LIMIT)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle" in files.apply(i).getName() for i in range(files.size()))


def test_shuffle_files_of_written_tables_go(spark):
    staging.release(spark)
    kept = staging.staged(spark.range(2000).repartition(7, "id"), "dealt")
    before = shuffle_files(spark)
    staging.release(spark)
    until = time.time() + 20
    while shuffle_files(spark) >= before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) < before and kept.count() == 2000


def written(spark):
    root = staging.staging_root(spark)
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_temporary_tables_go(spark):
    before = written(spark)
    with staging.temporary():
        staging.staged(spark.range(3), "inner")
        assert len(written(spark) - before) == 1
    assert written(spark) == before


def test_rounds_leave_one_table(spark):
    before = written(spark)
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    found = components.components(links)
    assert len(written(spark) - before) == 1
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(41)}


def test_join_leaves_texts_and_components_only(spark):
    before = written(spark)
    near = " ".join(f"w{i}" for i in range(40))
    rows = [(1, near), (2, near + " more"), (3, "other words " * 9), (4, near + " else"), (5, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in jaccard_join.one_of_each(docs).collect()} == {1, 3}
    assert sorted(name.rsplit("-", 1)[0] for name in written(spark) - before) == ["links", "texts"]
