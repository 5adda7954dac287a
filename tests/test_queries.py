"""A few registered queries per module against their SQL; ``run_check.py`` runs all."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from run_check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

NAMES = [
    "dedup_exact", "clean_training", "clean_inference", "cleaning_report", "audit_labels", "scan_validated",
    "explode_requests", "sink_train_test", "features_all", "one_hot", "score_rows", "batch_summary",
    "overlap_join_copies", "cache_upsert", "scenario_summary", "distribution_stats", "density", "ttest",
    "eval_classifier", "register_champion", "ecdf_distance", "latency_quantiles", "cache_replay",
    "cache_hit_rate", "latency_delta",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    assert compare(queries()[name](spark, FOLDER), oracle_sql()[name], db) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_returns_a_summary(spark):
    row = entry(spark).first()
    assert row["total_scored"] == row["auto_approve"] + row["human_review"] + row["auto_reject"] > 0
