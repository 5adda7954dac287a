"""The registered queries on the smallest tables: against their SQL where there is one, else their columns and rows."""

import os

import duckdb
import pytest

from lendframe.llm.queries import QUERIES, SQL
from run_check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, db, name):
    assert compare(QUERIES[name](spark, FOLDER), SQL[name], db) is None


COLUMNS = {
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op7_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_sentencepiece": ["doc_id", "n_bytes", "n_tokens", "tokens", "round_trip"],
    "op9_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit", "fits_bytes"],
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_has_a_row_for_each_document(spark, name):
    got = QUERIES[name](spark, FOLDER)
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    assert got.columns == COLUMNS[name]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())


def test_passages_are_those_of_shared_words(spark):
    """Every text with 50 words in a row of an earlier one is found, and none without 25."""
    from lendframe.llm.chaining import words

    import pyarrow as pa

    got = {r.doc_id for r in QUERIES["op1_chaining"](spark, FOLDER).collect()}
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    hashes, offsets = words(pa.array([t for _, t in rows]))
    for n, found in ((50, True), (25, False)):
        first, repeats = {}, set()
        for (i, _), a, b in zip(rows, offsets, offsets[1:]):
            grams = [tuple(hashes[k:k + n].tolist()) for k in range(a, b - n + 1)]
            if any(g in first for g in grams):
                repeats.add(i)
            for g in grams:
                first.setdefault(g, i)
        assert repeats <= got if found else got <= repeats
