"""Cache-aside scoring: stored vectors where alive, computed ones elsewhere."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe import schema as S
from lendframe.operators import cache, scoring

_OWN = {*S.KEY_COLUMNS, "applied_at"}


class Served(NamedTuple):
    scored: DataFrame
    entries: DataFrame


def vector_columns(columns) -> list[str]:
    return [c for c in columns if c not in _OWN]


def feature_entries(features: DataFrame, written_at: Column | None = None) -> DataFrame:
    """Store entries of the latest feature vector per customer, with all digits."""
    return cache.batch_write(features, vector_columns(features.columns), written_at=written_at, exact=True)


def serve(requests: DataFrame, store: DataFrame, now: Column,
          compute: Callable[[DataFrame], DataFrame], vector: T.StructType,
          score: Callable[[DataFrame], DataFrame] | None = None) -> Served:
    """Scores of all requests with ``cache_hit``, and the entries to store.

    ``compute`` turns request rows into feature rows and runs on misses only;
    ``vector`` is the schema of its result.
    """
    score = score or (lambda rows: scoring.score_with_rules(rows, (*S.KEY_COLUMNS, "cache_hit")))
    fields = T.StructType([f for f in vector.fields if f.name not in _OWN])
    found = cache.lookup(requests, store, now)
    hits = found.filter("cache_hit").select(*S.KEY_COLUMNS, "cache_hit", "cached")
    missed = compute(found.filter(~F.col("cache_hit")).drop("cached", "cache_key"))
    scored = score(cache.restored(hits, fields)).unionByName(score(missed))
    return Served(scored, feature_entries(missed.drop("cache_hit"), now))
