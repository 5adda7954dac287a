"""Registered queries with their comparison SQL, and the tables they share."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe import schema as S
from lendframe.operators import cache, cleaning, scoring, serving
from lendframe.plans.features import add_features, fit_expense_fallback
from lendframe.sources import applications
from lendframe.staging import VECTORS_PER_FILE, staged

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables derived from one data folder; each is written once per session and read
    back by the queries that need it, as the reports read the cleaned file."""

    _known: dict[tuple, "Tables"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in cls._known:
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    @classmethod
    def forget(cls) -> None:
        cls._known.clear()

    @property
    def applicants(self) -> DataFrame:
        return applications.applicants(self.spark, self.sf_dir)

    @property
    def copies(self) -> DataFrame:
        return applications.applicants_with_copies(self.spark, self.sf_dir)

    @property
    def events(self) -> DataFrame:
        return applications.events(self.spark, self.sf_dir)

    @property
    def requests(self) -> DataFrame:
        return serving.requests(self.events)

    @cached_property
    def prepared(self) -> DataFrame:
        return staged(cleaning.prepare(self.applicants), "prepared")

    @cached_property
    def stats(self) -> cleaning.CleaningStats:
        return cleaning.measure(self.prepared, training=True)

    @cached_property
    def kept(self) -> DataFrame:
        flagged = cleaning.missing_flags(self.prepared, self.stats.flag_gates)
        return cleaning.training_rows(flagged, training=True)

    @property
    def filled(self) -> DataFrame:
        return cleaning.fill_missing(self.kept, self.stats)

    @property
    def named(self) -> DataFrame:
        return cleaning.standardize_categories(self.filled, self.stats.modes)

    @property
    def ruled(self) -> DataFrame:
        return cleaning.apply_rules(self.named, self.stats)

    @cached_property
    def clean(self) -> DataFrame:
        return staged(cleaning.project(self.prepared, self.stats, True), "clean")

    @cached_property
    def fallback(self) -> float:
        return fit_expense_fallback(self.clean)

    @property
    def features(self) -> DataFrame:
        return add_features(self.clean, self.fallback)

    @property
    def scored(self) -> DataFrame:
        return scoring.score_with_rules(self.clean)

    @cached_property
    def misses(self) -> DataFrame:
        return staged(cache.replay_misses(self.events), "misses")

    @property
    def replayed(self) -> DataFrame:
        return cache.mark_hits(self.events, self.misses)

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        from lendframe.operators.sampling import stratified_split

        return stratified_split(self.features)

    @cached_property
    def encoded(self) -> tuple:
        """(encoder, train, test) with a feature vector, fitted on train only."""
        from lendframe.plans.encoder import LoanEncoder

        train, test = self.split
        keep = [*S.KEY_COLUMNS, S.TARGET_CLASS, S.TARGET_AMOUNT, "features"]
        encoder = LoanEncoder().fit(train)
        # estimators hold whole vectors, many times larger than their compressed files
        return (encoder, *[staged(encoder.transform(rows).select(*keep), name, rows_per_file=VECTORS_PER_FILE)
                           for rows, name in ((train, "train"), (test, "test"))])


def check(name: str, sql: str | None = None):
    """Register a query under ``name``; without SQL only its rows are checked."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables.of(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# whole numbers over 10^7: rounding to 6 places would fall on ties
_EXACT_PLACES = {"credit_x_income": 8}


def rounded(df: DataFrame, columns, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, _EXACT_PLACES.get(c, places)) for c in columns})


def sql_rounded(columns, places: int = 6) -> str:
    return ", ".join(f"round({c}, {_EXACT_PLACES.get(c, places)}) AS {c}" for c in columns)
