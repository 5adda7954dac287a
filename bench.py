"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every run starts from the raw tables: nothing derived is kept from one query or
repetition to the next. The better of two repetitions counts.
"""

import json
import os
import time

from lendframe.checks.registry import Tables
from lendframe.operators import cache, drift, evaluation, leakage, profiling, scoring, serving
from lendframe.plans.batch import featured_batch, score_features
from lendframe.plans import training
from lendframe.plans.cleaner import LoanCleaner, clean
from lendframe.plans.features import FeatureBuilder, FeatureBuilderModel
from lendframe.session import local_session
from lendframe import schema as S

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def clean_training(t):
    return clean(t.applicants, training=True)


def clean_inference_scored(t):
    return score_features(featured_batch(t.applicants, 20000.0))


def features(t):
    return FeatureBuilder().fit(t.clean).transform(t.clean)


def batch_summary(t):
    return scoring.batch_summary(t.scored)


def profile(t):
    return profiling.distribution_stats(t.clean)


def correlation(t):
    return profiling.correlation_matrix(t.clean)


def audit_profile(t):
    return profiling.audit_profile(t.prepared)


def auc(t):
    return evaluation.eval_classifier(t.clean.selectExpr(
        "'credit' AS model", f"{S.TARGET_CLASS} AS label", "credit_score / 900 AS score"))


def overlap(t):
    return leakage.overlap(*t.split, S.REQUEST_COLUMNS)


def drift_raw(t):
    return drift.drift_columns(t.clean.filter("application_id % 2 = 0"),
                               t.clean.filter("application_id % 2 = 1"), S.REQUEST_COLUMNS)


def drift_layers(t):
    return drift.drift_layers(t.features.filter("application_id % 2 = 0"), t.features.filter("application_id % 2 = 1"))


def train_logreg(t):
    _, train, test = t.encoded
    return training.logistic_regression().fit(train).transform(test)


def train_forest(t):
    _, train, test = t.encoded
    return training.random_forest().fit(train).transform(test)


def train_boosted(t):
    _, train, test = t.encoded
    return training.boosted_trees().fit(train).transform(test)


def single_request(t):
    """One raw request through fitted cleaning, features and scoring; the statistics are fitted before."""
    return scoring.score_with_rules(t.request_model(t.one_request))


def request_rate(t):
    return serving.request_rate(t.requests)


def latency_quantiles(t):
    return serving.latency_quantiles(t.requests)


def cache_replay(t):
    return cache.replay(t.events)


# what each query reads; tables it starts from are made before its clock starts
QUERIES = {
    "clean_training": (clean_training, []),
    "clean_inference_scored": (clean_inference_scored, []),
    "audit_profile": (audit_profile, ["prepared"]),
    "features": (features, ["clean"]),
    "batch_summary": (batch_summary, ["clean"]),
    "profile": (profile, ["clean"]),
    "correlation": (correlation, ["clean"]),
    "auc": (auc, ["clean"]),
    "overlap": (overlap, ["clean", "fallback"]),
    "drift_raw": (drift_raw, ["clean"]),
    "drift_layers": (drift_layers, ["clean", "fallback"]),
    "train_logreg": (train_logreg, ["encoded"]),
    "train_forest": (train_forest, ["encoded"]),
    "train_boosted": (train_boosted, ["encoded"]),
    "single_request": (single_request, ["request_model", "one_request"]),
    "request_rate": (request_rate, []),
    "latency_quantiles": (latency_quantiles, []),
    "cache_replay": (cache_replay, []),
}


def main():
    spark = local_session(name="bench")
    start = Tables.of(spark, SF_DIR)
    applications, events = start.applicants.count(), start.events.count()
    shared = Tables(spark, SF_DIR)
    cleaner = LoanCleaner().fit(shared.applicants).for_inference()
    builder = FeatureBuilderModel()._set(expenseFallback=shared.fallback)
    raw = shared.applicants.limit(1)
    shared.one_request = spark.createDataFrame(raw.collect(), raw.schema)
    shared.request_model = lambda rows: builder.transform(cleaner.transform(rows))
    seconds = {}
    for name, (query, needs) in QUERIES.items():
        best = None
        for _ in range(REPEATS):
            tables = Tables(spark, SF_DIR)
            for need in needs:
                tables.__dict__[need] = getattr(shared, need)
            begin = time.perf_counter()
            query(tables).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begin
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "applications": applications, "events": events,
        "cleaned_rows_per_minute": round(applications / seconds["clean_training"] * 60),
        "scored_rows_per_minute": round(applications / seconds["clean_inference_scored"] * 60),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
