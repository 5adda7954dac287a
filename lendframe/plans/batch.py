"""The nightly job: scan, clean, features, encode, score, publish, watch drift."""

from pyspark.sql import DataFrame

from lendframe.operators import drift, scoring
from lendframe.plans.cleaner import clean
from lendframe.plans.features import add_features
from lendframe.plans.training import scored_with_models
from lendframe.sources.files import write_predictions
from lendframe.staging import staged


def featured_batch(rows: DataFrame, expense_fallback: float) -> DataFrame:
    return add_features(clean(rows, training=False), expense_fallback)


def score_features(featured: DataFrame, models=None) -> DataFrame:
    """Scores of feature rows; with no models the rules score them.

    ``models`` is (encoder, classifier, regressor).
    """
    if models is None:
        return scoring.score_with_rules(featured)
    encoder, classifier, regressor = models
    return scored_with_models(encoder.transform(featured), classifier, regressor)


def nightly(rows: DataFrame, root: str, date: str, run_id: str, expense_fallback: float,
            reference: DataFrame | None = None, models=None, again: bool = False) -> dict[str, DataFrame | str]:
    """Publishes predictions and returns their path, the summary and the drift row.

    ``again`` lets a retried run replace what its earlier attempt published.
    """
    if rows.isEmpty():
        return {"skipped": "input is empty"}
    featured = featured_batch(rows, expense_fallback)
    if reference is not None:
        # written once, for the scores and for the drift check
        featured = staged(featured, "features")
    scored = staged(score_features(featured, models), "scored")
    out = {"path": write_predictions(scored, root, date, run_id, again=again),
           "summary": scoring.batch_summary(scored)}
    if reference is not None:
        out["drift"] = drift.guarded_drift(rows.sparkSession, lambda: reference, lambda: featured)
    return out
