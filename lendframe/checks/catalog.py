"""All registered queries; importing the modules registers them."""

from pyspark.sql import DataFrame, SparkSession

from lendframe.checks import (  # noqa: F401
    cleaning, features, loading, models, profile, serving,
)
from lendframe.checks.registry import QUERIES, SQL, Tables  # noqa: F401
from lendframe.operators import scoring
from lendframe.plans.cleaner import clean
from lendframe.sources.applications import applicants


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.batch_summary(scoring.score_with_rules(clean(applicants(spark, sf_dir), training=False)))
