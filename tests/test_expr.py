import math

import pytest
from pyspark.sql import functions as F

from lendframe.functions import expr as X
from lendframe.functions import pvalues


def column(spark, kind, values, build):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in sorted(frame.select("i", build(F.col("x")).alias("y")).collect())]


def test_currency_and_null_texts(spark):
    texts = ["₹1,200", "Rs 500", "rs.70", " 12% ", "$9", "N/A", "None", "-", "", None, " nan "]
    assert column(spark, "string", texts, X.strip_currency) == [
        "1200", "500", ".70", "12", "9", None, None, None, None, None, None]


def test_numbers_are_read_strictly(spark):
    texts = ["12", " 12.5 ", "-3", "+.5", "1e3", "12d", "12f", "1.0.0", "inf", "NaN", "1e999", "0x10", "", None]
    assert column(spark, "string", texts, X.to_number) == [
        12.0, 12.5, -3.0, 0.5, 1000.0] + [None] * 9


def test_title_case_follows_every_non_letter(spark):
    texts = ["post-graduate", "HIGH school", "o'neil", "  a1b", "", None]
    assert column(spark, "string", texts, X.title_case) == [t.title() if t is not None else None for t in texts]


def test_strip_takes_all_white_space(spark):
    assert column(spark, "string", ["\t a b  \n", "x"], X.strip) == ["a b", "x"]


def test_clip_keeps_null(spark):
    values = [None, -1.0, 0.5, 7.0]
    assert column(spark, "double", values, lambda c: X.clip(c, 0.0, 1.0)) == [None, 0.0, 0.5, 1.0]
    assert column(spark, "double", values, lambda c: X.clip(c, low=0.0)) == [None, 0.0, 0.5, 7.0]


def test_salary_brackets_are_right_closed(spark):
    values = [None, -5.0, 0.0, 0.01, 20000.0, 20000.5, 100000.0, 100001.0]
    labels = [None, None, None, "0-20k", "0-20k", "20-40k", "80-100k", "100k+"]
    assert column(spark, "double", values, X.salary_bracket) == labels
    for label in ("0-20k", "20-40k", "80-100k", "100k+"):
        inside = column(spark, "double", values, lambda c: X.in_salary_bracket(c, label))
        assert [bool(x) for x in inside] == [x == label for x in labels]


def test_credit_bands_between_whole_scores(spark):
    values = [None, -1.0, 0.0, 599.0, 599.5, 649.5, 749.0, 749.5, 900.0, 901.0]
    assert column(spark, "double", values, X.credit_band) == [
        None, None, "Poor", "Poor", "Fair", "Good", "Good", "Excellent", "Excellent", None]


def test_zone_ties_go_to_review(spark):
    values = [0.850001, 0.85, 0.4, 0.399999]
    assert column(spark, "double", values, X.zone) == [
        "auto_approve", "human_review", "human_review", "auto_reject"]


def test_ratio_by_zero_is_null(spark):
    assert column(spark, "double", [0.0, 2.0, None], lambda c: X.ratio(F.lit(1.0), c)) == [None, 0.5, None]


@pytest.mark.parametrize("fn, args, expected", [
    (pvalues.t_tail, (2.0, 10), 0.07338803477),
    (pvalues.t_tail, (0.0, 5), 1.0),
    (pvalues.chi2_tail, (3.841458820694124, 1), 0.05),
    (pvalues.chi2_tail, (18.307038053275146, 10), 0.05),
    (pvalues.normal_two_sided_tail, (1.959963984540054,), 0.05),
    (pvalues.kolmogorov_tail, (1.3580986393225505,), 0.05),
])
def test_tail_probabilities(fn, args, expected):
    assert math.isclose(fn(*args), expected, rel_tol=1e-7)


def test_tail_of_infinite_statistic_is_zero():
    assert pvalues.chi2_tail(math.inf, 3) == 0.0
