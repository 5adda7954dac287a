"""Labels are dealt by numbers, as the whole texts would deal them."""

import hashlib

from pyspark.sql import functions as F

from lendframe.operators import sampling


def test_labels_are_ranked_by_numbers(spark):
    rows = spark.range(500).select(F.col("id").alias("application_id"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    dealt = sampling.permute_labels(rows, "y", 3)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert any("_key" in line for line in sorts) and not any("_order" in line for line in sorts)
    # the labels that plain sorting by the whole texts deals
    def order(seed):
        return sorted(range(500), key=lambda i: hashlib.sha256(f"{i}:{seed}".encode()).hexdigest())

    labels = [int(i % 4 == 0) for i in order(3 + 7919)]
    assert {r.application_id: r.y for r in dealt.collect()} == dict(zip(order(3), labels))
