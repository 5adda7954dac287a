"""Connected components of a table of links, by alternating stars, without collecting links anywhere.

In each round every node hands its larger neighbours, then its smaller ones, to its smallest neighbour. Links get no
more, and after few rounds all nodes hang on the smallest node of their component. Minima are combined before the
shuffle, so a node with very many links costs no more than its links. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.staging import discard, staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v) with u > v to the links after one star step."""
    if large:
        around = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = links
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        least = least.withColumn("m", F.least("u", "m"))
        moved = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = around.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.filter("u != v").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that has a link to another one."""
    ordered = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    now = staged(ordered, "links")
    mark = _mark(now)
    while mark[0]:
        last, now = now, staged(_star(_star(now, True), False), "links")
        discard(last)
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    found.staged_path = now.staged_path
    return found
