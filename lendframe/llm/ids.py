"""One whole number for each row, in the order of its id, whatever the id column holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe.staging import staged


def keyed(rows: DataFrame, id_column: str, value_column: str) -> DataFrame:
    """``rows`` as columns ``uid`` long, ``id``, ``value`` and ``row`` (a struct of all columns but the value).

    ``uid`` is the id itself where ids are distinct whole numbers. Else (null or repeated ids, or ids of another
    type) the rows are sorted by id, nulls first, and value, numbered, and written once: repeated rows are rows of
    their own, in a fixed order.
    """
    others = [F.col(f"`{c}`") for c in rows.columns if c != value_column]
    shaped = rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{value_column}`").alias("value"),
                         F.struct(*others).alias("row"))
    whole = isinstance(shaped.schema["id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    if whole and not shaped.groupBy("id").count().filter("count > 1 OR id IS NULL").head(1):
        return shaped.select(F.col("id").cast("long").alias("uid"), "id", "value", "row")
    numbered = shaped.orderBy(F.col("id").asc_nulls_first(), F.col("value").asc_nulls_first())
    return staged(numbered.select(F.monotonically_increasing_id().alias("uid"), "id", "value", "row"), "numbered")
