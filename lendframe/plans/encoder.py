"""One-hot encoding from the training vocabulary, aligned to a fixed column list."""

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe import schema as S

def sparse_stages(columns, output: str = "sparse_levels") -> list:
    """For columns of very many levels: index and one sparse vector, no column per level."""
    indexed = [f"{c}_index" for c in columns]
    return [StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_levels" for c in columns], handleInvalid="keep"),
            VectorAssembler(inputCols=[f"{c}_levels" for c in columns], outputCol=output)]


def vocabulary(df: DataFrame, columns=None, max_levels: int = 5000) -> dict[str, list[str]]:
    """Sorted levels per category column, one output column each.

    Columns of more than ``max_levels`` levels are named in an error: they are ids or
    free text, or belong to ``sparse_stages``.
    """
    columns = [c for c in (columns or S.ENCODED_COLUMNS) if c in df.columns]
    # a coarse count names ids and free text before any level is gathered; the others' levels are counted as they are
    many = df.agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in columns]).first() if columns else {}
    wide = {c for c in columns if many[c] > 2 * max_levels}
    few = [c for c in columns if c not in wide]
    levels = (
        df.select(*[F.col(c).cast("string").alias(c) for c in few])
        .unpivot([], few, "column", "level").filter(F.col("level").isNotNull()).distinct().collect()
    ) if few else []
    found = {c: [] for c in few}
    for r in levels:
        found[r["column"]].append(r["level"])
    wide |= {c for c, v in found.items() if len(v) > max_levels}
    if wide:
        raise ValueError(f"more than {max_levels} category levels in {', '.join(c for c in columns if c in wide)}")
    return {c: sorted(v) for c, v in found.items()}


def one_hot_columns(vocab: dict[str, list[str]]) -> dict[str, Column]:
    """A 0/1 column per level but the first; unseen and null levels give zeros."""
    return {
        f"{c}_{level}": F.coalesce((F.col(c) == level).cast("int"), F.lit(0))
        for c, levels in vocab.items() for level in levels[1:]
    }


def is_number(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.NumericType)


def sanitized(c: str, data_type: T.DataType) -> Column:
    """Null, NaN and infinities become zero; booleans become 0/1."""
    if isinstance(data_type, T.BooleanType):
        return F.coalesce(F.col(c).cast("int"), F.lit(0))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        bad = F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf")))
        return F.when(bad | F.col(c).isNull(), F.lit(0.0)).otherwise(F.col(c))
    return F.coalesce(F.col(c), F.lit(0))


def numeric_features(df: DataFrame) -> list[str]:
    skip = {S.TARGET_CLASS, S.TARGET_AMOUNT, *S.KEY_COLUMNS}
    return [f.name for f in df.schema if is_number(f) and f.name not in skip]


def encode(df: DataFrame, vocab: dict[str, list[str]], expected: list[str],
           keep: list[str] = ()) -> DataFrame:
    """Exactly the ``expected`` columns: missing ones are zero, extra ones dropped."""
    hot = one_hot_columns({c: v for c, v in vocab.items() if c in df.columns})
    out = []
    for name in expected:
        if name in hot:
            out.append(hot[name].alias(name))
        elif name in df.columns and not isinstance(df.schema[name].dataType, T.StringType):
            out.append(sanitized(name, df.schema[name].dataType).alias(name))
        else:
            out.append(F.lit(0).alias(name))
    return df.select(*keep, *out)


class LoanEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the vocabulary and the training column list."""

    def _fit(self, df: DataFrame) -> "LoanEncoderModel":
        vocab = vocabulary(df)
        names = numeric_features(df) + list(one_hot_columns(vocab))
        return LoanEncoderModel()._set(vocab=json.dumps(vocab), expected=names)


class LoanEncoderModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the encoded columns as one vector column."""

    vocab = Param(Params._dummy(), "vocab", "levels per column as JSON", TypeConverters.toString)
    expected = Param(Params._dummy(), "expected", "training columns", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, outputCol: str = "features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**self._input_kwargs)

    def feature_names(self) -> list[str]:
        return self.getOrDefault(self.expected)

    def levels(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault(self.vocab))

    def encode(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        return encode(df, self.levels(), self.feature_names(), keep)

    def _transform(self, df: DataFrame) -> DataFrame:
        hot = one_hot_columns(self.levels())
        cells = []
        for name in self.feature_names():
            if name in hot:
                cells.append(hot[name].cast("double"))
            elif name in df.columns:
                cells.append(sanitized(name, df.schema[name].dataType).cast("double"))
            else:
                cells.append(F.lit(0.0))
        return df.withColumn(self.getOrDefault(self.outputCol), array_to_vector(F.array(*cells)))
