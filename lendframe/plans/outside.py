"""Models from outside Spark, applied by workers: any object with ``predict_proba`` or ``predict``.

A model is saved as one row of a Parquet table, so any store that Spark reads will do. Its own list of column names,
``feature_names_in_`` or ``feature_name_``, is the contract: those columns are made from the cleaned table, in
that order, and nothing else is sent to Python. Workers unpickle a model once and keep it for all their tasks.

Load saved models only from places you trust: they are pickles.
"""

import hashlib
import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe import schema as S
from lendframe.operators.scoring import score_columns

#: Largest model that is sent to every worker.
MAX_MODEL_BYTES = 512 << 20


class LinearModel:
    """Weights per named column: a probability by the logistic curve, or an amount."""

    def __init__(self, weights: dict[str, float], constant: float = 0.0):
        self.feature_names_in_ = list(weights)
        self.weights, self.constant = np.array(list(weights.values()), float), constant

    def predict(self, x) -> np.ndarray:
        return np.asarray(x, float) @ self.weights + self.constant

    def predict_proba(self, x) -> np.ndarray:
        p = 1 / (1 + np.exp(-self.predict(x)))
        return np.column_stack([1 - p, p])


def save_model(spark: SparkSession, model: Any, path: str) -> None:
    raw = pickle.dumps(model)
    if len(raw) > MAX_MODEL_BYTES:
        raise ValueError(f"a model of {len(raw)} bytes cannot be sent to every worker")
    spark.createDataFrame([(hashlib.sha256(raw).hexdigest(), bytearray(raw))], "digest string, model binary").coalesce(1).write.parquet(path)


def load_model(spark: SparkSession, path: str) -> "SavedModel":
    row = spark.read.parquet(path).first()
    if row is None or hashlib.sha256(row["model"]).hexdigest() != row["digest"]:
        raise ValueError(f"no whole model in {path}")
    return SavedModel(spark, bytes(row["model"]), row["digest"])


_kept: dict[str, Any] = {}


class SavedModel:
    """A model as bytes: sent to each worker once, unpickled there once."""

    def __init__(self, spark: SparkSession, raw: bytes, digest: str):
        self.digest, self._sent = digest, spark.sparkContext.broadcast(raw)
        self.columns = column_names(pickle.loads(raw))

    def __getstate__(self):
        return {"digest": self.digest, "_sent": self._sent, "columns": self.columns}

    def get(self) -> Any:
        """The object, in a worker."""
        if self.digest not in _kept:
            _kept[self.digest] = pickle.loads(self._sent.value)
        return _kept[self.digest]


def column_names(model: Any) -> list[str]:
    """What the model says its columns are; a model that does not say cannot be applied by name."""
    for attribute in ("feature_names_in_", "feature_name_"):
        names = getattr(model, attribute, None)
        if names is not None and not callable(names):
            return [str(n) for n in names]
    raise ValueError("the model names no columns (feature_names_in_ or feature_name_)")


def contract_columns(df: DataFrame, names: list[str], categories=tuple(S.ENCODED_COLUMNS)) -> list[Column]:
    """One number per wanted name: a column, a level of a category (``<column>_<level>``), or 0 where there is neither.

    Null, NaN and infinities become 0. A column of the very name comes before a level; of two categories that fit, the one
    with the longer name.
    """
    held = {f.name: f.dataType for f in df.schema.fields}
    known = sorted((c for c in categories if c in held and not isinstance(held[c], T.NumericType)), key=len, reverse=True)
    return [_contract_column(name, held, known).alias(f"_{i}") for i, name in enumerate(names)]


def _contract_column(name: str, held: dict, categories: list[str]) -> Column:
    if isinstance(held.get(name), (T.NumericType, T.BooleanType)):
        x = F.col(f"`{name}`").cast("double")
        return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), x).otherwise(0.0)
    for c in categories:
        if name.startswith(f"{c}_"):
            return F.coalesce((F.col(f"`{c}`") == name[len(c) + 1:]).cast("double"), F.lit(0.0))
    return F.lit(0.0)


def missing_columns(df: DataFrame, names: list[str], categories=tuple(S.ENCODED_COLUMNS)) -> list[str]:
    """Wanted names that the table has neither as a column nor as a possible level; they are sent as 0."""
    held = {f.name: f.dataType for f in df.schema.fields}
    return [n for n in names if not isinstance(held.get(n), (T.NumericType, T.BooleanType))
            and not any(c in held and n.startswith(f"{c}_") for c in categories)]


def applied(df: DataFrame, models: dict[str, tuple[SavedModel, Callable]], keep=tuple(S.KEY_COLUMNS)) -> DataFrame:
    """``keep`` and one double per model: ``models`` gives for each output name the model and how it is asked.

    The wanted columns of all models are sent once, as arrays of numbers; rows map one to one.
    """
    wanted = list(dict.fromkeys(n for model, _ in models.values() for n in model.columns))
    places = {name: [wanted.index(n) for n in model.columns] for name, (model, _) in models.items()}
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.array(*contract_columns(df, wanted)).alias("_x"))
    schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(n, T.DoubleType()) for n in models]])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded = {name: (model.get(), how, model.columns) for name, (model, how) in models.items()}
        for batch in batches:
            x = np.array(batch.pop("_x").tolist(), float).reshape(len(batch), len(wanted))
            for name, (model, how, columns) in loaded.items():
                batch[name] = how(model, pd.DataFrame(x[:, places[name]], columns=columns)) if len(batch) else np.zeros(0)
            yield batch

    return rows.mapInPandas(ask, schema)


def probability(model: Any, x: pd.DataFrame) -> np.ndarray:
    return np.asarray(model.predict_proba(x), float)[:, 1]


def amount(model: Any, x: pd.DataFrame) -> np.ndarray:
    return np.asarray(model.predict(x), float)


def score_outside(df: DataFrame, classifier: SavedModel, regressor: SavedModel, keep=tuple(S.KEY_COLUMNS)) -> DataFrame:
    """Both models, then zones, labels and bounded amounts as for any other scorer."""
    asked = applied(df, {"_p": (classifier, probability), "_amount": (regressor, amount)}, keep)
    return asked.select(*keep, *score_columns(F.col("_p"), F.col("_amount")))
