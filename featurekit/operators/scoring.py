"""Batch scoring: models as native expressions or Arrow UDFs.

``predict`` picks the cheapest correct path:

* a model exposing ``to_column(cols)`` (e.g. ``LinearModel``) becomes a plain
  Catalyst expression — whole-stage codegen, no Python;
* a model with ``predict`` / ``predict_proba`` (any sklearn-like object) runs
  in an iterator Arrow UDF: the model is broadcast once, unpickled once per
  task and applied to each batch as one matrix over the list's value buffer;
* a model with neither scores the mean of the features (native expression);
* no model scores 0.0.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class LinearModel:
    """``bias + Σ w_j x_j`` (``output='probability'`` applies a logistic link)."""

    def __init__(self, weights: Sequence[float], bias: float = 0.0, output: str = "value"):
        self.weights = [float(w) for w in weights]
        self.bias = float(bias)
        self.output = output

    def predict(self, X: np.ndarray) -> np.ndarray:
        y = np.full(X.shape[0], self.bias)
        for j, w in enumerate(self.weights):  # same left-to-right order as the SQL form
            y = y + w * X[:, j]
        return 1.0 / (1.0 + np.exp(-y)) if self.output == "probability" else y

    def to_column(self, cols: Sequence[Column]) -> Column:
        y = F.lit(self.bias)
        for w, c in zip(self.weights, cols):
            y = y + F.lit(w) * c
        return 1.0 / (1.0 + F.exp(-y)) if self.output == "probability" else y


class MeanModel:
    """A model object without ``predict``: scores the mean of the features."""


def mean_of(arr: Column) -> Column:
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(arr) > 0, total / F.size(arr)).otherwise(F.lit(0.0))


def _feature_matrix(vectors: pa.Array) -> np.ndarray:
    """The batch's feature vectors as a matrix over the list's value buffer; a null component is NaN."""
    sizes = np.diff(vectors.offsets.to_numpy())
    if vectors.null_count or (sizes != sizes[:1]).any():
        raise ValueError("feature vectors must not be null and must be of one length")
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)


def _udf_for(df: DataFrame, model, use_proba: bool):
    from featurekit.session import ship_package
    ship_package(df.sparkSession)  # the broadcast model may be a featurekit class
    bc = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = bc.value
        for a in batches:
            X = _feature_matrix(a)
            if not len(X):
                yield pa.array([], pa.float64())
                continue
            y = m.predict_proba(X)[:, 1] if use_proba else m.predict(X)
            yield pa.array(np.asarray(y, dtype="float64"))

    return score


def predict(df: DataFrame, model, features: str = "_features", out: str = "prediction",
            feature_cols: Sequence[str] | None = None, vectorized_udf: bool = False,
            output: str = "value") -> DataFrame:
    """Add the prediction column. ``output='probability'`` uses
    ``predict_proba`` when the model has it (explicit, not guessed)."""
    if model is None:
        return df.withColumn(out, F.lit(0.0))
    if hasattr(model, "to_column") and feature_cols is not None and not vectorized_udf:
        return df.withColumn(out, model.to_column([F.col(c).cast("double") for c in feature_cols]))
    if output == "probability" and hasattr(model, "predict_proba"):
        return df.withColumn(out, _udf_for(df, model, True)(F.col(features)))
    if hasattr(model, "predict"):
        return df.withColumn(out, _udf_for(df, model, False)(F.col(features)))
    return df.withColumn(out, mean_of(F.col(features)))


def hash_fraction(*cols: str) -> Column:
    """Reproducible uniform [0, 1) from the row key: first 32 bits of the MD5 of
    ``c1|c2|..`` (replaces ``rand()`` so scores are testable)."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def rule_score(df: DataFrame, value_col: str = "total_value", key=("user_id", "date"),
               out: str = "prediction") -> DataFrame:
    """Three bands on ``value_col``: > 50 → [0.7, 1.0), > 10 → [0.3, 0.7),
    else [0.1, 0.3); position inside the band from the key hash."""
    r = hash_fraction(*key)
    v = F.col(value_col)
    return df.withColumn(out, F.when(v > 50, 0.7 + r * 0.3).when(v > 10, 0.3 + r * 0.4).otherwise(0.1 + r * 0.2))


def with_lineage(df: DataFrame, run_id: str | Column, model_name: str, model_version: str,
                 feature_snapshot: str | None) -> DataFrame:
    """P5: lineage literals (the run id may be a column) and the prediction time on every row."""
    return df.withColumns({
        "_prediction_run_id": F.lit(run_id),
        "_model_name": F.lit(model_name),
        "_model_version": F.lit(model_version),
        "_feature_snapshot": F.lit(feature_snapshot).cast("string"),
        "_predicted_at": F.current_timestamp(),
    })


def stats_exprs(col: str = "prediction") -> list[Column]:
    """A4: count, mean, stddev (sample), min, max as typed aggregates."""
    c = F.col(col)
    return [F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
            F.min(c).alias("min"), F.max(c).alias("max")]


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])
