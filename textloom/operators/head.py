"""Classification head over one vector per document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import dense
from textloom.functions.math import argmax
from textloom.operators.labels import decode_labels
from textloom.sources.parameters import matrix

# Parameter names.
NORM_WEIGHT = "head.norm.weight"
DENSE_WEIGHT = "head.dense.weight"
CLASSIFIER_WEIGHT = "classifier.weight"
CLASSIFIER_BIAS = "classifier.bias"

# Fixed value: layer-norm epsilon of the pretrained configurations.
NORM_EPS = 1e-5


@dataclass(frozen=True)
class Head:
    """Layer norm, GELU and a dense map without bias, then a classifier with bias."""

    norm: np.ndarray
    dense: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    eps: float = NORM_EPS


def load_head(params: DataFrame, eps: float = NORM_EPS) -> Head:
    return Head(
        norm=matrix(params, NORM_WEIGHT).ravel(),
        dense=matrix(params, DENSE_WEIGHT),
        weight=matrix(params, CLASSIFIER_WEIGHT),
        bias=matrix(params, CLASSIFIER_BIAS).ravel(),
        eps=eps,
    )


def hidden(x: np.ndarray, norm: np.ndarray, weight: np.ndarray, eps: float) -> np.ndarray:
    return dense.gelu(dense.layer_norm(x, norm, eps)) @ weight.T


def head_vector(df: DataFrame, vec_col: str, head: Head, out: str = "features") -> DataFrame:
    """Add the vector that the classifier sees."""
    norm, weight, eps = head.norm, head.dense, head.eps

    @F.arrow_udf("array<double>")
    def transform(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield dense.map_rows(batch, lambda x: dense.to_lists(hidden(x, norm, weight, eps)), dense.VECTOR)

    return df.withColumn(out, transform(vec_col))


def score_head(df: DataFrame, vec_col: str, head: Head) -> DataFrame:
    """Add ``logits`` and ``probs``; NULL for a NULL vector. Stateless, so it also runs on a stream."""
    norm, inner, weight, bias, eps = head.norm, head.dense, head.weight, head.bias, head.eps

    def scores(x: np.ndarray) -> pa.Array:
        z = hidden(x, norm, inner, eps) @ weight.T + bias
        return pa.StructArray.from_arrays([dense.to_lists(z), dense.to_lists(dense.softmax(z))], ["logits", "probs"])

    kind = pa.struct([("logits", dense.VECTOR), ("probs", dense.VECTOR)])

    @F.arrow_udf("struct<logits: array<double>, probs: array<double>>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield dense.map_rows(batch, scores, kind)

    return df.withColumn("_score", score(vec_col)).select(
        *df.columns, F.col("_score.logits").alias("logits"), F.col("_score.probs").alias("probs")
    )


def predict(df: DataFrame, labels: DataFrame | None = None, probs: str = "probs") -> DataFrame:
    """Add the ``predicted`` id, the lowest among ties, and with a class map its name."""
    scored = df.withColumn("predicted", argmax(F.col(probs)))
    return scored if labels is None else decode_labels(scored, labels, "predicted", "predicted_label")
