"""Gradient of the whole head: classifier, dense map, GELU and layer norm, down to the vectors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import dense
from textloom.operators.head import CLASSIFIER_BIAS, CLASSIFIER_WEIGHT, DENSE_WEIGHT, NORM_WEIGHT, Head
from textloom.operators.optimizer import AdamParams, Schedule
from textloom.operators.training import (
    BATCH_SIZE,
    EPOCHS,
    LEARNING_RATE,
    LOSS,
    PARTIAL_SCHEMA,
    labelled_vectors,
    mean_gradient,
    tensor_entries,
    train_tensors,
    write_batches,
)
from textloom.session import remove_path, work_path
from textloom.sources.metrics import METRIC_SCHEMA
from textloom.sources.parameters import FLOAT_TYPES

FIELDS = {NORM_WEIGHT: "norm", DENSE_WEIGHT: "dense", CLASSIFIER_WEIGHT: "weight", CLASSIFIER_BIAS: "bias"}

# Rows that go through the head at a time within a task.
ROWS_AT_ONCE = 4096


def _backward(x: np.ndarray, y: np.ndarray, head: Head, source: str) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Sums over the rows for each tensor and for the loss, and the derivative by each row's vector."""
    centred = x - x.mean(axis=1, keepdims=True)
    scale = np.sqrt((centred * centred).mean(axis=1, keepdims=True) + head.eps)
    unit = centred / scale
    normed = unit * head.norm
    active = dense.gelu(normed)
    features = active @ head.dense.T
    loss, d_logits = dense.loss_slope(features @ head.weight.T + head.bias, y, source)

    d_features = d_logits @ head.weight
    d_normed = (d_features @ head.dense) * dense.gelu_slope(normed)
    d_unit = d_normed * head.norm
    d_x = d_unit - d_unit.mean(axis=1, keepdims=True) - unit * (d_unit * unit).mean(axis=1, keepdims=True)
    sums = {
        CLASSIFIER_WEIGHT: d_logits.T @ features,
        CLASSIFIER_BIAS: d_logits.sum(axis=0),
        DENSE_WEIGHT: d_features.T @ active,
        NORM_WEIGHT: (d_normed * unit).sum(axis=0),
        LOSS: np.array([loss]),
    }
    return sums, d_x / scale


def _check(source: str) -> None:
    if source not in ("probs", "logits"):
        raise ValueError(f"unknown input {source!r}")


def head_backward(
    batch: DataFrame,
    head: Head,
    input: str = "probs",
    vec_col: str = "vector",
    label: str = "label",
    with_loss: bool = False,
) -> DataFrame:
    """``(param, row, col, grad)`` of the mean loss of a batch, for every parameter of the head.

    ``input`` is as in ``head_gradient``. Each task goes through its rows some thousand at a time
    and holds one sum for each tensor; the shuffle carries one number per parameter entry and
    task. A NULL vector and a label that is NULL or no class are errors; an empty batch has no rows.
    ``with_loss`` adds the mean loss as a row named ``loss``.
    """
    _check(input)

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows = 0
        for part in batches:
            for start in range(0, part.num_rows, ROWS_AT_ONCE):
                x, y = labelled_vectors(part.slice(start, ROWS_AT_ONCE), len(head.weight))
                found, _ = _backward(x, y, head, input)
                sums = {name: sums[name] + value for name, value in found.items()} if sums else found
                rows += len(y)
        if rows:
            yield from tensor_entries(sums, rows)

    return mean_gradient(batch.select(vec_col, label).mapInArrow(partial_sums, PARTIAL_SCHEMA), with_loss)


def vector_gradient(
    df: DataFrame, head: Head, input: str = "probs", vec_col: str = "vector", label: str = "label", out: str = "grad"
) -> DataFrame:
    """Add the derivative of each row's own loss by its vector; no row is shuffled.

    A row without vector has a NULL derivative. A label that is NULL or no class is an error where
    there is a vector.
    """
    _check(input)
    if out in df.columns:
        raise ValueError(f"the input has a column {out!r} already")

    @F.arrow_udf("array<double>")
    def slope(vectors: pa.Array, classes: pa.Array) -> pa.Array:
        present = vectors.is_valid()
        rows = pa.RecordBatch.from_arrays([vectors, classes], ["vector", "label"]).filter(present)
        if not rows.num_rows:
            return pa.nulls(len(vectors), dense.VECTOR)
        x, y = labelled_vectors(rows, len(head.weight))
        found = dense.to_lists(_backward(x, y, head, input)[1])
        valid = present.to_numpy(zero_copy_only=False)
        return found.take(pa.array(np.cumsum(valid) - 1, mask=~valid))

    return df.withColumn(out, slope(vec_col, label))


def train_whole_head(
    df: DataFrame,
    head: Head,
    hp: AdamParams = AdamParams(lr=LEARNING_RATE),
    epochs: int = EPOCHS,
    batch_size: int = BATCH_SIZE,
    order_by: str = "doc_id",
    vec_col: str = "vector",
    label: str = "label",
    input: str = "probs",
    optimizer_lifetime: str = "run",
    schedule: Schedule | None = None,
    run_id: str | None = None,
    dtypes: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train every parameter of the head; returns ``(params, metrics)``, options as in ``train_head``.

    The head is held by the driver and by each task, as scoring with it does.
    """
    _check(input)
    if optimizer_lifetime not in ("run", "step"):
        raise ValueError(f"unknown optimizer_lifetime {optimizer_lifetime!r}")
    spark = df.sparkSession
    fixed = [name for name, kind in (dtypes or {}).items() if kind not in FLOAT_TYPES]

    def gradient(batch: DataFrame, held: Mapping[str, np.ndarray]) -> DataFrame:
        current = {field: held[name] for name, field in FIELDS.items()}
        return head_backward(batch, replace(head, **current), input, "features", with_loss=True)

    path = work_path(spark, "batches")
    try:
        batches = write_batches(df, order_by, batch_size, vec_col, label, path)
        state, log = train_tensors(
            spark,
            path,
            batches,
            {name: getattr(head, field) for name, field in FIELDS.items()},
            gradient,
            hp,
            epochs,
            optimizer_lifetime,
            schedule,
            run_id or uuid.uuid4().hex,
            fixed,
        )
    finally:
        remove_path(spark, path)
    return state, spark.createDataFrame(log, METRIC_SCHEMA)
