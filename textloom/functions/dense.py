"""The same vector functions over a block of rows, for use on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from textloom.functions.math import ERF_COEFFICIENTS, ERF_P

VECTOR = pa.list_(pa.float64())


def to_matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as one matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("a vector is NULL")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(column) == 0:
        return values.reshape(0, 0)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != lengths[0]).any():
        raise ValueError("vectors differ in length")
    return values.reshape(len(column), -1)


def to_lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(matrix.ravel()))


def map_rows(column: pa.Array, fn: Callable[[np.ndarray], pa.Array], empty: pa.DataType) -> pa.Array:
    """Apply a function of a matrix to the vectors that are present; NULL stays NULL."""
    present = column.is_valid().to_numpy(zero_copy_only=False)
    if not present.any():
        return pa.nulls(len(column), empty)
    if present.all():
        return fn(to_matrix(column))
    rows = np.cumsum(present) - 1
    return fn(to_matrix(column.drop_null())).take(pa.array(rows, mask=~present))


def gelu(x: np.ndarray) -> np.ndarray:
    a1, a2, a3, a4, a5 = ERF_COEFFICIENTS
    z = x / np.sqrt(2.0)
    t = 1.0 / (1.0 + ERF_P * np.abs(z))
    series = ((((a5 * t + a4) * t + a3) * t + a2) * t + a1) * t
    return 0.5 * x * (1.0 + np.sign(z) * (1.0 - series * np.exp(-z * z)))


def gelu_slope(x: np.ndarray) -> np.ndarray:
    """Derivative of ``gelu``: the normal distribution function plus x times its density."""
    share = np.divide(gelu(x), x, out=np.full_like(x, 0.5), where=x != 0)
    return share + x * np.exp(-0.5 * x * x) / np.sqrt(2.0 * np.pi)


def layer_norm(x: np.ndarray, weight: np.ndarray, eps: float) -> np.ndarray:
    centred = x - x.mean(axis=1, keepdims=True)
    variance = (centred * centred).mean(axis=1, keepdims=True)
    return centred / np.sqrt(variance + eps) * weight


def softmax(z: np.ndarray) -> np.ndarray:
    powers = np.exp(z - z.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def log_softmax(z: np.ndarray) -> np.ndarray:
    shifted = z - z.max(axis=1, keepdims=True)
    return shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))


def loss_slope(z: np.ndarray, y: np.ndarray, source: str) -> tuple[float, np.ndarray]:
    """Sum of the losses of the rows, and the derivative of each row's loss by its logits.

    The loss is the negative log-softmax, at class ``y``, of the logits (``source="logits"``) or
    of their softmax (``source="probs"``).
    """
    own = np.arange(len(y)), y
    p = softmax(z)
    if source == "logits":
        p[own] -= 1.0
        return -log_softmax(z)[own].sum(), p
    r = softmax(p)
    r[own] -= 1.0
    return -log_softmax(p)[own].sum(), p * (r - (p * r).sum(axis=1, keepdims=True))
