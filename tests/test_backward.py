"""Gradient of the whole head against slopes of the loss."""

from math import erf, sqrt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textloom.functions import dense
from textloom.operators import backward
from textloom.operators.head import CLASSIFIER_BIAS, CLASSIFIER_WEIGHT, DENSE_WEIGHT, NORM_WEIGHT, Head
from textloom.operators.optimizer import AdamParams
from textloom.sources.parameters import matrix

ROWS, WIDTH, INNER, CLASSES = 23, 6, 5, 4
NAMES = {NORM_WEIGHT: "norm", DENSE_WEIGHT: "dense", CLASSIFIER_WEIGHT: "weight", CLASSIFIER_BIAS: "bias"}


@pytest.fixture(scope="module")
def case(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(ROWS, WIDTH)), rng.integers(0, CLASSES, ROWS)
    head = Head(
        rng.normal(size=WIDTH), rng.normal(size=(INNER, WIDTH)), rng.normal(size=(CLASSES, INNER)), rng.normal(size=CLASSES)
    )
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y, strict=True))]
    return x, y, head, spark.createDataFrame(rows, "doc_id BIGINT, vector ARRAY<DOUBLE>, label INT").repartition(4)


def losses(x, y, head, source):
    """With the exact error function, so that the approximation is held against it too."""
    n = dense.layer_norm(x, head.norm, head.eps)
    z = (n * 0.5 * (1 + np.vectorize(erf)(n / sqrt(2)))) @ head.dense.T @ head.weight.T + head.bias
    return -dense.log_softmax(dense.softmax(z) if source == "probs" else z)[np.arange(len(y)), y]


def slope(value, fn, h=1e-5):
    out = np.zeros_like(value)
    for i in np.ndindex(value.shape):
        old = value[i]
        value[i] = old + h
        up = fn()
        value[i] = old - h
        out[i] = (up - fn()) / (2 * h)
        value[i] = old
    return out


@pytest.mark.parametrize("source", ["probs", "logits"])
def test_every_tensor(case, source):
    x, y, head, frame = case
    got = {name: np.zeros_like(np.atleast_2d(getattr(head, field))) for name, field in NAMES.items()}
    rows = backward.head_backward(frame, head, source, with_loss=True).collect()
    for r in rows:
        if r["param"] == backward.LOSS:
            assert r["grad"] == pytest.approx(losses(x, y, head, source).mean(), abs=1e-6)
        else:
            got[r["param"]][r["row"], r["col"]] = r["grad"]
    assert len(rows) == 1 + sum(g.size for g in got.values())
    for name, field in NAMES.items():
        want = slope(getattr(head, field), lambda: losses(x, y, head, source).mean())
        assert np.allclose(got[name], np.atleast_2d(want), atol=2e-6), name


@pytest.mark.parametrize("source", ["probs", "logits"])
def test_vectors(case, source):
    x, y, head, frame = case
    missing = frame.withColumn("vector", F.when(F.col("doc_id") != 7, F.col("vector")))
    got = {r["doc_id"]: r["grad"] for r in backward.vector_gradient(missing, head, source).collect()}
    want = slope(x, lambda: losses(x, y, head, source).sum())
    assert got.pop(7) is None and len(got) == ROWS - 1
    assert all(np.allclose(g, want[i], atol=2e-6) for i, g in got.items())


@pytest.mark.parametrize("lifetime", ["run", "step"])
def test_training_against_replay(case, lifetime):
    x, y, head, frame = case
    hp, size = AdamParams(lr=0.05), 9
    got, log = backward.train_whole_head(frame, head, hp, 2, size, input="logits", optimizer_lifetime=lifetime)
    now = Head(*(np.array(getattr(head, field)) for field in NAMES.values()))
    moments = {field: (0.0, 0.0) for field in NAMES.values()}
    want_log = []
    for t in range(6):
        part = slice(t % 3 * size, t % 3 * size + size)
        want_log.append(losses(x[part], y[part], now, "logits").mean())
        slopes = {f: slope(getattr(now, f), lambda: losses(x[part], y[part], now, "logits").mean()) for f in moments}
        k = t + 1 if lifetime == "run" else 1
        for field, g in slopes.items():
            m, v = moments[field] if lifetime == "run" else (0.0, 0.0)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            moments[field] = m, v
            getattr(now, field)[...] -= hp.lr * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + hp.eps)
    for name, field in NAMES.items():
        assert np.allclose(matrix(got, name), np.atleast_2d(getattr(now, field)), atol=2e-3), name
    assert np.allclose([r["loss"] for r in log.sort("epoch", "step").collect()], want_log, atol=1e-3)


def test_a_tensor_that_is_not_trained(case):
    _, _, head, frame = case
    got, _ = backward.train_whole_head(frame, head, AdamParams(lr=0.1), 1, dtypes={DENSE_WEIGHT: "i8"})
    assert (matrix(got, DENSE_WEIGHT) == head.dense).all()
    assert (matrix(got, NORM_WEIGHT) != head.norm).all()


def test_extremes(spark, case):
    _, _, head, frame = case
    assert backward.head_backward(frame.limit(0), head).collect() == []
    flat = spark.createDataFrame([([2.0] * WIDTH, 1)], "vector ARRAY<DOUBLE>, label INT")  # no variance
    assert all(np.isfinite(r["grad"]) for r in backward.head_backward(flat, head).collect())
    with pytest.raises(PySparkException, match="audit_labels"):
        backward.head_backward(frame.withColumn("label", F.lit(CLASSES)), head).collect()
    with pytest.raises(PySparkException, match="no features"):
        backward.head_backward(frame.withColumn("vector", F.lit(None).cast("array<double>")), head).collect()
    with pytest.raises(ValueError):
        backward.vector_gradient(frame, head, out="label")
    with pytest.raises(ValueError):
        backward.head_backward(frame, head, "scores")
