"""Gradient and training against a plain NumPy replay."""

import uuid

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textloom.functions import dense
from textloom.operators import stored_head, training
from textloom.operators.head import CLASSIFIER_BIAS, CLASSIFIER_WEIGHT
from textloom.operators.optimizer import AdamParams
from textloom.sources.parameters import PARAMETER_SCHEMA, matrix, matrix_rows

ROWS, WIDTH, CLASSES = 37, 5, 4


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(11)
    x, y = rng.normal(size=(ROWS, WIDTH)), rng.integers(0, CLASSES, ROWS)
    return x, y, rng.normal(size=(CLASSES, WIDTH)), rng.normal(size=CLASSES)


@pytest.fixture(scope="module")
def frame(spark, sample):
    x, y, _, _ = sample
    rows = [(int(i * 10), v.tolist(), int(label)) for i, (v, label) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "doc_id BIGINT, features ARRAY<DOUBLE>, label INT").repartition(5)


def mean_loss(x, y, w, b, source):
    z = x @ w.T + b
    logp = dense.log_softmax(dense.softmax(z) if source == "probs" else z)
    return -logp[np.arange(len(y)), y].mean()


def numeric_gradient(x, y, w, b, source, h=1e-6):
    def slope(value):
        out = np.zeros_like(value)
        for i in np.ndindex(value.shape):
            old = value[i]
            value[i] = old + h
            up = mean_loss(x, y, w, b, source)
            value[i] = old - h
            out[i] = (up - mean_loss(x, y, w, b, source)) / (2 * h)
            value[i] = old
        return out

    w, b = w.copy(), b.copy()
    return slope(w), slope(b)


@pytest.mark.parametrize("source", ["probs", "logits"])
def test_gradient_is_the_slope_of_the_loss(frame, sample, source):
    x, y, w, b = sample
    rows = training.head_gradient(frame, w, b, source, with_loss=True).collect()
    got_w, got_b = np.zeros_like(w), np.zeros_like(b)
    for r in rows:
        if r["param"] == CLASSIFIER_WEIGHT:
            got_w[r["row"], r["col"]] = r["grad"]
        elif r["param"] == CLASSIFIER_BIAS:
            got_b[r["col"]] = r["grad"]
        else:
            assert r["grad"] == pytest.approx(mean_loss(x, y, w, b, source))
    want_w, want_b = numeric_gradient(x, y, w, b, source)
    assert np.allclose(got_w, want_w, atol=1e-8) and np.allclose(got_b, want_b, atol=1e-8)


def replay(sample, hp, epochs, size, source, lifetime, schedule=None):
    x, y, w, b = sample
    theta = np.concatenate([w.ravel(), b])
    m = v = np.zeros_like(theta)
    t, losses, lr, beta_1, beta_2 = 0, [], hp.lr, hp.beta_1, hp.beta_2
    for _ in range(epochs):
        for i in range(0, ROWS, size):
            lr, beta_1, beta_2 = (schedule or {}).get(t, (lr, beta_1, beta_2))
            t += 1
            w, b = theta[: w.size].reshape(w.shape), theta[w.size :]
            bx, by = x[i : i + size], y[i : i + size]
            losses.append(mean_loss(bx, by, w, b, source))
            g = np.concatenate([p.ravel() for p in numeric_gradient(bx, by, w, b, source, h=1e-5)])
            if lifetime == "step":
                m, v = np.zeros_like(theta), np.zeros_like(theta)
            k = 1 if lifetime == "step" else t
            m, v = beta_1 * m + (1 - beta_1) * g, beta_2 * v + (1 - beta_2) * g * g
            theta = theta - lr * (m / (1 - beta_1**k)) / (np.sqrt(v / (1 - beta_2**k)) + hp.eps)
    return theta[: w.size].reshape(w.shape), theta[w.size :], losses


@pytest.mark.parametrize("source", ["probs", "logits"])
@pytest.mark.parametrize("lifetime", ["run", "step"])
def test_training_against_replay(frame, sample, source, lifetime):
    _, _, w, b = sample
    hp = AdamParams(lr=0.05)
    params, metrics = training.train_head(
        frame, w, b, hp, epochs=2, batch_size=16, input=source, optimizer_lifetime=lifetime, run_id="r"
    )
    want_w, want_b, losses = replay(sample, hp, 2, 16, source, lifetime)
    assert np.allclose(matrix(params, CLASSIFIER_WEIGHT), want_w, atol=1e-4)
    assert np.allclose(matrix(params, CLASSIFIER_BIAS).ravel(), want_b, atol=1e-4)
    rows = metrics.sort("epoch", "step").collect()
    assert [(r["run_id"], r["epoch"], r["step"], r["batch_size"]) for r in rows] == [
        ("r", e, s, n) for e in range(2) for s, n in enumerate((16, 16, 5))
    ]
    assert np.allclose([r["loss"] for r in rows], losses, atol=1e-4)


def test_schedule(frame, sample):
    _, _, w, b = sample
    hp, schedule = AdamParams(lr=0.05), {1: (0.01, 0.8, 0.9), 3: (0.2, 0.8, 0.9)}
    params, _ = training.train_head(frame, w, b, hp, epochs=2, batch_size=20, input="logits", schedule=schedule)
    want_w, _, _ = replay(sample, hp, 2, 20, "logits", "run", schedule)
    assert np.allclose(matrix(params, CLASSIFIER_WEIGHT), want_w, atol=1e-4)


def test_schedule_of_whole_sets(frame, sample):
    """From the second step on the rule has decay; both ways of training follow, and AMSGrad stays off."""
    _, _, w, b = sample
    schedule = {1: AdamParams(lr=0.02, beta_1=0.8, decay=("l2", 0.5), amsgrad=True)}
    same = {"hp": AdamParams(lr=0.05), "epochs": 1, "batch_size": 20, "input": "logits", "schedule": schedule}
    with pytest.warns(UserWarning, match="AMSGrad"):
        held, _ = training.train_head(frame, w, b, **same)
        stored, _ = training.train_head(frame, w, b, limit=0, **same)
    assert np.allclose(matrix(held, CLASSIFIER_WEIGHT), matrix(stored, CLASSIFIER_WEIGHT), rtol=0, atol=1e-12)
    plain, _ = training.train_head(frame, w, b, **same | {"schedule": {1: (0.02, 0.8, 0.999)}})
    assert not np.allclose(matrix(held, CLASSIFIER_WEIGHT), matrix(plain, CLASSIFIER_WEIGHT), atol=1e-4)


def test_amsgrad_trains(frame, sample):
    _, _, w, b = sample
    params, metrics = training.train_head(frame, w, b, AdamParams(lr=0.05, amsgrad=True), epochs=3, input="logits")
    assert "vmax" in params.columns
    losses = [r["loss"] for r in metrics.sort("epoch").collect()]
    assert losses[2] < losses[0]


def test_label_out_of_range_stops_training(frame, sample):
    _, _, w, b = sample
    bad = frame.withColumn("label", F.when(F.col("doc_id") == 0, 4).otherwise(F.col("label")))
    with pytest.raises(PySparkException, match="audit_labels"):
        training.train_head(bad, w, b, epochs=1)


def test_unknown_options(frame, sample):
    _, _, w, b = sample
    with pytest.raises(ValueError):
        training.train_head(frame, w, b, optimizer_lifetime="epoch")
    with pytest.raises(ValueError):
        training.head_gradient(frame, w, b, "scores")


VARIANTS = [
    ("probs", "run", AdamParams(lr=0.05), None),
    ("logits", "step", AdamParams(lr=0.05, decay=("l2", 0.1)), {CLASSIFIER_BIAS: "i64"}),
    ("probs", "run", AdamParams(lr=0.05, decay=("decoupled", 0.1), amsgrad=True), {CLASSIFIER_WEIGHT: "u8"}),
]


@pytest.mark.parametrize("source,lifetime,hp,dtypes", VARIANTS)
def test_blocks_train_like_one_array(spark, frame, sample, source, lifetime, hp, dtypes):
    _, _, w, b = sample
    same = {"hp": hp, "epochs": 2, "batch_size": 16, "input": source, "optimizer_lifetime": lifetime, "run_id": "r"}
    same |= {"schedule": {2: (0.01, 0.8, 0.99)}, "dtypes": dtypes}
    want, want_log = training.train_head(frame, w, b, **same)
    # blocks of one class and of three, the last one shorter
    for entries in (1, 3 * (WIDTH + 1)):
        table = training.parameter_table(spark, {CLASSIFIER_WEIGHT: w, CLASSIFIER_BIAS: b})
        got, log = training.train_head(frame, table, limit=0, block_entries=entries, **same)
        assert got.columns == want.columns
        keys = ["param", "row", "col"]
        left, right = (d.toPandas().sort_values(keys).reset_index(drop=True) for d in (got, want))
        assert (left[keys] == right[keys]).all().all()
        assert np.abs(left[want.columns[3:]] - right[want.columns[3:]]).max().max() < 1e-12
        losses = [[r["loss"] for r in d.sort("epoch", "step").collect()] for d in (log, want_log)]
        assert np.allclose(*losses, rtol=0, atol=1e-12)


def test_blocks_refuse_holes_and_odd_rows(spark, frame, sample):
    _, _, w, b = sample
    entries = matrix_rows(CLASSIFIER_WEIGHT, w) + matrix_rows(CLASSIFIER_BIAS, b)
    for broken in (entries[1:], entries + entries[:1], entries[:-1], entries[:-1] + entries[-2:-1]):
        table = spark.createDataFrame(broken, PARAMETER_SCHEMA)
        with pytest.raises(PySparkException, match="does not have one weight"):
            training.train_head(frame, table, limit=0, epochs=1)
    bad = frame.withColumn("label", F.lit(CLASSES))
    with pytest.raises(PySparkException, match="audit_labels"):
        training.train_head(bad, w, b, limit=0, epochs=1)
    with pytest.raises(ValueError):
        training.train_head(frame, w)


def test_stored_folders_are_removed(frame, sample, tmp_path, monkeypatch):
    _, _, w, b = sample
    for module in (training, stored_head):
        monkeypatch.setattr(module, "work_path", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    params, _ = training.train_head(frame, w, b, limit=0, batch_size=16, epochs=2)
    assert params.count() == w.size + b.size
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["classifier"]
    for limit in (0, 1000):
        with pytest.raises(PySparkException):
            training.train_head(frame.withColumn("label", F.lit(-1)), w, b, limit=limit, epochs=1)
        assert len(list(tmp_path.iterdir())) == 1
