"""Steps on a stored vector table against the dense rule."""

import os

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textloom.operators import sparse_update
from textloom.operators.optimizer import AdamParams, adam_step, init_state

IDS, DIMS = 60, 3


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    return spark.createDataFrame([(i * 3, v.tolist()) for i, v in enumerate(rng.normal(size=(IDS, DIMS)))], "token_id INT, vector ARRAY<DOUBLE>")


def entries(df, key, vec, out):
    return df.select(F.lit("w").alias("param"), F.col(key).cast("int").alias("row"), F.posexplode(vec).alias("col", out))


@pytest.mark.parametrize("hp", [AdamParams(lr=0.1), AdamParams(lr=0.1, decay=("l2", 0.2), amsgrad=True), AdamParams(lr=0.1, decay=("decoupled", 0.2))])
def test_like_the_dense_step_with_gaps(spark, table, hp):
    rng = np.random.default_rng(6)
    state = init_state(entries(table, "token_id", "vector", "theta"), hp)
    store = sparse_update.store_vectors(table, hp, block_rows=10)
    for t in (1, 2, 3):
        touched = rng.choice(IDS, 8, replace=False) * 3
        parts = [(int(i), rng.normal(size=DIMS).tolist()) for i in np.concatenate((touched, touched[:3]))]
        grads = spark.createDataFrame(parts, "id BIGINT, grad ARRAY<DOUBLE>")
        summed = entries(grads, "id", "grad", "grad").groupBy("param", "row", "col").agg(F.sum("grad").alias("grad"))
        state = spark.createDataFrame(adam_step(state, summed, hp, t).toArrow())
        store = sparse_update.sparse_step(spark, store, grads.repartition(3), hp, t)
    got = sparse_update.stored_vectors(spark, store)
    assert got.count() == IDS
    want = state.toPandas().sort_values(["row", "col"])
    rows = got.toPandas().sort_values("id")
    for name in ("theta", "m", "v", *(["vmax"] if hp.amsgrad else [])):
        assert np.abs(np.concatenate(rows[name].to_list()) - want[name].to_numpy()).max() < 1e-12


def test_untouched_blocks_stay(spark, table):
    hp = AdamParams()
    first = sparse_update.store_vectors(table, hp, block_rows=4)
    grads = spark.createDataFrame([(3, [1.0] * DIMS)], "id BIGINT, grad ARRAY<DOUBLE>")
    second = sparse_update.sparse_step(spark, first, grads, hp, 1)
    moved = [(old, new) for old, new in zip(first.files, second.files, strict=True) if old != new]
    assert len(moved) == 1 and len(first.files) == 15
    files = [f.removeprefix("file:") for f in second.files if f]
    assert all(os.path.exists(f) for f in files) and not os.path.exists(moved[0][0].removeprefix("file:"))
    kept = [f for f in files if "/0/" in f]
    for file in kept:
        open(file, "wb").close()  # a step on other blocks does not look at them
    third = sparse_update.sparse_step(spark, second, grads, hp, 2)
    assert [f for f in third.files if f and "/0/" in f] == [f for f in second.files if f and "/0/" in f]
    with pytest.raises(ValueError):
        sparse_update.sparse_step(spark, third, grads, hp, 2)


def test_pooled_gradient(spark, monkeypatch):
    monkeypatch.setattr(sparse_update, "SUMS_AT_ONCE", 5)
    rng = np.random.default_rng(7)
    rows = [(rng.integers(0, 9, rng.integers(0, 7)).tolist(), rng.normal(size=DIMS).tolist()) for _ in range(40)]
    want = {}
    for ids, grad in rows:
        for i in ids:
            want[i] = want.get(i, 0) + np.array(grad) / len(ids) / 40
    rows += [(None, [1.0] * DIMS), ([1], None), ([], [1.0] * DIMS)]
    frame = spark.createDataFrame(rows, "ids ARRAY<INT>, grad ARRAY<DOUBLE>").repartition(3)
    got = {}
    for r in sparse_update.pooled_gradient(frame, scale=1 / 40).collect():
        got[r["id"]] = got.get(r["id"], 0) + np.array(r["grad"])
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], atol=1e-14) for i in want)
    assert sparse_update.pooled_gradient(frame.limit(0)).collect() == []


def test_errors_and_empty_tables(spark, table):
    hp = AdamParams()
    grads = spark.createDataFrame([(1, [1.0] * DIMS)], "id BIGINT, grad ARRAY<DOUBLE>")
    for rows in (table, table.limit(0)):
        with pytest.raises(PySparkException, match="no vector"):
            sparse_update.sparse_step(spark, sparse_update.store_vectors(rows, hp), grads, hp, 1)
    empty = sparse_update.store_vectors(table.limit(0), hp)
    assert sparse_update.stored_vectors(spark, sparse_update.sparse_step(spark, empty, grads.limit(0), hp, 1)).collect() == []
    with pytest.raises(PySparkException, match="there twice"):
        sparse_update.store_vectors(table.union(table), hp)
