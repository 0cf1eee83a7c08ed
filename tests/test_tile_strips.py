"""Tiles of sparse positions: few files are read, and results are those of the whole group."""

import numpy as np

from textloom.operators import neighbours


def test_far_positions_share_strips(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x, n = rng.normal(size=(60, 3)), 60
    rows = [("a" if i < 40 else None, i * 1000, x[i].tolist(), int(i % 3 > 0)) for i in range(n)]
    frame = spark.createDataFrame(rows, "g STRING, pos BIGINT, vector ARRAY<DOUBLE>, mask INT")
    manifests, keep = [], neighbours.stored
    monkeypatch.setattr(neighbours, "stored", lambda df, name: manifests.append(keep(df, name)) or manifests[-1])
    got = {r["pos"]: r["pooled"] for r in neighbours.neighbour_pool(frame, "g", block=1).collect()}
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert manifests[0].count() <= 2 * partitions  # one for each block of positions would be 60
    for own in (range(40), range(40, n)):
        scores = x[own] @ x[own].T * 3**-0.5 + np.where([r[3] for r in np.array(rows, object)[own]], 0, -3.4028234663852886e38)
        powers = np.exp(scores - scores.max(axis=1, keepdims=True))
        want = powers @ x[own] / powers.sum(axis=1, keepdims=True)
        assert np.allclose([got[rows[i][1]] for i in own], want)


def test_strips_are_cut_by_group_and_size(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "STRIP_ROWS", 4)
    x = np.random.default_rng(2).normal(size=(30, 2))
    frame = spark.createDataFrame([(i % 2, i, x[i].tolist(), 1) for i in range(30)], "g INT, pos BIGINT, vector ARRAY<DOUBLE>, mask INT")
    small = {r["pos"]: r["pooled"] for r in neighbours.neighbour_pool(frame, "g", block=3).collect()}
    whole = {r["pos"]: r["pooled"] for r in neighbours.neighbour_pool(frame, "g", max_len=30).collect()}
    assert small.keys() == whole.keys() and all(np.allclose(small[k], whole[k]) for k in whole)
