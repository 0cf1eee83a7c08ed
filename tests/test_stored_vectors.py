"""Mean vectors of documents by a table that tasks read in blocks."""

import numpy as np
import pytest
from pyspark.errors import PySparkException

from textloom.operators import vectors


def pooled(spark, monkeypatch, table, docs, ids_at_once):
    monkeypatch.setattr(vectors, "IDS_AT_ONCE", ids_at_once)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 2)
    frame = spark.createDataFrame(docs, "doc_id BIGINT, input_ids ARRAY<INT>, attention_mask ARRAY<INT>")
    return vectors.pool_tokens(frame, spark.createDataFrame(table, "token_id INT, vector ARRAY<FLOAT>"), "mean", 2, ["doc_id"], limit=0)


@pytest.mark.parametrize("ids_at_once", [1, 1000])
def test_means_without_moving_vectors(spark, monkeypatch, ids_at_once):
    table = [(i, [float(i), -i / 2]) for i in range(9)] + [(3, [30.0, 1.0]), (None, [1.0, 1.0])]
    docs = [(1, [1, 2, 3], [1, 1, 0]), (1, [8, 8, 5], [1, 1, 1]), (2, [3, 0], [1, 0]), (3, [4], [0]), (4, [], []), (5, None, None), (6, [None, 7], [1, 1])]
    found = pooled(spark, monkeypatch, table, docs, ids_at_once)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan  # vectors of all places were shuffled before
    got = sorted(((r["doc_id"], r["pooled"]) for r in found.collect()), key=lambda r: (r[0], r[1] or []))
    want = [(1, [1.5, -0.75]), (1, [7.0, -3.5]), (2, [16.5, -0.25]), (3, None), (4, None), (5, None), (6, [7.0, -3.5])]
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all((a is None and b is None) or np.allclose(a, b) for (_, a), (_, b) in zip(got, want))


@pytest.mark.parametrize("table", [[(1, [1.0, 1.0])], [(1, [1.0, 1.0]), (2, None), (2, [1.0, 1.0])], []])
def test_an_id_without_vector_is_an_error(spark, monkeypatch, table):
    with pytest.raises(PySparkException, match="no vector for token"):
        pooled(spark, monkeypatch, table, [(1, [2], [1])], 10).collect()
