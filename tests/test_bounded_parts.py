"""Tokens and ids of a batch are handled some at a time."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textloom.operators import sparse_update, tokens


def test_parts_of_lists_hold_all_rows_in_order():
    lists = pa.array([[1, 2], [], None, [3, 4, 5, 6, 7], [8], [9]], pa.list_(pa.int32()))
    for entries in (1, 2, 3, 100):
        parts = list(tokens.parts_of_lists(lists.slice(1), entries))
        assert pa.concat_arrays(parts).to_pylist() == lists.slice(1).to_pylist()
        assert all(len(part.flatten()) <= entries or len(part.drop_null()) == 1 for part in parts)
    assert len(list(tokens.parts_of_lists(lists.slice(0, 0), 3))) == 1


def test_lookup_and_gradient_hold_some_tokens_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(tokens, "TOKENS_AT_ONCE", 3)
    monkeypatch.setattr(sparse_update, "TOKENS_AT_ONCE", 3)
    words = [["a", "b"], [], ["c", "a", "a", "b"], ["d"], ["b"]]
    table = pa.table({"token": ["a", "b", "c"], "token_id": [4, 5, 6]})
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id BIGINT, words ARRAY<STRING>").coalesce(1)
    coded = docs.select("doc_id", tokens.id_array_lookup(spark, table)("words").alias("ids"))
    numbers = {"a": 4, "b": 5, "c": 6}
    assert [r["ids"] for r in coded.orderBy("doc_id").collect()] == [[numbers.get(w, 1) for w in row] for row in words]
    grads = sparse_update.pooled_gradient(coded.withColumn("grad", F.array(F.col("doc_id") + 1.0)))
    got = {r["id"]: r["s"] for r in grads.groupBy("id").agg(F.sum(F.col("grad")[0]).alias("s")).collect()}
    want = {4: 0.5 + 3 * 2 / 4, 5: 0.5 + 3 / 4 + 5, 6: 3 / 4, 1: 4.0}
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], list(want.values()))
