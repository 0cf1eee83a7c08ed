"""Encoding, scoring and prediction on a stream equal the same work on the table."""

import numpy as np
from pyspark.sql import functions as F

from textloom.operators.head import Head, predict, score_head
from textloom.operators.scoring import score_batches
from textloom.operators.tokens import encode
from textloom.sources.corpus import read_documents
from textloom.streaming.documents import stream_documents, write_stream


def score(df, vocab, head):
    coded = encode(df, vocab, max_length=8)
    vector = F.transform("input_ids", lambda i: i.cast("double"))
    return predict(score_head(coded.withColumn("vector", vector), "vector", head)).select("doc_id", "input_ids", "predicted")


def test_stream_equals_table(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "checkpoint"))
    rows = [(i, "a b c " * (i % 4)) for i in range(20)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3).write.parquet(source)
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "token STRING, token_id INT")
    rng = np.random.default_rng(1)
    head = Head(np.ones(8), rng.normal(size=(8, 8)), rng.normal(size=(3, 8)), np.zeros(3))
    stream = score(stream_documents(spark, source, max_files=1), vocab, head)
    write_stream(stream, out, checkpoint).awaitTermination(120)
    got = spark.read.parquet(out).sort("doc_id").collect()
    assert got == score(read_documents(spark, source), vocab, head).sort("doc_id").collect()
    assert len(got) == 20


def test_user_hook_on_stream(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "checkpoint"))
    spark.createDataFrame([(1, "x"), (2, "y")], "doc_id BIGINT, text STRING").write.parquet(source)
    stream = score_batches(stream_documents(spark, source), lambda batch: batch, "doc_id BIGINT, text STRING")
    write_stream(stream, out, checkpoint).awaitTermination(120)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, "x"), (2, "y")]
