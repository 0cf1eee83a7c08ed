"""Shards of exact sizes, and the law of the matrix that deals rows out."""

import random
from collections import Counter
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm.sharding import communication_matrix, hypergeometric, read_shards, shuffle_to_shards


def dealt(spark, docs, tmp_path, name, **settings):
    folder = str(tmp_path / name)
    shuffle_to_shards(docs, folder, **settings)
    return read_shards(spark, folder)


def check(rows, texts, shards):
    """Every row once, sizes at most one apart, slots without gaps."""
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(texts)
    sizes = Counter(r["shard"] for r in rows)
    assert [sizes[s] for s in range(shards)] == [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


@pytest.mark.parametrize("bucket_rows", [4096, 7])
def test_whole_table(spark, documents, tmp_path, bucket_rows):
    docs = documents.repartition(5)
    rows = dealt(spark, docs, tmp_path, f"b{bucket_rows}", shards=8, bucket_rows=bucket_rows).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in documents.collect()], 8)
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))] != sorted(r["doc_id"] for r in rows)


def test_matrix_in_chunks(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr("textloom.llm.sharding.CELLS", 6)
    monkeypatch.setattr("textloom.llm.sharding.BROADCAST_ROWS", 0)
    rows = dealt(spark, documents.repartition(7), tmp_path, "chunks", shards=3).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in documents.collect()], 3)


def test_edges(spark, edge_docs, no_docs, tmp_path):
    rows = dealt(spark, edge_docs, tmp_path, "edges", shards=4).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in edge_docs.collect()], 4)
    clash = edge_docs.withColumn("shard", F.lit("x")).withColumn("_part", F.lit(3)).withColumn("slot", F.lit(1))
    check(dealt(spark, clash, tmp_path, "clash", shards=4).collect(), [(r["doc_id"], r["text"]) for r in edge_docs.collect()], 4)
    none = dealt(spark, no_docs, tmp_path, "none", shards=4)
    assert none.columns == ["doc_id", "text", "slot", "shard"] and none.count() == 0
    few = dealt(spark, edge_docs.limit(2), tmp_path, "few", shards=4).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0)]


def test_seed_decides(spark, documents, tmp_path):
    order = lambda name, seed: [r["doc_id"] for r in dealt(spark, documents, tmp_path, name, seed=seed).sort("shard", "slot").collect()]
    first = order("a", 1)
    assert first == order("b", 1) and first != order("c", 2)


def test_plan_runs_no_python(spark, documents, tmp_path):
    text = dealt(spark, documents, tmp_path, "plan")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_matrix_sums():
    rows, shards = [0, 5, 70, 1, 24], [34, 33, 33]
    cells = np.array([taken for _, taken in communication_matrix(rows, shards, 3)])
    assert cells.sum(axis=1).tolist() == rows and cells.sum(axis=0).tolist() == shards and (cells >= 0).all()


@pytest.mark.parametrize("good,bad,drawn", [(6, 9, 5), (3, 2, 4), (50, 80, 40)])
def test_draws_have_the_hypergeometric_law(good, bad, drawn):
    rng, times = random.Random(11), 20_000
    seen = Counter(hypergeometric(good, bad, drawn, rng) for _ in range(times))
    law = {k: comb(good, k) * comb(bad, drawn - k) / comb(good + bad, drawn) for k in range(max(0, drawn - bad), min(good, drawn) + 1)}
    assert set(seen) <= set(law)
    assert sum((seen[k] / times - p) ** 2 / p for k, p in law.items()) * times < 3 * len(law) + 10


def test_urns_beyond_the_library():
    rng = random.Random(2)
    drawn = [hypergeometric(20_000_000_000, 60_000_000_000, 1_000_000, rng) for _ in range(20)]
    assert abs(np.mean(drawn) - 250_000) < 1000 and 100 < np.std(drawn) < 1200


def test_all_places_are_equally_likely(spark, tmp_path):
    """A row's shard and slot over many seeds."""
    docs = spark.range(4).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).repartition(2)
    seen = Counter()
    for seed in range(16):
        for r in dealt(spark, docs, tmp_path, f"s{seed}", shards=2, seed=seed).collect():
            seen[r["doc_id"], r["shard"], r["slot"]] += 1
    assert len(seen) == 16 and max(seen.values()) <= 10
