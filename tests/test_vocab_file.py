"""The stored vocabulary against a dictionary."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textloom.operators import tokens, vocab_file

SCHEMA = "token STRING, token_id INT"


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=400))
def test_slots_are_perfect(found):
    hashes = np.array(sorted(found), dtype=np.uint64)
    seeds, slots = vocab_file.perfect_seeds(hashes)
    assert sorted(slots) == list(range(len(hashes)))
    seed = seeds[vocab_file._bucket(hashes, len(seeds))]
    own = np.where(seed < 0, -1 - seed, vocab_file._mixed(hashes, np.maximum(seed, 0), len(hashes)))
    assert (own == slots).all()


def test_lookup_against_a_dictionary(spark):
    known = {f"w{i}": i + 4 for i in range(5000)} | {"": 9000, "naïve": 9001, "長": 9002, "x" * 100_000: 9003}
    vocab = spark.createDataFrame(list(known.items()), SCHEMA)
    asked = [*known, *(f"v{i}" for i in range(5000)), None, "W1", "naive"]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(asked)] * 2, "doc_id INT, token STRING")
    for entries in (100, 10_000):
        store = vocab_file.store_vocab(vocab, entries)
        assert sum(total for _, total in store.shards) == len(known)
        got = tokens.lookup_ids(rows, store, unk_id=1).collect()
        assert len(got) == 2 * len(asked)
        assert all(r["token_id"] == known.get(r["token"], 1) for r in got)
        arrays = rows.groupBy((F.col("doc_id") % 7).alias("k")).agg(F.array_agg(F.struct("doc_id", "token")).alias("e"))
        arrays = arrays.select("e.token", vocab_file.stored_id_arrays(store, F.col("e.token"), 1).alias("ids"))
        for r in arrays.collect():  # array_agg keeps the NULL token, as it is inside a struct
            assert r["ids"] == [known.get(w, 1) for w in r["token"]]
        store.remove(spark)


def test_equal_hashes_stay_apart(spark, monkeypatch):
    """Every hash of the vocabulary and of the asked tokens is the same."""
    monkeypatch.setattr(vocab_file.F, "xxhash64", lambda _: F.lit(77).cast("bigint"))
    vocab = spark.createDataFrame([(f"w{i}", i) for i in range(50)], SCHEMA)
    store = vocab_file.store_vocab(vocab, 10)
    rows = spark.createDataFrame([(f"w{i}",) for i in range(60)], "token STRING")
    got = tokens.lookup_ids(rows, store, unk_id=-1).collect()
    assert {r["token"]: r["token_id"] for r in got} == {f"w{i}": i if i < 50 else -1 for i in range(60)}


def test_nothing_known_and_nothing_asked(spark):
    none = spark.createDataFrame([], SCHEMA)
    docs = spark.createDataFrame([(1, "a b"), (2, ""), (3, None), (3, None)], "doc_id INT, text STRING")
    rows = tokens.encode(docs, none, 5, limit=0).sort("doc_id").collect()
    assert [r["input_ids"] for r in rows] == [[2, 1, 1, 3, 0]] + [[2, 3, 0, 0, 0]] * 3
    store = vocab_file.store_vocab(spark.createDataFrame([("a", 4), (None, 5)], SCHEMA))
    assert tokens.encode(docs.limit(0), store, 5).collect() == []
    empty = docs.select("doc_id", F.lit(None).cast("array<string>").alias("t"))
    assert {tuple(r[0]) for r in empty.select(vocab_file.stored_id_arrays(store, F.col("t"))).collect()} == {()}


def test_a_token_twice_is_an_error(spark):
    for rows in ([("a", 4), ("a", 5)], [("a", None)]):
        with pytest.raises(PySparkException, match="vocabulary"):
            vocab_file.store_vocab(spark.createDataFrame(rows, SCHEMA))


def test_blocks_that_cannot_be_mapped_are_given_up(spark, monkeypatch):
    store = vocab_file.store_vocab(spark.createDataFrame([(f"w{i}", i) for i in range(300)], SCHEMA), 20)
    monkeypatch.setattr(vocab_file, "is_mapped", lambda _: False)
    monkeypatch.setattr(vocab_file, "HELD_BYTES", 1)
    reader = vocab_file._Reader(store)
    for shard, (_, rows) in enumerate(store.shards):
        assert reader.block(shard).num_rows == rows and len(reader.blocks) == 1
