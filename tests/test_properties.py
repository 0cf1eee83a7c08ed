"""Laws that hold for any input, and results that do not depend on the chosen path."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textloom.functions import encoding
from textloom.functions import math as fm
from textloom.operators import batching, catalogue, neighbours, tokens, vectors
from textloom.operators.joins import lookup_join
from textloom.operators.ordering import build_order_index, rank_rows, running_sum
from textloom.sources import blocks, parameters

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab ,.!éß1\n", max_size=30)), min_size=1, max_size=12)


@few
@given(data=texts, max_length=st.integers(2, 12), limit=st.sampled_from([0, 1000]))
def test_encoding_laws(spark, data, max_length, limit):
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id BIGINT, text STRING")
    vocab = tokens.build_vocab(tokens.tokenize(docs), 5)
    rows = tokens.encode(docs, vocab, max_length, limit=limit).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(data)))
    for r in rows:
        assert len(r["input_ids"]) == len(r["attention_mask"]) == max_length
        assert sum(r["attention_mask"]) == r["seqlen"]
        assert r["attention_mask"] == sorted(r["attention_mask"], reverse=True)
        assert r["input_ids"][0] == 2 and r["input_ids"][r["seqlen"] - 1] == 3


@few
@given(data=st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["a b", "a b", "c", "", None])), max_size=12))
def test_encoding_is_the_same_on_both_paths(spark, data):
    """Also where ids and whole rows repeat."""
    docs = spark.createDataFrame([(i, t, "k") for i, t in data], "doc_id BIGINT, text STRING, lang STRING")
    vocab = spark.createDataFrame([("a", 4), ("c", 5)], "token STRING, token_id INT")
    small, large = (sorted(map(repr, tokens.encode(docs, vocab, 6, keep=("lang",), limit=n).collect())) for n in (1000, 0))
    assert small == large and len(small) == len(data)
    table = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "token_id INT, vector ARRAY<DOUBLE>")
    encoded = tokens.encode(docs, vocab, 6, keep=("lang",))
    for pooling in ("mean", "cls"):
        pooled = [vectors.pool_tokens(encoded, table, pooling, 2, ["doc_id", "lang"], limit=n).collect() for n in (1000, 0)]
        assert sorted(map(repr, pooled[0])) == sorted(map(repr, pooled[1])) and len(pooled[0]) == len(data)


@few
@given(text=st.text(alphabet="aé1 ,.\n漢\u0130", max_size=60), count=st.integers(0, 9))
def test_first_tokens_are_those_of_the_whole_text(spark, text, count):
    row = spark.createDataFrame([(text,)], "t STRING").select(
        encoding.first_tokens(F.col("t"), count).alias("first"), encoding.token_array(F.col("t")).alias("all")
    ).first()
    assert row["first"] == row["all"][:count]


masks = st.lists(st.lists(st.integers(0, 1), min_size=6, max_size=6), min_size=1, max_size=20)


@few
@given(rows=masks, size=st.integers(1, 7))
def test_unpad_repad_round_trip(spark, rows, size):
    data = [(i * 3, [p * b for p, b in zip(range(10, 16), m, strict=True)], m) for i, m in enumerate(rows)]
    df = spark.createDataFrame(data, "doc_id BIGINT, input_ids ARRAY<INT>, attention_mask ARRAY<INT>")
    batches = batching.assign_batches(batching.seq_lengths(df), "doc_id", size)
    flat = batching.unpad(batches)
    places = sorted((r["batch_id"], r["flat_pos"]) for r in flat.collect())
    totals = {r["batch_id"]: r["n"] for r in batches.groupBy("batch_id").agg(F.sum("seqlen").alias("n")).collect()}
    assert places == [(b, p) for b in sorted(totals) for p in range(totals[b])]
    back = {(r["batch_id"], r["slot"]): (r["input_ids"], r["attention_mask"]) for r in batching.repad(flat, 6, rows=batches).collect()}
    assert back == {(r["batch_id"], r["slot"]): (r["input_ids"], r["attention_mask"]) for r in batches.collect()}


@few
@given(
    keys=st.lists(st.integers(-(2**62), 2**62), min_size=1, max_size=60, unique=True),
    ranges=st.integers(1, 9),
)
def test_running_sum_over_any_keys(spark, keys, ranges):
    df = spark.createDataFrame([(k, abs(k) % 11) for k in keys], "k BIGINT, v INT")
    index = build_order_index(df, "k", "v", ranges)
    got = {r["k"]: r["s"] for r in running_sum(df, index, "v", "s").collect()}
    order = sorted(keys)
    assert got == dict(zip(order, np.cumsum([abs(k) % 11 for k in order]).tolist(), strict=True))


@few
@given(keys=st.lists(st.tuples(st.text(alphabet="abé", max_size=3), st.integers(-3, 3)), min_size=1, max_size=40, unique=True))
def test_ranks_over_several_columns(spark, keys):
    df = spark.createDataFrame(keys, "a STRING, b INT")
    got = {(r["a"], r["b"]): r["n"] for r in rank_rows(df, ["a", "b"], "n", unique=True, per_range=5).collect()}
    assert got == {key: i + 1 for i, key in enumerate(sorted(keys, key=lambda k: (k[0].encode(), k[1])))}


def test_equal_keys_have_no_order(spark):
    twice = spark.createDataFrame([(1, "x"), (2, "x"), (1, "y")], "k BIGINT, v STRING")
    with pytest.raises(PySparkException, match="occurs twice"):
        batching.assign_batches(twice, "k", 2).collect()
    with pytest.raises(PySparkException, match="occurs twice"):
        batching.assign_batches(twice, ["k"], 2).collect()
    assert batching.assign_batches(twice, ["k", "v"], 2).count() == 3


def test_order_is_not_made_in_one_partition(spark):
    df = spark.range(1000).withColumn("v", F.lit(1))
    index = build_order_index(df, "id", per_range=100)
    plan = batching.assign_batches(df, "id", 10, index)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_order_key_must_be_known(spark):
    keys = spark.createDataFrame([(1,), (2,), (None,)], "k BIGINT")
    with pytest.raises(PySparkException, match="no place in the order"):
        batching.assign_batches(keys, "k", 2).collect()
    index = build_order_index(spark.range(4, 8), "id", ranges=2)
    assert batching.assign_batches(spark.range(4, 8), "id", 2, index).count() == 4


@pytest.mark.parametrize("partitions", [1, 3, 11])
def test_batches_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(0, 500, 1, partitions).select((F.col("id") * 7919 % 100003).alias("k"))
    rows = batching.assign_batches(df, "k", 32).sort("k").collect()
    assert [(r["batch_id"], r["slot"]) for r in rows] == [(i // 32, i % 32) for i in range(500)]


numbers = st.lists(st.floats(-50, 50), min_size=1, max_size=8)


@few
@given(x=numbers)
def test_softmax_laws(spark, x):
    df = spark.createDataFrame([(x,)], "x ARRAY<DOUBLE>")
    row = df.select(
        fm.softmax(F.col("x")).alias("p"),
        fm.log_softmax(F.col("x")).alias("l"),
        fm.log_softmax(fm.log_softmax(F.col("x"))).alias("ll"),
    ).first()
    assert sum(row["p"]) == pytest.approx(1)
    assert row["ll"] == pytest.approx(row["l"], abs=1e-9)


@few
@given(
    positions=st.lists(st.integers(0, 40), min_size=1, max_size=25, unique=True),
    w=st.integers(0, 5),
    block=st.integers(1, 12),
)
def test_band_pairs_against_all_pairs(spark, positions, w, block):
    rows = spark.createDataFrame([(g, p) for g in (0, 1) for p in positions], "g INT, pos INT")
    got = sorted(tuple(r) for r in neighbours.band_pairs(rows, "g", "pos", w, block=block).collect())
    assert got == sorted((g, i, j) for g in (0, 1) for i in positions for j in positions if abs(i - j) <= w)


def plain_pool(x, mask, positions, w):
    scores = x @ x.T / np.sqrt(x.shape[1]) + (1 - mask) * -3.4028234663852886e38
    if w is not None:
        scores[np.abs(positions[:, None] - positions[None, :]) > w] = -np.inf
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True) @ x


@pytest.mark.parametrize(("w", "options"), [(None, {}), (None, {"block": 7}), (None, {"max_len": 64}), (3, {}), (3, {"block": 6})])
def test_neighbour_pool_against_numpy(spark, w, options):
    rng = np.random.default_rng(5)
    x, mask = rng.normal(size=(40, 4)), rng.integers(0, 2, 40)
    positions = np.sort(rng.choice(64, 40, replace=False))
    rows = [("g", int(p), v.tolist(), int(m)) for p, v, m in zip(positions, x, mask, strict=True)]
    df = spark.createDataFrame(rows, "g STRING, pos INT, vector ARRAY<DOUBLE>, mask INT")
    got = neighbours.neighbour_pool(df, "g", w=w, **options).sort("pos").collect()
    want = plain_pool(x, mask, positions, w)
    assert [r["pos"] for r in got] == positions.tolist()
    assert np.allclose([r["pooled"] for r in got], want, atol=1e-12)


def test_neighbour_pool_takes_separate_keys_and_values(spark):
    rows = [(0, 0, [1.0, 0.0], [0.0, 2.0], [5.0]), (0, 1, [0.0, 1.0], [2.0, 0.0], [7.0])]
    df = spark.createDataFrame(rows, "g INT, pos INT, q ARRAY<DOUBLE>, k ARRAY<DOUBLE>, v ARRAY<DOUBLE>")
    df = df.withColumn("mask", F.lit(1))
    far = 1 / (1 + np.exp(2 / np.sqrt(2)))  # weight of the key that does not match
    for options in ({}, {"block": 1}, {"max_len": 2}, {"w": 1}):
        got = neighbours.neighbour_pool(df, "g", query="q", key="k", value="v", **options).sort("pos").collect()
        assert got[0]["pooled"] == pytest.approx([5 * far + 7 * (1 - far)])
        assert got[1]["pooled"] == pytest.approx([5 * (1 - far) + 7 * far])


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(3)
    q, c = rng.integers(-3, 4, (30, 5)).astype(float), rng.integers(-3, 4, (50, 5)).astype(float)
    bias = rng.integers(-2, 3, 50).astype(float)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id BIGINT, vector ARRAY<DOUBLE>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "item_id BIGINT, vector ARRAY<DOUBLE>")
    shift = spark.createDataFrame([(i, b) for i, b in enumerate(bias.tolist())], "item_id BIGINT, bias DOUBLE")
    return queries, items, shift, q @ c.T + bias


@pytest.mark.parametrize("options", [{}, {"block_rows": 7}])
def test_topk_against_numpy_with_ties(scores, options):
    queries, items, bias, want = scores
    got = catalogue.topk_catalogue(queries, items, 6, bias, **options).sort("query_id", "rank").collect()
    expected = [
        (i, int(j), row[j], n + 1) for i, row in enumerate(want) for n, j in enumerate(np.argsort(-row, kind="stable")[:6])
    ]
    assert [(r["query_id"], r["item_id"], r["score"], r["rank"]) for r in got] == expected


@pytest.mark.parametrize("options", [{}, {"block_rows": 7}])
def test_all_scores_against_numpy(scores, options):
    queries, items, bias, want = scores
    got = np.full(want.shape, np.nan)
    for r in catalogue.score_catalogue(queries, items, bias, **options).collect():
        assert r["item_ids"] == sorted(r["item_ids"])
        got[r["query_id"], r["item_ids"]] = r["scores"]
    assert np.allclose(got, want)


def test_scores_that_are_no_numbers_come_last(spark):
    queries = spark.createDataFrame([(0, [1.0])], "query_id BIGINT, vector ARRAY<DOUBLE>")
    items = spark.createDataFrame([(0, [float("nan")]), (1, [2.0]), (2, [float("-inf")])], "item_id BIGINT, vector ARRAY<DOUBLE>")
    for options in ({}, {"block_rows": 1}):
        best = catalogue.topk_catalogue(queries, items, 3, **options).sort("rank").collect()
        assert [r["item_id"] for r in best] == [1, 2, 0]
        assert [r["item_id"] for r in catalogue.topk_catalogue(queries, items, 1, **options).collect()] == [1]
    assert catalogue.score_catalogue(queries, items.limit(0)).count() == 0


def test_a_stored_catalogue_serves_several_questions(spark, scores):
    queries, items, bias, want = scores
    store = catalogue.store_catalogue(items, bias, block_rows=7)
    assert sum(rows for _, rows in store.blocks) == 50 and len(store.blocks) > 3
    assert sorted(i for _, ids, _, _ in store.read() for i in ids) == list(range(50))
    top = catalogue.topk_catalogue(queries, store, 1).sort("query_id").collect()
    assert [r["item_id"] for r in top] == want.argmax(axis=1).tolist()
    assert catalogue.score_catalogue(queries, store).count() == 30 * len(store.blocks)
    with pytest.raises(ValueError, match="its bias already"):
        catalogue.score_catalogue(queries, store, bias)
    store.remove(spark)
    with pytest.raises(FileNotFoundError):
        list(store.read())


@pytest.mark.parametrize("options", [{}, {"block_rows": 7}, {"block_rows": 1}])
def test_loss_against_the_whole_catalogue(scores, options, monkeypatch):
    queries, items, bias, want = scores
    monkeypatch.setattr(catalogue, "QUERY_ENTRIES", 20)
    target = np.arange(30) * 11 % 50
    asked = queries.withColumn("target", F.col("query_id") * 11 % 50)
    got = {r["query_id"]: r["loss"] for r in catalogue.catalogue_loss(asked, items, bias, **options).collect()}
    plain = np.log(np.exp(want).sum(axis=1)) - want[np.arange(30), target]
    assert np.allclose([got[i] for i in range(30)], plain, rtol=1e-12)


def test_loss_of_large_scores_and_unknown_targets(spark):
    queries = spark.createDataFrame([(0, [1.0], 1)], "query_id BIGINT, vector ARRAY<DOUBLE>, target BIGINT")
    items = spark.createDataFrame([(0, [-2000.0]), (1, [2000.0]), (2, [1999.0]), (3, [float("-inf")])], "item_id BIGINT, vector ARRAY<DOUBLE>")
    for rows in (1, 4096):
        (row,) = catalogue.catalogue_loss(queries, items, block_rows=rows).collect()
        assert row["loss"] == pytest.approx(np.log1p(np.exp(-1.0)))
    for target in (9, None):
        asked = queries.withColumn("target", F.lit(target).cast("bigint"))
        with pytest.raises(Exception, match="no item of the catalogue|has no target"):
            catalogue.catalogue_loss(asked, items).collect()


def test_blocks_are_files_of_one_batch(tmp_path):
    rows = pa.table({"a": [1, 2, 3]})
    for address in (f"{tmp_path}/x/1.arrow", f"file://{tmp_path}/y z/2.arrow", f"file:{tmp_path}/x/1.arrow"):
        blocks.write_block(address, rows)
        blocks.write_block(address, rows)  # a repeated task
        assert blocks.read_block(address).equals(rows)
    assert sorted(p.name for p in tmp_path.rglob("*.arrow*")) == ["1.arrow", "2.arrow"]


def test_triples_merge_in_any_order():
    rng = np.random.default_rng(1)
    q, k, v = rng.normal(size=(5, 4)), rng.normal(size=(12, 4)) * 9, rng.normal(size=(12, 3))
    bias = np.where(rng.random(12) < 0.3, neighbours.MASKED_BIAS, 0.0)
    _, weight, summed = neighbours._partial_pool(q, k, v, bias, None)
    for order in (range(3), (2, 0, 1)):
        triple = np.full(5, -np.inf), np.zeros(5), np.zeros((5, 3))
        for i in order:
            part = slice(4 * i, 4 * i + 4)
            triple = neighbours._merged(triple, neighbours._partial_pool(q, k[part], v[part], bias[part], None))
        assert np.allclose(triple[2] / triple[1][:, None], summed / weight[:, None], rtol=1e-12)


def test_unknown_mask_counts_as_masked(spark):
    rows = [(0, 0, [1.0, 0.0], 1), (0, 1, [0.0, 1.0], None)]
    df = spark.createDataFrame(rows, "g INT, pos INT, vector ARRAY<DOUBLE>, mask INT")
    for options in ({}, {"w": 1}, {"max_len": 2}, {"block": 1}):
        got = neighbours.neighbour_pool(df, "g", **options).collect()
        assert [r["pooled"] for r in got] == [pytest.approx([1.0, 0.0])] * 2


def test_repeated_entries_are_no_matrix(spark):
    cells = [("w", 0, 0, 9.0), ("w", 0, 0, 8.0), ("w", 0, 1, 2.0), ("w", 1, 1, 3.0)]
    params = spark.createDataFrame(cells, parameters.PARAMETER_SCHEMA)
    for check in (lambda: parameters.check_shape(params, "w", (2, 2)), lambda: parameters.matrix(params, "w")):
        with pytest.raises(ValueError, match="2x2"):
            check()


def test_linear_paths_agree(spark):
    rng = np.random.default_rng(4)
    x, w, b = rng.normal(size=(20, 6)), rng.normal(size=(3, 6)), rng.normal(size=3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id BIGINT, v ARRAY<DOUBLE>")
    entries = [(r, c, float(w[r, c])) for r in range(3) for c in range(6)]
    weight = spark.createDataFrame(entries, "row INT, col INT, theta DOUBLE")
    bias = spark.createDataFrame([(r, float(b[r])) for r in range(3)], "row INT, theta DOUBLE")
    dense = df.select("id", vectors.linear(F.col("v"), w, b).alias("y")).sort("id").collect()
    assert np.allclose([r["y"] for r in dense], x @ w.T + b)
    long = np.full((20, 3), np.nan)
    for block_rows in (1000, 1):
        for r in vectors.linear_by_join(df, "id", "v", weight, bias, block_rows).collect():
            long[r["id"], r["row"]] = r["value"]
        assert np.allclose(long, x @ w.T + b)


def test_hot_token_with_large_vocabulary(spark):
    """One token in a third of all places, looked up with a vocabulary taken as large."""
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("hot hot "), F.expr("'w' || id % 40"), F.expr("' v' || id")).alias("text")
    )
    vocab = tokens.build_vocab(tokens.tokenize(docs), 30)
    small = tokens.encode(docs, vocab, 8).sort("doc_id").collect()
    large = tokens.encode(docs, vocab, 8, limit=0).sort("doc_id").collect()
    assert small == large


@pytest.mark.parametrize("small", [None, False])
def test_hot_class(spark, small):
    """A class with most of the rows, with the class map taken as small or as large."""
    rows = spark.range(500).select("id", F.when(F.col("id") % 5 > 0, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    table = spark.createDataFrame([("hot", 0), ("5", 1)], "c STRING, n INT")
    got = lookup_join(rows, table, "c", spread=["id"], small=small, per_copy=50)
    counts = {r["n"]: r["count"] for r in got.groupBy("n").count().collect()}
    assert counts == {0: 400, 1: 1, None: 99}
