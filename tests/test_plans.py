"""The physical plans are the ones the operators are designed for."""

import pytest
from pyspark.sql import functions as F

from textloom.operators import batching, catalogue, joins, neighbours, ordering, tokens, training
from textloom.operators.head import score_head
from textloom.plans import text_queries, vector_queries, workflows
from textloom.sources.corpus import read_documents

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark):
    return read_documents(spark, f"{SF}/documents.parquet")


def test_encoding_with_small_vocabulary_does_not_shuffle(spark, docs):
    vocab = spark.createDataFrame([("the", 4)], "token STRING, token_id INT")
    text = plan(tokens.encode(docs, vocab))
    assert "Exchange" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_vocabulary_counts_once(docs):
    vocab = tokens.build_vocab(tokens.tokenize(docs), 50)
    vocab.collect()
    text = plan(vocab)
    assert "ReusedExchange" in text
    assert "TakeOrderedAndProject" in text and "partial_count" in text
    assert "ReadSchema: struct<text:string>" in text


def test_batches_read_the_key_only_and_shuffle_once(docs):
    text = plan(batching.assign_batches(docs.select("doc_id"), "doc_id", 32))
    assert "ReadSchema: struct<doc_id:bigint>" in text
    assert text.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in text


def test_band_needs_no_self_join(docs):
    text = plan(neighbours.band_pairs(tokens.tokenize(docs), "doc_id", "pos", 3))
    assert "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_scoring_does_not_shuffle(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert "Exchange" not in plan(score_head(rows, "embedding", vector_queries.model()))


def test_gradient_sums_before_the_shuffle(spark):
    m = vector_queries.model()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    text = plan(training.head_gradient(rows, m.weight, m.bias, features="embedding"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text
    assert "ReadSchema: struct<embedding:array<float>,label:int>" in text


def test_step_reads_one_batch(spark, tmp_path):
    path = str(tmp_path / "batches")
    rows = spark.range(100).select("id", F.array(F.lit(1.0)).alias("features"), F.lit(0).alias("label"))
    sizes = training.write_batches(rows, "id", 30, "features", "label", path)
    assert sizes == [(0, 30), (1, 30), (2, 30), (3, 10)]
    step = spark.read.parquet(path).where("batch_id = 2")
    files = step.select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("batch_id=2" in r["f"] for r in files)
    assert "PartitionFilters: [isnotnull(batch_id" in plan(step)


@pytest.fixture
def no_broadcast(spark):
    """Both of Spark's own size rules off, so that what is planned as a shuffle runs as one."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_large_vocabulary_moves_no_token(spark, docs):
    vocab = spark.createDataFrame([("the", 4), ("and", 5)], "token STRING, token_id INT")
    for found in (tokens.encode(docs, vocab, limit=0), tokens.lookup_ids(tokens.tokenize(docs), vocab, limit=0)):
        text = plan(found)
        assert "Exchange" not in text and "Join" not in text and text.count("FileScan parquet") == 1


def test_only_hot_keys_are_copied(spark, no_broadcast):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 600, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    table = rows.select("c").distinct().withColumn("n", F.lit(1))
    joined = joins.lookup_join(rows, table, "c", ["id"], small=False, per_copy=100)
    assert "_salt" in plan(joined) and joined.count() == 1000
    copies = joins.heavy_keys(rows, "c", 100).collect()
    assert [tuple(r) for r in copies] == [("hot", 6)]
    assert "_salt" not in plan(joins.lookup_join(rows, table, "c", ["id"], small=False))


def test_lengths_need_no_vocabulary(docs):
    text = plan(workflows.packing_report(workflows.packed_lengths(docs, 32)))
    assert "Arrow" not in text and text.count("FileScan parquet") == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert "ArrowEvalPython" not in plan(batching.seq_lengths(tokens.encoded_lengths(docs).drop("seqlen")))


def test_encoding_does_not_move_texts(spark):
    rows = text_queries.QUERIES["t8_encode"](spark, SF)
    assert "Exchange" not in plan(rows)


def test_array_pairs_are_not_shuffled(docs):
    rows = docs.select("doc_id", F.split("text", " ").alias("tokens"))
    assert "Exchange" not in plan(neighbours.band_pairs_of_arrays(rows, "doc_id", "tokens", 3))


def test_queries_of_a_catalogue_stay_put(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    queries = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    items = rows.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    store = catalogue.store_catalogue(items, block_rows=100)
    asked = queries.withColumn("target", F.lit(1))
    found = catalogue.score_catalogue(queries, store), catalogue.topk_catalogue(queries, store, 3), catalogue.catalogue_loss(asked, store)
    for scored in found:
        text = plan(scored)
        assert "Exchange" not in text and "Broadcast" not in text
        assert text.count("MapInArrow") == 1 and text.count("FileScan parquet") == 1


def test_vectors_of_a_group_are_shuffled_once(spark, monkeypatch):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").selectExpr("label", "vec_id", "embedding", "1 AS mask")
    seen = []
    keep = neighbours.stored
    monkeypatch.setattr(neighbours, "stored", lambda df, name: seen.append(plan(df)) or keep(df, name))
    pooled = neighbours.neighbour_pool(rows, "label", pos="vec_id", query="embedding", block=100)
    assert len(seen) == 1 and seen[0].count("Exchange hashpartitioning") == 1 and "Join" not in seen[0]
    text = plan(pooled)  # what is left moves names of blocks only
    assert "_mask" not in text and "embedding" not in text and "MapInArrow" in text


def test_ranges_follow_the_rows():
    assert ordering.range_count(100_000_000) == 100 * ordering.range_count(1_000_000) == 400
