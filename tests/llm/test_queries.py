"""The registered queries beside their SQL or a brute-force version, and the pipeline."""

import os
import re

import public_tokenizers as public
import pytest
import tiktoken

import __spark_entry__ as spark_entry
import corpus_pipeline
import oracle_check
from textloom.llm import bpe_fst, queries
from textloom.llm.decontaminate import Finder
from textloom.session import stored, work_path

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "vec_id n_links component_id kept",
    "op2": "doc_id held_out lang_pred score",
    "op3": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op4": "doc_id held_out score predicted",
    "op5": "doc_id n_bytes n_tokens over_limit",
    "op6": "doc_id fingerprint component_id",
    "op7": "doc_id start n_tokens ids_crc32",
    "op8": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op9": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10": "page_id url text n_chars",
    "op11": "vec_id code error label_error codebooks_sha256",
    "op12": "doc_id size text_crc32 law shard slot grown_shard",
    "op13": "word form root n n_near form_n",
}


def test_every_operator_has_one_query():
    assert sorted(name.split("_")[0] for name in queries.QUERIES) == sorted(COLUMNS)
    assert set(queries.QUERIES) | {"pipeline"} <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    rows = queries.QUERIES[name](spark, SF)
    assert rows.columns == COLUMNS[name.split("_")[0]].split()
    got = rows.toArrow()
    if name in queries.ORACLES:
        want = oracle_check.connect(SF).sql(queries.ORACLES[name]).to_arrow_table()
        assert oracle_check.difference(got.to_pandas(), want.to_pandas()) is None
        assert oracle_check.type_difference(got.schema, want.schema) is None


def test_pipeline_step_by_step(spark):
    """Each stage keeps rows as they are; what decides by rule is checked against that rule."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "decontamination", "encoding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        before, now = ({r["doc_id"]: r for r in df.collect()} for df in (docs, after))
        assert all(before[i] == now[i] for i in now) and now
        kept[name] = (before, now)
        docs = spark.createDataFrame(list(now.values()), docs.schema)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, now = kept["quality"]
    good = [i for i in before if labels.get(i) == 1]
    assert sum(i in now for i in good) >= 0.98 * len(good)
    before, now = kept["decontamination"]
    finder = Finder([(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    found = {i: finder.find(r["text"]) for i, r in before.items()}
    assert set(now) == {i for i, (n, hits, _, _) in found.items() if not hits or 20 * len(hits) < n}
    ranks = bpe_fst.load_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {i: library.encode_ordinary(r["text"]) for i, r in now.items()}


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "ids", "n_tokens"] and rows.count() > 100


def folders(spark):
    root = work_path(spark, "x").rsplit("/", 1)[0]
    return set(os.listdir(re.sub("^file:", "", root))) if os.path.isdir(re.sub("^file:", "", root)) else set()


def test_pipeline_leaves_its_last_table_only(spark, monkeypatch):
    def first(spark, docs, sf_dir):
        return stored(docs.limit(3), "on_the_way")

    def fails(spark, docs, sf_dir):
        stored(docs, "on_the_way")
        raise RuntimeError("stop")

    before = folders(spark)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", first), ("two", first)])
    assert corpus_pipeline.run(spark, SF).count() == 3
    left = folders(spark) - before
    assert len(left) == 1 and left.pop().startswith("pipeline_two")
    before = folders(spark)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", first), ("two", fails)])
    with pytest.raises(RuntimeError, match="stop"):
        corpus_pipeline.run(spark, SF)
    assert folders(spark) == before


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_edge_rows(spark, edge_docs, no_docs, empty):
    """Each stage alone: NULL, empty and long texts, repeated rows, clashing names, an empty table."""
    docs = no_docs if empty else edge_docs.withColumn("language", edge_docs["score"]).withColumn("text_hash", edge_docs["found"])
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name == "encoding":
            assert after.columns == ["doc_id", "ids", "n_tokens"] and after.count() == docs.count()
        else:
            assert after.columns == docs.columns
            assert after.exceptAll(docs).count() == 0
