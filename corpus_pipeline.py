"""From raw documents to token ids: the stages of the pipeline, in order.

Each stage takes what its predecessor kept, whole, and returns rows with the columns of documents;
the last returns ids. Tables may be empty and have more columns, whatever their names, which the
first four stages keep as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.bpe_fst import encode_texts
from textloom.llm.decontaminate import drop_contaminated
from textloom.llm.language import keep_identified
from textloom.llm.quality import keep_quality
from textloom.llm.simhash import drop_near_duplicates
from textloom.session import cleaned, remove_path, work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more.

    NULL is judged as the empty text; repeated rows stay or go together; texts are read whole.
    """
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is identified with a score of one half or more.

    NULL and texts without letters go; repeated rows stay or go together; of equal scores the
    first language by name wins.
    """
    return keep_identified(docs, least=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of 4-word shingles differ in 4 bits at most.

    The smallest id stays, of its rows the lowest; NULL and texts without words are one group.
    """
    return drop_near_duplicates(docs, shingle=4, budget=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a passage of the benchmark.

    NULL and texts without words stay; repeated rows stay or go together.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_tokens)`` of every document that is left.

    NULL and empty texts have no ids; repeated rows are repeated.
    """
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_texts(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, out="ids")
    return encoded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Learned models, fingerprints and merges are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each is written to the shared folder and read again.

    What a stage stored on its way goes when it is written, and its input when the next is; only
    the last table is left. A stage that fails leaves nothing behind.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline_{name}")
        try:
            with cleaned(spark):
                stage(spark, docs, sf_dir).write.parquet(path)
        except BaseException:
            remove_path(spark, path)
            raise
        finally:
            if before is not None:
                remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
