"""Token ids in ORC files, in document order.

A file is one range of document ids, sorted, so the column statistics of stripes and row groups
are narrow ranges of ids; a Bloom filter on the id rules out further stripes for a point lookup.
ORC stores the integer columns run-length encoded, and readers take stripes in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from textloom.llm.hf_tokens import hf_tokens
from textloom.llm.worker import release

ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "compression": "zstd",
}

# Rows of a document's ids that a task holds before it hands them on.
BATCH_IDS = 1 << 20


def write_token_orc(docs: DataFrame, folder: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write ``(doc_id, part, part_start, n_tokens, ids)`` in order of ``doc_id``.

    ``ids`` ends with ``end_id``; ``part`` numbers the files in order and ``part_start`` counts
    the ids of earlier rows of the same file. Texts are shuffled once, before they are encoded.
    Order: NULL ids first; equal ids by the hash and then the bytes of their text, so a
    repeated task writes the same file. NULL text is the empty text: only ``end_id``.
    Repeated rows stay, other columns are left out. An empty table gives an empty folder's table.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, part, before = hf_tokens(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        names = ["doc_id", "part", "part_start", "n_tokens", "ids"]

        def block(keys: list, coded: list[bytes], start: int) -> pa.RecordBatch:
            sizes = np.array([len(ids) // 4 for ids in coded], dtype=np.int64)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            flat = pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
            columns = [
                pa.array(keys, pa.int64()),
                pa.array(np.full(len(keys), part, dtype=np.int32)),
                pa.array(start + ends[:-1]),
                pa.array(sizes),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            keys, coded, held = [], [], 0
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for key, ids in zip(batch.column(0).to_pylist(), library.codes(texts)):
                keys.append(key)
                coded.append(ids + end)
                held += len(coded[-1]) // 4
                if held >= BATCH_IDS:
                    yield block(keys, coded, before)
                    keys, coded, held, before = [], [], 0, before + held
            yield block(keys, coded, before)
            before += held

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = texts.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    schema = "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"
    ordered.mapInArrow(encode, schema).write.options(**ORC_OPTIONS).orc(folder)


def read_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``; ``start`` counts the ids of all documents before.

    Totals of the files, one row for each, are the only thing that is gathered.
    """
    rows = spark.read.orc(folder)
    totals = sorted(rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before = np.cumsum([0, *(row["n"] for row in totals)]).tolist()
    starts = spark.createDataFrame([(row["part"], n) for row, n in zip(totals, before)], "part int, part_before bigint")
    placed = rows.join(F.broadcast(starts), "part")  # as many rows as files
    return placed.select("doc_id", (F.col("part_before") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def lookup_tokens(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of some documents; the id filter reaches the files' indexes."""
    return spark.read.orc(folder).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


@F.arrow_udf(LongType())
def ids_crc32(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Unsigned CRC-32 of an array of ids as little-endian unsigned 32-bit integers."""
    release()  # what encoding remembered is not needed to read
    for batch in batches:
        flat = memoryview(batch.flatten().to_numpy().astype("<u4").tobytes())
        ends = 4 * np.concatenate(([0], np.cumsum(batch.value_lengths().fill_null(0).to_numpy()))).astype(np.int64)
        yield pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.int64())
