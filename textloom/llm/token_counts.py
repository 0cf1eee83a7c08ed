"""Token counts by a two-tier lookup on the map side."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.hf_tokens import HfTokens, hf_tokens
from textloom.llm.worker import release

# Runs in the broadcast table, the signs of texts that a task counts before it sends their counts on, and the
# tasks that take the most frequent of all from the most frequent of each, so that the driver gets few rows.
TABLE_RUNS = 16_384
PART_SIGNS = 1 << 22
LAST_TASKS = 4


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, int]]:
    """Counts of the runs of some texts after the other, those with a space before them that are short enough for the table."""
    seen, signs = Counter(), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update((text or "").split(" ")[1:])
            signs += len(text or "")
            if signs >= PART_SIGNS:
                yield {run: n for run, n in seen.items() if len(run) <= 64}
                seen, signs = Counter(), 0
    yield {run: n for run, n in seen.items() if len(run) <= 64}


def _digests(runs: Iterable[str]) -> np.ndarray:
    """A number of 64 bits for each run, the same in every process."""
    return np.frombuffer(b"".join(blake2b(run.encode(), digest_size=8).digest() for run in runs), ">i8").astype(np.int64)


def _names(texts: DataFrame, parts: Mapping[int, int | None]) -> dict[int, str]:
    """Runs by digest, each looked for in the given partition, or in all for None."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        here = TaskContext.get().partitionId()
        left = {digest for digest, part in parts.items() if part in (here, None)}
        for seen in _counts(batch for batch in batches if left):
            found = {digest: run for digest, run in zip(_digests(seen).tolist(), seen) if digest in left}
            left.difference_update(found)
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.string())], ["digest", "run"])

    return {row["digest"]: row["run"] for row in texts.mapInArrow(find, "digest bigint, run string").collect()}


def frequent_runs(docs: DataFrame, size: int = TABLE_RUNS, text_col: str = "text") -> list[str]:
    """The most frequent runs of all texts between spaces, the most frequent first, ``size`` at most.

    Every run behind a space counts that is not longer than 64 characters and seen more than once.
    Tasks count whole texts, and the counts are added up by digests of the runs, so no pre-token is
    shuffled; the runs chosen are then read off the first partition that has them. Digests decide
    between equal counts. The choice decides how often the first tier answers and never changes a count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for seen in _counts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(_digests(seen)), pa.array(seen.values(), pa.int64())], ["digest", "n"])

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*kept, batch])
            kept = table.sort_by([("n", "descending"), ("digest", "ascending")]).slice(0, size).to_batches()
        yield from kept

    texts = docs.select(F.col(text_col).alias("text"))
    counted = texts.mapInArrow(count, "digest bigint, n bigint").withColumn("part", F.spark_partition_id())
    sums = counted.groupBy("digest").agg(F.sum("n").alias("n"), F.min("part").alias("part")).where("n > 1")
    merged = sums.mapInArrow(most, sums.schema).repartition(LAST_TASKS).mapInArrow(most, sums.schema)
    top = merged.orderBy(F.desc("n"), "digest").limit(size).collect()
    names = _names(texts, {row["digest"]: row["part"] for row in top}) if top else {}
    moved = {row["digest"]: None for row in top if row["digest"] not in names}  # where a second run deals rows otherwise
    names |= _names(texts, moved) if moved else {}
    return [run for _, run in sorted((-row["n"], names[row["digest"]]) for row in top if row["digest"] in names)]


def frequent_lengths(docs: DataFrame, path: str, size: int = TABLE_RUNS, text_col: str = "text") -> dict[str, int]:
    """Token counts of frequent runs, each with the space before it; ``size`` entries at most."""
    runs = frequent_runs(docs, size, text_col=text_col)
    return dict(zip(runs, HfTokens(path, counting=True).codes([" " + run for run in runs])))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, table_size: int = TABLE_RUNS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of whole texts, one row for each input row.

    The first tier is a broadcast table of the lengths of the most frequent runs of all texts, at
    most ``table_size`` entries of at most 64 characters. What it misses is encoded once by each
    worker, which remembers lengths up to a bound in bytes. NULL counts as the empty text: no bytes,
    no tokens. Rows with equal ids stay rows of their own; other columns are left out, whatever
    their names.
    """
    tier = uuid.uuid4().hex
    known = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, table_size, text_col))

    @F.arrow_udf("struct<n_bytes: bigint, n_tokens: bigint>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = hf_tokens(path, counting=True, known=known.value, name=tier)
        for batch in batches:
            texts = [text or "" for text in batch.to_pylist()]
            sizes = pa.array([len(text.encode()) for text in texts], pa.int64())
            counts = pa.array(list(library.codes(texts)), pa.int64())
            yield pa.StructArray.from_arrays([sizes, counts], ["n_bytes", "n_tokens"])

    measured = docs.select(F.col(id_col).alias("doc_id"), measure(F.col(text_col)).alias("found"))
    return measured.select("doc_id", "found.n_bytes", "found.n_tokens", (F.col("found.n_tokens") > limit).alias("over_limit"))
