"""Scores of query vectors against every row of an embedding table.

The catalogue is stored once in the shared folder, in blocks with a manifest of their sizes. Queries
stay where they are: a task holds some of its queries and goes through the blocks one at a time,
reading each from the folder itself. Neither the driver nor a broadcast sees a catalogue row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import dense
from textloom.session import remove_path, work_path
from textloom.sources.blocks import read_block, write_block

# Rows of a block of the catalogue.
BLOCK_ROWS = 4096

# Scores computed at a time within a task (64 MB of doubles), and vector entries of the queries it holds (32 MB).
SCORES_AT_ONCE = 8_000_000
QUERY_ENTRIES = 4_000_000

# Scores made at a time where they are folded at once; they stay in the cache of the processor (4 MB of doubles).
CELLS_AT_ONCE = 500_000

Block = tuple[int, np.ndarray, np.ndarray, np.ndarray]

# For each column: how the numbers of two blocks are joined, and the number of each query from items and scores.
Fold = Mapping[str, tuple[np.ufunc, Callable[[np.ndarray, np.ndarray], np.ndarray]]]


@dataclass(frozen=True)
class StoredCatalogue:
    """The folder of a catalogue and, for each of its blocks, the number and the count of rows."""

    folder: str
    blocks: tuple[tuple[int, int], ...]

    def read(self) -> Iterator[Block]:
        """Number, items, vectors and bias of one block after the other, items ascending."""
        for number, _ in self.blocks:
            rows = read_block(f"{self.folder}/{number}.arrow")
            yield number, rows["item_id"].to_numpy(), dense.to_matrix(rows["vector"]), rows["bias"].to_numpy()

    def widest(self) -> int:
        return max((rows for _, rows in self.blocks), default=0)

    def remove(self, spark: SparkSession) -> None:
        """Remove the files; results that are not computed yet cannot be after that."""
        remove_path(spark, self.folder)


def store_catalogue(catalogue: DataFrame, bias: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> StoredCatalogue:
    """Store ``(item_id, vector)`` and the ``(item_id, bias)`` of its items for the functions below.

    A block holds about ``block_rows`` items by a hash of the id. Items are shuffled once, to the
    tasks that write their blocks; the driver gets two numbers for each block. An item without
    bias has bias 0.
    """
    spark = catalogue.sparkSession
    folder = work_path(spark, "catalogue")
    blocks = max(1, -(-catalogue.count() // block_rows))
    item = F.col("item_id").cast("bigint").alias("item_id")
    table = catalogue.select(item, "vector", F.lit(0.0).alias("bias"))
    if bias is not None:
        shifts = bias.select(item, F.col("bias").cast("double").alias("bias"))
        table = catalogue.select(item, "vector").join(shifts, "item_id", "left").withColumn("bias", F.coalesce("bias", F.lit(0.0)))
    table = table.select("item_id", F.col("vector").cast("array<double>").alias("vector"), "bias")

    def write(rows: pa.Table) -> pa.Table:
        number = rows["block"][0].as_py()
        dense.to_matrix(rows["vector"])  # vectors of a block are present and of one length
        write_block(f"{folder}/{number}.arrow", rows.select(["item_id", "vector", "bias"]).sort_by("item_id"))
        return pa.table({"block": pa.array([number], pa.int64()), "rows": pa.array([rows.num_rows], pa.int64())})

    numbered = table.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    manifest = numbered.groupBy("block").applyInArrow(write, "block BIGINT, rows BIGINT").collect()
    return StoredCatalogue(folder, tuple(sorted((row["block"], row["rows"]) for row in manifest)))


def _stored(catalogue: DataFrame | StoredCatalogue, bias: DataFrame | None, block_rows: int) -> StoredCatalogue:
    if isinstance(catalogue, StoredCatalogue):
        if bias is not None:
            raise ValueError("a stored catalogue has its bias already")
        return catalogue
    return store_catalogue(catalogue, bias, block_rows)


def _chunks(rows: int, width: int) -> Iterator[slice]:
    step = max(1, SCORES_AT_ONCE // max(width, 1))
    return (slice(i, min(i + step, rows)) for i in range(0, rows, step))


def _groups(batches: Iterator[pa.RecordBatch], widest: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Query rows, gathered until they hold ``QUERY_ENTRIES`` vector entries, and their vectors.

    A group is also small enough that its scores against one block may be held.
    """
    held: list[pa.RecordBatch] = []

    def handed_on() -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()
        held.clear()
        for batch in rows:
            for part in _chunks(batch.num_rows, widest):
                own = batch.slice(part.start, part.stop - part.start)
                yield own, dense.to_matrix(own.column(1))

    entries = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            entries += len(batch.column(1).flatten())
        if entries >= QUERY_ENTRIES:
            yield from handed_on()
            entries = 0
    if held:
        yield from handed_on()


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each row, the earlier one among ties; NaN comes last, behind minus infinity."""
    missing = np.isnan(scores)
    scores = np.where(missing, -np.inf, scores)
    rows, width = scores.shape
    if k >= width:
        return np.lexsort((missing, -scores), axis=1)
    least = np.partition(scores, width - k, axis=1)[:, width - k, None]
    row, col = np.nonzero(scores >= least)  # all that tie with the k-th too
    order = np.lexsort((col, missing[row, col], -scores[row, col], row))
    first = np.searchsorted(row, np.arange(rows))
    return col[order][first[:, None] + np.arange(k)]


def _folded(batches: Iterator[pa.RecordBatch], store: StoredCatalogue, fold: Fold) -> Iterator[pa.RecordBatch]:
    """A task reads each block once for all queries it holds, and makes ``CELLS_AT_ONCE`` scores at a time."""
    for rows, x in _groups(batches, 1):
        held: list[np.ndarray] = []
        for _, items, vectors, shift in store.read():
            first = not held
            held = held or [np.empty(len(x)) for _ in fold]
            step = max(1, CELLS_AT_ONCE // max(1, len(items)))
            for i in range(0, len(x), step):
                part = slice(i, i + step)
                scores = x[part] @ vectors.T
                scores += shift
                for column, (join, of) in zip(held, fold.values()):
                    found = of(items, scores)
                    column[part] = found if first else join(column[part], found)
        if held:
            yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, held)], ["query_id", *fold])


def score_catalogue(
    queries: DataFrame,
    catalogue: DataFrame | StoredCatalogue,
    bias: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    fold: Fold | None = None,
) -> DataFrame:
    """All scores: the dot product with each catalogue vector plus the bias of that item.

    ``queries`` is ``(query_id, vector)``, ``catalogue`` is ``(item_id, vector)`` or a stored one,
    and ``bias`` is ``(item_id, bias)``. The result has dense rows, ``(query_id, block,
    item_ids, scores)``, one for each query and block of the catalogue, with items ascending. No
    query row is shuffled. The result has queries times items scores by its definition;
    ``topk_catalogue`` and ``catalogue_loss`` are the ones to use where the best, or one score
    beside the sum of all, will do.

    With ``fold`` the dense rows are folded where they are made, and no score leaves its task: the
    result is ``(query_id, *fold)``, one row of doubles for each query row. The function of a
    column gets the items of a block and the scores of some queries with all of them, and gives a
    number for each query; its ufunc joins the numbers of two blocks.
    """
    store = _stored(catalogue, bias, block_rows)
    asked = queries.select(F.col("query_id").cast("bigint"), "vector")
    if fold is not None:
        schema = ", ".join(["query_id BIGINT", *(f"`{name}` DOUBLE" for name in fold)])
        return asked.mapInArrow(lambda batches: _folded(batches, store, fold), schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _groups(batches, store.widest()):
            for number, items, vectors, shift in store.read():
                scores = x @ vectors.T + shift
                names = np.broadcast_to(items, scores.shape)
                block = pa.array(np.full(len(scores), number), pa.int32())
                columns = [rows.column(0), block, dense.to_lists(names), dense.to_lists(scores)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "block", "item_ids", "scores"])

    return asked.mapInArrow(score, "query_id BIGINT, block INT, item_ids ARRAY<BIGINT>, scores ARRAY<DOUBLE>")


def topk_catalogue(
    queries: DataFrame,
    catalogue: DataFrame | StoredCatalogue,
    k: int,
    bias: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, item_id, score, rank)`` of the k best items, ties to the lower item, NaN last.

    A task carries the k best of its queries from block to block, so nothing is shuffled and
    the scores are never all held.
    """
    store = _stored(catalogue, bias, block_rows)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _groups(batches, store.widest()):
            item, score = np.empty((len(x), 0), np.int64), np.empty((len(x), 0))
            for _, items, vectors, shift in store.read():
                scores = x @ vectors.T + shift
                top = _top(scores, k)
                item = np.concatenate((item, items[top]), axis=1)
                score = np.concatenate((score, np.take_along_axis(scores, top, axis=1)), axis=1)
                missing = np.isnan(score)
                order = np.lexsort((item, missing, -np.where(missing, -np.inf, score)), axis=1)[:, :k]
                item, score = np.take_along_axis(item, order, axis=1), np.take_along_axis(score, order, axis=1)
            ranks = np.tile(np.arange(1, item.shape[1] + 1, dtype=np.int32), len(item))
            ids = np.repeat(rows.column(0).to_numpy(), item.shape[1])
            columns = [pa.array(ids), pa.array(item.ravel()), pa.array(score.ravel()), pa.array(ranks)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "item_id", "score", "rank"])

    asked = queries.select(F.col("query_id").cast("bigint"), "vector")
    return asked.mapInArrow(best, "query_id BIGINT, item_id BIGINT, score DOUBLE, rank INT")


def catalogue_loss(
    queries: DataFrame,
    catalogue: DataFrame | StoredCatalogue,
    bias: DataFrame | None = None,
    target: str = "target",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, loss)``: the negative log-softmax, over all items, of the score of the query's own item.

    ``queries`` is ``(query_id, vector, target)``. A task carries three numbers of a query from
    block to block: the largest score, the sum of powers relative to it, and the score of the own
    item. Score rows are never made, and nothing is shuffled. A target that is no item is an error.
    """
    store = _stored(catalogue, bias, block_rows)

    def lose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _groups(batches, store.widest()):
            wanted = rows.column(2)
            if wanted.null_count:
                raise ValueError("a query has no target")
            wanted = wanted.to_numpy()
            top, powers, own = np.full(len(x), -np.inf), np.zeros(len(x)), np.full(len(x), np.nan)
            found = np.zeros(len(x), bool)
            for _, items, vectors, shift in store.read():
                scores = x @ vectors.T + shift
                higher = np.maximum(top, scores.max(axis=1))
                base = np.where(np.isneginf(higher), 0.0, higher)  # without a score above minus infinity all powers are 0
                powers = powers * np.exp(top - base) + np.exp(scores - base[:, None]).sum(axis=1)
                top = higher
                at = np.minimum(np.searchsorted(items, wanted), len(items) - 1)
                here = items[at] == wanted
                own[here] = scores[here, at[here]]
                found |= here
            if not found.all():
                raise ValueError(f"target {wanted[~found][0]} is no item of the catalogue")
            loss = np.log(powers) + top - own
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(loss)], ["query_id", "loss"])

    asked = queries.select(F.col("query_id").cast("bigint"), "vector", F.col(target).cast("bigint"))
    return asked.mapInArrow(lose, "query_id BIGINT, loss DOUBLE")
