"""Training of a vector table of which a step touches some rows only.

The table lies in the shared folder in blocks of rows by a hash of the id, each with its moments. A
step shuffles partial sums for the touched ids to the tasks that own their blocks; those write the
next version of their block. A block without a touched id is neither read nor written.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import dense
from textloom.operators.optimizer import AdamParams
from textloom.operators.stored_head import adam_block
from textloom.operators.tokens import TOKENS_AT_ONCE, parts_of_lists
from textloom.session import remove_path, work_path
from textloom.sources.blocks import read_block, write_block

# Rows of a block, about.
BLOCK_ROWS = 4096

# Entries of partial sums that a task holds before it hands them on (32 MB of doubles).
SUMS_AT_ONCE = 4_000_000


@dataclass(frozen=True)
class VectorTable:
    """The folder of a table, the file of each block (None for one without rows), and the moments kept."""

    folder: str
    files: tuple[str | None, ...]
    moments: tuple[str, ...]

    def remove(self, spark: SparkSession) -> None:
        """Remove all versions; results that are not computed yet cannot be after that."""
        remove_path(spark, self.folder)


def _block(table_size: int):
    return F.pmod(F.xxhash64("id"), F.lit(table_size)).alias("block")


def store_vectors(
    table: DataFrame, hp: AdamParams, id_col: str = "token_id", vec: str = "vector", block_rows: int = BLOCK_ROWS
) -> VectorTable:
    """Store vectors with moments of zero. An id that is NULL or there twice, or a NULL vector, is an error."""
    folder = work_path(table.sparkSession, "vectors")
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("theta"))
    count = max(1, -(-rows.count() // block_rows))
    moments = ("m", "v", *(["vmax"] if hp.amsgrad else []))

    def write(part: pa.Table) -> pa.Table:
        number, part = part["block"][0].as_py(), part.sort_by("id")
        ids, theta = part["id"], dense.to_matrix(part["theta"])
        if ids.null_count or len(np.unique(ids.to_numpy())) < len(ids):
            raise ValueError("an id of the vector table is NULL or there twice")
        file = f"{folder}/0/{number}.arrow"
        zero = dense.to_lists(np.zeros_like(theta))
        write_block(file, pa.table({"id": ids, "theta": dense.to_lists(theta), **{name: zero for name in moments}}))
        return pa.table({"block": pa.array([number], pa.int64()), "file": [file]})

    dealt = rows.withColumn("block", F.coalesce(_block(count), F.lit(0)))
    written = {r["block"]: r["file"] for r in dealt.groupBy("block").applyInArrow(write, "block BIGINT, file STRING").collect()}
    return VectorTable(folder, tuple(written.get(i) for i in range(count)), moments)


def pooled_gradient(df: DataFrame, ids: str = "ids", grad: str = "grad", scale: float = 1.0) -> DataFrame:
    """``(id, grad)``: how a gradient by the mean of a row's vectors reaches each vector, as partial sums.

    An id that is several times in a row gets as many shares. Rows without ids or gradient give
    nothing. ``scale`` multiplies all, one over the batch size for a mean loss. A task adds up
    its rows; an id has a row for each task, or some more where a task meets very many ids.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = np.empty(0, np.int64), np.empty((0, 0))
        for batch, start, rows in _parts(batches):
            part = batch.slice(start, rows).drop_null()
            lists = part["ids"]
            lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int32)
            if not lengths.sum():
                continue
            slopes = dense.to_matrix(part["grad"]) * (scale / np.maximum(lengths, 1))[:, None]
            flat = lists.flatten()
            if flat.null_count:
                raise ValueError("an id is NULL")
            row = np.repeat(np.arange(len(lengths)), lengths)
            keys, times = np.unique(np.stack((flat.to_numpy(), row)), axis=1, return_counts=True)  # by id, then by row
            step = max(1, SUMS_AT_ONCE // slopes.shape[1])
            for i in range(0, len(times), step):
                key, own = keys[0, i : i + step], keys[1, i : i + step]
                found, first = np.unique(key, return_index=True)
                added = np.add.reduceat(slopes[own] * times[i : i + step, None], first)
                held, sums = _merged(held, sums, found, added)
            if sums.size > SUMS_AT_ONCE:
                yield from _rows(held, sums)
                held, sums = np.empty(0, np.int64), np.empty((0, 0))
        if len(held):
            yield from _rows(held, sums)

    asked = df.select(F.col(ids).cast("array<bigint>").alias("ids"), F.col(grad).cast("array<double>").alias("grad"))
    return asked.mapInArrow(partial, "id BIGINT, grad ARRAY<DOUBLE>")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int]]:
    """Batches with the first row and the number of rows of parts that hold about ``TOKENS_AT_ONCE`` ids."""
    for batch in batches:
        start = 0
        for lists in parts_of_lists(batch.column(0), TOKENS_AT_ONCE):
            yield batch, start, len(lists)
            start += len(lists)


def _rows(ids: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays([pa.array(ids), dense.to_lists(sums)], ["id", "grad"])


def _merged(ids: np.ndarray, sums: np.ndarray, more: np.ndarray, added: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums by id, ids ascending; both sides have each id once."""
    if not len(ids):
        return more, added
    every = np.union1d(ids, more)
    total = np.zeros((len(every), added.shape[1]))
    total[np.searchsorted(every, ids)] = sums
    total[np.searchsorted(every, more)] += added
    return every, total


def sparse_step(spark: SparkSession, table: VectorTable, grads: DataFrame, hp: AdamParams, t: int) -> VectorTable:
    """One update; ``grads`` is ``(id, grad)``, whose rows of one id are added up.

    ``t`` counts steps from 1, for every vector, as in ``adam_step``: an id without gradient keeps its
    value and moments, and is not decayed. A gradient for an id that the table does not have is
    an error. Old versions of the blocks that moved on are removed.
    """
    files = table.files

    def move(part: pa.Table) -> pa.Table:
        number = part["block"][0].as_py()
        ids, at = np.unique(part["id"].to_numpy(), return_inverse=True)
        grad = dense.to_matrix(part["grad"])
        total = np.zeros((len(ids), grad.shape[1]))
        np.add.at(total, at, grad)
        if files[number] is None:
            raise ValueError(f"id {ids[0]} has a gradient but no vector")
        rows = read_block(files[number])
        known = rows["id"].to_numpy()
        place = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        if (known[place] != ids).any():
            raise ValueError(f"id {ids[known[place] != ids][0]} has a gradient but no vector")
        block = {name: dense.to_matrix(rows[name]) for name in ("theta", *table.moments)}
        moved = adam_block({name: value[place] for name, value in block.items()}, total, hp, t)
        for name, value in moved.items():
            block[name][place] = value
        file = f"{table.folder}/{t}/{number}.arrow"
        write_block(file, pa.table({"id": rows["id"], **{name: dense.to_lists(v) for name, v in block.items()}}))
        return pa.table({"block": pa.array([number], pa.int64()), "file": [file]})

    if any(file is not None and file.startswith(f"{table.folder}/{t}/") for file in files):
        raise ValueError(f"the table has had its step {t} already")
    dealt = grads.where("id IS NOT NULL AND grad IS NOT NULL").select("id", "grad", _block(len(files)))
    after = {r["block"]: r["file"] for r in dealt.groupBy("block").applyInArrow(move, "block BIGINT, file STRING").collect()}
    for number in after:
        remove_path(spark, files[number])
    return VectorTable(table.folder, tuple(after.get(i, file) for i, file in enumerate(files)), table.moments)


def stored_vectors(spark: SparkSession, table: VectorTable) -> DataFrame:
    """``(id, theta, *moments)`` as arrays, read from the blocks by tasks."""
    files = [file for file in table.files if file is not None]
    names = ["id", "theta", *table.moments]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                yield from read_block(files[number]).select(names).to_batches()

    kinds = ", ".join(f"{name} ARRAY<DOUBLE>" for name in names[1:])
    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(read, f"id BIGINT, {kinds}")
