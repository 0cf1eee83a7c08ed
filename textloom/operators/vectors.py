"""Vector lookup, pooling and linear maps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from textloom.functions import dense
from textloom.operators.catalogue import BLOCK_ROWS, score_catalogue
from textloom.operators.joins import BROADCAST_ENTRIES, lookup_join, vectors_fit_broadcast
from textloom.session import work_path
from textloom.sources.blocks import read_block, write_block

# Vector entries gathered at a time within a task (64 MB of doubles).
ENTRIES_AT_ONCE = 8_000_000

# Ids of the documents that a task pools at a time by stored vectors.
IDS_AT_ONCE = 1_000_000


def embed_tokens(
    token_rows: DataFrame, table: DataFrame, spread: list[str], limit: int = BROADCAST_ENTRIES
) -> DataFrame:
    """Add the ``vector`` of each ``token_id``; an id without vector is an error.

    ``table`` is ``(token_id, vector)``. ``spread`` are columns that tell rows of one token apart.
    """
    small = vectors_fit_broadcast(table, "vector", limit)
    found = lookup_join(token_rows, table, "token_id", spread, small=small)
    missing = F.raise_error(F.concat(F.lit("no vector for token "), F.col("token_id").cast("string")))
    known = F.when(F.col("token_id").isNull(), F.col("vector")).otherwise(F.coalesce("vector", missing))
    return found.withColumn("vector", known)


def check_tokens(token_rows: DataFrame, table: DataFrame) -> None:
    """The error of ``embed_tokens`` for an id without vector, where not all rows are looked up; ids are counted once."""
    ids = token_rows.select("token_id").where("token_id IS NOT NULL").distinct()
    # an id with a NULL vector beside others is an error as well
    gaps = ids.join(table.where("vector IS NOT NULL"), "token_id", "left_anti")
    gaps = gaps.union(ids.join(table.where("vector IS NULL"), "token_id", "left_semi"))
    first = gaps.first()
    if first is not None:
        raise ValueError(f"no vector for token {first['token_id']}")


def pool_tokens(
    df: DataFrame,
    table: DataFrame,
    pooling: str,
    dims: int,
    by: Sequence[str],
    ids: str = "input_ids",
    mask: str = "attention_mask",
    limit: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """``(*by, pooled)``, one row for each input row: lookup and pooling of its id array.

    ``pooling`` is ``"cls"``, the vector of the first id, or ``"mean"``, that of the unmasked
    ids. A small vector table is held by every worker, and a document stays one row. For a mean
    a larger one is stored in blocks that tasks read (see ``StoredVectors``), and a document
    stays one row too; for ``"cls"`` the first ids are joined to their vectors. The result is the
    same. Rows that only share ``by`` stay apart.
    """
    if pooling not in ("cls", "mean"):
        raise ValueError(f"unknown pooling {pooling!r}")
    if vectors_fit_broadcast(table, "vector", limit):
        return _pool_ids(df, table, pooling, ids, mask).select(*by, "pooled")
    if pooling == "mean":
        return _pool_stored(df, store_vectors(table), by, ids, mask)
    rows = df.select(*by, F.slice(ids, 1, 1).alias("_ids")).withColumn("_key", F.md5(F.array_join("_ids", ",")))
    rows = rows.groupBy(*by, "_key").agg(F.first("_ids").alias("_ids"), F.count("*").alias("_times"))
    group = [*by, "_key", "_times"]
    places = rows.select(*group, F.posexplode_outer("_ids").alias("pos", "token_id"))
    found = embed_tokens(places, table, ["_key", "pos"], limit)
    pooled = found.select(*group, F.col("vector").alias("pooled"))
    times = F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int")))
    return pooled.select(*by, "pooled", times.alias("_time")).drop("_time")


@dataclass(frozen=True)
class StoredVectors:
    """The folder of a vector table and the numbers of its blocks: ids by their remainder, ascending.

    A block has the sum and the number of the vectors of each id.
    """

    folder: str
    size: int
    blocks: frozenset[int]

    def read(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if number not in self.blocks:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 0))
        rows = read_block(f"{self.folder}/{number}.arrow")
        return rows["id"].to_numpy(), rows["n"].to_numpy(), dense.to_matrix(rows["sum"])


def store_vectors(table: DataFrame, block_rows: int = BLOCK_ROWS) -> StoredVectors:
    """Store ``(token_id, vector)`` for ``pool_tokens``, shuffled once; the driver gets a number for each block.

    An id with several vectors counts with all of them, as in a join; one with a vector that is
    NULL is left out.
    """
    folder = work_path(table.sparkSession, "token_vectors")
    rows = table.select(F.col("token_id").cast("bigint").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    rows = rows.where("id IS NOT NULL")
    size = max(1, -(-rows.count() // block_rows)) | 1  # odd, so that even ids spread too

    def write(part: pa.Table) -> pa.Table:
        number, part = part["block"][0].as_py(), part.sort_by("id")
        gone = part.filter(pc.is_null(part["vector"]))["id"].unique()
        part = part.filter(pc.invert(pc.is_in(part["id"], value_set=gone)))
        ids, first, n = np.unique(part["id"].to_numpy(), return_index=True, return_counts=True)
        vectors = dense.to_matrix(part["vector"])
        sums = np.add.reduceat(vectors, first) if len(first) else vectors
        write_block(f"{folder}/{number}.arrow", pa.table({"id": ids, "n": n.astype(np.int64), "sum": dense.to_lists(sums)}))
        return pa.table({"block": pa.array([number], pa.int64())})

    numbered = rows.withColumn("block", F.pmod("id", F.lit(size).cast("bigint")))
    written = numbered.groupBy("block").applyInArrow(write, "block BIGINT").collect()
    return StoredVectors(folder, size, frozenset(row["block"] for row in written))


def _pool_stored(df: DataFrame, store: StoredVectors, by: Sequence[str], ids: str, mask: str) -> DataFrame:
    """``(*by, pooled)``: the mean of the unmasked ids; a task reads the blocks that some documents need one at a time."""
    cells = F.filter(F.arrays_zip(F.col(ids).alias("id"), F.col(mask).alias("bit")), lambda c: c["bit"] == 1)
    rows = df.select(*by, F.transform(cells, lambda c: c["id"].cast("bigint")).alias("_ids"))
    kind = StructType([*rows.schema.fields[:-1], StructField("pooled", ArrayType(DoubleType()))])
    names = kind.names

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _gathered(batches, IDS_AT_ONCE):
            pooled = _means(part.column(part.num_columns - 1), store)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pooled], names)

    return rows.mapInArrow(pool, kind)


def _gathered(batches: Iterator[pa.RecordBatch], ids: int) -> Iterator[pa.RecordBatch]:
    """Rows in parts with about so many ids in their last column, at least one row each."""
    held, entries = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0).to_numpy()
        start = 0
        for row, size in enumerate(sizes):
            entries += int(size)
            if entries >= ids:
                held.append(batch.slice(start, row + 1 - start))
                yield pa.concat_batches(held)
                held, entries, start = [], 0, row + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.concat_batches(held)


def _means(lists: pa.Array, store: StoredVectors) -> pa.Array:
    """The mean vector of each id list; NULL without ids."""
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    owner = owner[flat.is_valid().to_numpy(zero_copy_only=False)]
    wanted = flat.drop_null().to_numpy()
    block = np.mod(wanted, store.size)
    order = np.argsort(block, kind="stable")  # by block, then by row
    cuts = np.flatnonzero(np.diff(block[order])) + 1
    count, out = np.zeros(len(lists), np.int64), None
    for places in np.split(order, cuts) if len(order) else ():
        ids, copies, sums = store.read(int(block[places[0]]))
        step = max(1, ENTRIES_AT_ONCE // 8 // max(1, sums.shape[1]))
        for i in range(0, len(places), step):
            own, asked = owner[places[i : i + step]], wanted[places[i : i + step]]
            slots = np.minimum(np.searchsorted(ids, asked), len(ids) - 1)
            unknown = ids[slots] != asked if len(ids) else np.ones(len(asked), bool)
            if unknown.any():
                raise ValueError(f"no vector for token {asked[unknown][0]}")
            first = np.flatnonzero(np.diff(own, prepend=-1))
            out = np.zeros((len(lists), sums.shape[1])) if out is None else out
            out[own[first]] += np.add.reduceat(sums[slots], first)
            count[own[first]] += np.add.reduceat(copies[slots], first)
    if out is None:
        return pa.nulls(len(lists), dense.VECTOR)
    pooled = dense.to_lists(out / np.maximum(count, 1)[:, None])
    return pc.if_else(pa.array(count > 0), pooled, pa.scalar(None, pooled.type))


def _pool_ids(df: DataFrame, table: DataFrame, pooling: str, ids: str, mask: str) -> DataFrame:
    """Add ``pooled`` with a table that every worker holds."""
    local = table.select("token_id", "vector").sort("token_id").toArrow().combine_chunks()
    shared = df.sparkSession.sparkContext.broadcast((local["token_id"].to_numpy(), dense.to_matrix(local["vector"])))

    @F.arrow_udf("array<double>")
    def pool(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known, vectors = shared.value
        for id_lists, masks in batches:
            wanted, bits = dense.to_matrix(id_lists).astype(np.int64), dense.to_matrix(masks)
            if pooling == "cls":
                wanted, bits = wanted[:, :1], np.ones((len(wanted), 1))
            slots = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            unknown = (known[slots] != wanted) & (bits == 1)
            if unknown.any():
                raise ValueError(f"no vector for token {wanted[unknown][0]}")
            out = np.zeros((len(wanted), vectors.shape[1]))
            step = max(1, ENTRIES_AT_ONCE // max(1, wanted.shape[1] * vectors.shape[1]))
            for i in range(0, len(wanted), step):
                out[i : i + step] = np.einsum("rp,rpd->rd", bits[i : i + step], vectors[slots[i : i + step]])
            count = bits.sum(axis=1)
            pooled = dense.to_lists(out / np.maximum(count, 1)[:, None])
            yield pc.if_else(pa.array(count > 0), pooled, pa.scalar(None, pooled.type))

    return df.withColumn("pooled", pool(ids, mask))


def pool_cls(rows: DataFrame, by: str, vec: str = "vector", pos: str = "pos") -> DataFrame:
    """The vector at the first position of each group, which may be any number.

    Where texts start at position 0, a filter on the position is the cheaper form.
    """
    return rows.groupBy(by).agg(F.min_by(vec, pos).alias("pooled"))


def pool_mean(rows: DataFrame, by: str | Sequence[str], dims: int, vec: str = "vector", mask: str = "mask") -> DataFrame:
    """Sum of mask times vector over the sum of the mask; NULL for a group that is all masked.

    Every task adds up its own part of a group before the shuffle.
    """
    zeros = F.array_repeat(F.lit(0.0), dims)
    masked = F.when(F.col(mask) == 1, F.col(vec).cast("array<double>")).otherwise(zeros)
    names = [by] if isinstance(by, str) else list(by)
    sums = rows.groupBy(*names).agg(
        Summarizer.metrics("sum").summary(array_to_vector(masked)).alias("summary"),
        F.sum((F.col(mask) == 1).cast("bigint")).alias("n"),
    )
    mean = F.transform(vector_to_array(F.col("summary.sum")), lambda x: F.try_divide(x, F.col("n")))
    return sums.select(*names, F.when(F.col("n") > 0, mean).alias("pooled"))


def linear(vec: Column, weight: np.ndarray, bias: np.ndarray | None = None) -> Column:
    """``weight @ x + bias`` for a weight small enough to travel with the task."""
    weight = np.asarray(weight, dtype=np.float64)
    shift = 0.0 if bias is None else np.asarray(bias, dtype=np.float64).reshape(1, -1)

    @F.arrow_udf("array<double>")
    def multiply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield dense.map_rows(batch, lambda x: dense.to_lists(x @ weight.T + shift), dense.VECTOR)

    return multiply(vec)


def linear_by_join(
    df: DataFrame,
    id_col: str,
    vec: str,
    weight: DataFrame,
    bias: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The same map for a weight too large for one process, as ``(id, row, value)``.

    ``weight`` is ``(row, col, theta)`` without gaps, ``bias`` is ``(row, theta)``, and the id is a
    number. The rows of the weight are the items of a catalogue, whose blocks the tasks read one
    after the other; vectors are not shuffled, and no weight passes through the driver.
    """
    cells = weight.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("col", "theta"))).alias("cells"))
    dense_row = F.col("cells")["col"] == F.transform("cells", lambda _, i: i)
    gap = F.raise_error(F.concat(F.lit("weight has gaps in row "), F.col("row").cast("string")))
    whole = F.when(dense_row, F.transform("cells", lambda c: c["theta"].cast("double"))).otherwise(gap)
    items = cells.select(F.col("row").alias("item_id"), whole.alias("vector"))
    shift = None if bias is None else bias.select(F.col("row").alias("item_id"), F.col("theta").alias("bias"))
    asked = df.select(F.col(id_col).alias("query_id"), F.col(vec).alias("vector"))
    scores = score_catalogue(asked, items, shift, block_rows)
    rows = scores.select("query_id", F.explode(F.arrays_zip("item_ids", "scores")).alias("cell"))
    return rows.select(
        F.col("query_id").alias(id_col), F.col("cell.item_ids").cast("int").alias("row"), F.col("cell.scores").alias("value")
    )
