"""Training of a classifier layer that no process has to hold.

The layer lies in the shared folder in blocks of classes, each with its values and moments. A step is
two passes. In the first, tasks take rows of the batch through all blocks and keep a few numbers of
each row: those that its softmax needs. In the second, a task owns one block, takes all rows of the
batch past it, sums the gradient of its own classes and writes the next version of the block. So no
gradient is shuffled, and the driver sees block numbers, row counts and losses only.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import dense
from textloom.operators.head import CLASSIFIER_BIAS, CLASSIFIER_WEIGHT
from textloom.operators.optimizer import AdamParams, Schedule, scheduled
from textloom.session import remove_path, work_path
from textloom.sources.blocks import read_block, write_block

# Parameter entries of a block of classes; a task holds it with its moments and gradient (four to five times 16 MB).
BLOCK_ENTRIES = 2_000_000

# Rows of a batch that a task holds at a time, by entries of their vectors and of their scores (32 MB each).
ENTRIES_AT_ONCE = 4_000_000

ROW_STATS = ("top", "powers", "again", "weighted")


@dataclass(frozen=True)
class StoredHead:
    """A folder of blocks ``number.arrow``, one row for each class, and the classes of each block in order."""

    folder: str
    sizes: tuple[int, ...]
    width: int
    moments: tuple[str, ...]

    def read(self, number: int) -> dict[str, np.ndarray]:
        """Values and moments of a block, classes x (width + 1); the bias is the last column."""
        rows = read_block(f"{self.folder}/{number}.arrow")
        return {name: dense.to_matrix(rows[name]) for name in rows.column_names}

    def write(self, number: int, block: Mapping[str, np.ndarray]) -> None:
        write_block(f"{self.folder}/{number}.arrow", pa.table({name: dense.to_lists(v) for name, v in block.items()}))

    def first_class(self, number: int) -> int:
        return sum(self.sizes[:number])


def store_head(params: DataFrame, moments: tuple[str, ...], block_entries: int = BLOCK_ENTRIES) -> StoredHead:
    """Store the classifier weight and bias of a parameter table with moments of zero.

    Entries are shuffled once, to the task that writes their block. Each class must have every
    entry once: ``width`` weights and a bias; a table with holes or repeats is an error.
    """
    spark = params.sparkSession
    is_weight = F.col("param") == CLASSIFIER_WEIGHT
    own = params.where(F.col("param").isin(CLASSIFIER_WEIGHT, CLASSIFIER_BIAS))
    shape = own.agg(
        F.max(F.when(is_weight, F.col("row"))).alias("row"), F.max(F.when(is_weight, F.col("col"))).alias("col")
    ).first()
    if shape["row"] is None:
        raise KeyError(CLASSIFIER_WEIGHT)
    classes, width = shape["row"] + 1, shape["col"] + 1
    per_block = max(1, block_entries // (width + 1))
    blocks = -(-classes // per_block)
    sizes = tuple(min(per_block, classes - i * per_block) for i in range(blocks))
    store = StoredHead(work_path(spark, "classifier"), sizes, width, moments)

    def write(rows: pa.Table) -> pa.Table:
        number = rows["block"][0].as_py()
        values = np.full((store.sizes[number], width + 1), np.nan) if 0 <= number < blocks else np.empty((0, 0))
        row = rows["class"].to_numpy() - number * per_block
        col, theta = rows["entry"].to_numpy(), rows["theta"].to_numpy()
        inside = len(theta) == values.size and (row < len(values)).all() and ((col >= 0) & (col <= width)).all()
        if not inside or len(np.unique(row * (width + 1) + col)) != len(row):
            raise ValueError(f"the classifier does not have one weight of {width} and one bias for each of {classes} classes")
        values[row, col] = theta
        store.write(number, {"theta": values, **{name: np.zeros_like(values) for name in moments}})
        return pa.table({"block": pa.array([number], pa.int64())})

    name = F.when(is_weight, F.col("row")).otherwise(F.col("col")).cast("bigint").alias("class")
    entry = F.when(is_weight, F.col("col")).otherwise(width).cast("bigint").alias("entry")
    placed = own.select(name, entry, F.col("theta").cast("double").alias("theta"))
    placed = placed.withColumn("block", F.floor(F.col("class") / per_block))
    written = placed.groupBy("block").applyInArrow(write, "block BIGINT").count()
    if written != blocks:
        raise ValueError(f"{written} of {blocks} blocks of the classifier have entries")
    return store


def stored_values(spark: SparkSession, store: StoredHead) -> DataFrame:
    """``(param, row, col, theta, *moments)``, read from the blocks by tasks."""
    columns = ("theta", *store.moments)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                block, first = store.read(number), store.first_class(number)
                for lo in range(0, store.sizes[number], 256):
                    part = {name: block[name][lo : lo + 256] for name in columns}
                    rows, cols = np.indices(part["theta"].shape, dtype=np.int32)
                    rows += first + lo
                    bias = cols == store.width
                    names = pa.array([CLASSIFIER_WEIGHT, CLASSIFIER_BIAS]).take(pa.array(bias.ravel().astype(np.int32)))
                    places = [np.where(bias, np.int32(0), rows).ravel(), np.where(bias, rows, cols).ravel()]
                    found = [pa.array(part[name].ravel()) for name in columns]
                    yield pa.RecordBatch.from_arrays([names, *map(pa.array, places), *found], ["param", "row", "col", *columns])

    kinds = ", ".join(f"{name} DOUBLE" for name in columns)
    return _block_numbers(spark, store).mapInArrow(entries, f"param STRING, row INT, col INT, {kinds}")


def _block_numbers(spark: SparkSession, store: StoredHead) -> DataFrame:
    """One block to a task, so that a lost executor costs the blocks it was at."""
    return spark.range(0, len(store.sizes), 1, len(store.sizes))


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, ENTRIES_AT_ONCE // max(width, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def row_statistics(batch: DataFrame, store: StoredHead, source: str, folder: str) -> tuple[list[str], int, float]:
    """First pass: write the rows of a batch with what their softmax needs; returns files, rows and summed loss.

    For logits these are the largest score and the sum of powers relative to it. For
    probabilities, their own softmax adds a sum of powers and the mean of the derivative.
    """
    classes = sum(store.sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for i, part in enumerate(_pieces(batches, max(store.width, max(store.sizes)))):
            y = part.column(1).to_numpy(zero_copy_only=False)
            if part.column(0).null_count:
                raise ValueError("a row has no features")
            if part.column(1).null_count or ((y < 0) | (y >= classes)).any():
                raise ValueError(f"a label is outside 0..{classes - 1}; see audit_labels")
            x, y = dense.to_matrix(part.column(0)), y.astype(np.int64)
            if x.shape[1] != store.width:
                raise ValueError(f"a row has {x.shape[1]} features, the classifier takes {store.width}")
            top, powers, own = np.full(len(x), -np.inf), np.zeros(len(x)), np.zeros(len(x))
            for _, first, z in _scores(x, store):
                higher = np.maximum(top, z.max(axis=1))
                powers = powers * np.exp(top - higher) + np.exp(z - higher[:, None]).sum(axis=1)
                top = higher
                here = (y >= first) & (y < first + z.shape[1])
                own[here] = z[here, y[here] - first]
            again = weighted = np.zeros(len(x))
            loss = np.log(powers) + top - own
            if source == "probs":
                p_own = np.exp(own - top) / powers
                for _, _, z in _scores(x, store):
                    p = np.exp(z - top[:, None]) / powers[:, None]
                    again, weighted = again + np.exp(p).sum(axis=1), weighted + (p * np.exp(p)).sum(axis=1)
                weighted = weighted / again - p_own
                loss = np.log(again) - p_own
            name = f"{folder}/{task}-{i}.arrow"
            stats = [pa.array(v) for v in (top, powers, again, weighted)]
            rows = pa.Table.from_arrays([dense.to_lists(x), pa.array(y), *stats], ["features", "label", *ROW_STATS])
            write_block(name, rows)
            columns = [pa.array([name]), pa.array([len(x)]), pa.array([loss.sum()])]
            yield pa.RecordBatch.from_arrays(columns, ["file", "rows", "loss"])

    found = batch.select("features", "label").mapInArrow(run, "file STRING, rows BIGINT, loss DOUBLE").collect()
    found.sort(key=lambda f: f["file"])
    return [f["file"] for f in found], sum(f["rows"] for f in found), sum(f["loss"] for f in found)


def _scores(x: np.ndarray, store: StoredHead) -> Iterator[tuple[int, int, np.ndarray]]:
    first = 0
    for number, size in enumerate(store.sizes):
        theta = store.read(number)["theta"]
        yield number, first, x @ theta[:, :-1].T + theta[:, -1]
        first += size


def block_gradient(theta: np.ndarray, first: int, files: list[str], source: str) -> np.ndarray:
    """Sum of the rows' gradients for the classes of one block; rows stream by, a file at a time."""
    total = np.zeros_like(theta)
    for file in files:
        for part in _pieces(iter(read_block(file).combine_chunks().to_batches()), len(theta)):
            x, y = dense.to_matrix(part.column(0)), part.column(1).to_numpy()
            top, powers, again, weighted = (part.column(2 + i).to_numpy()[:, None] for i in range(4))
            p = np.exp(x @ theta[:, :-1].T + theta[:, -1] - top) / powers
            target = np.zeros_like(p)
            here = np.flatnonzero((y >= first) & (y < first + len(theta)))
            target[here, y[here] - first] = 1.0
            dz = p - target if source == "logits" else p * (np.exp(p) / again - target - weighted)
            total[:, :-1] += dz.T @ x
            total[:, -1] += dz.sum(axis=0)
    return total


def adam_block(block: Mapping[str, np.ndarray], grad: np.ndarray, hp: AdamParams, t: int) -> dict[str, np.ndarray]:
    """One update of values and moments held as arrays, by the same rule as ``adam_step``."""
    theta, kind = block["theta"], hp.decay and hp.decay[0]
    if kind == "l2":
        grad = grad + hp.decay[1] * theta
    if kind == "decoupled":
        theta = theta * (1.0 - hp.lr * hp.decay[1])
    m = hp.beta_1 * block["m"] + (1.0 - hp.beta_1) * grad
    v = hp.beta_2 * block["v"] + (1.0 - hp.beta_2) * grad * grad
    new = {"m": m, "v": v}
    scale = v
    if hp.amsgrad:
        scale = new["vmax"] = np.maximum(block["vmax"], v)
    moved = theta - m / (1.0 - hp.beta_1**t) * hp.lr / (np.sqrt(scale / (1.0 - hp.beta_2**t)) + hp.eps)
    return {"theta": moved, **new}


def step_blocks(
    spark: SparkSession,
    store: StoredHead,
    after: StoredHead,
    files: list[str],
    rows: int,
    source: str,
    hp: AdamParams,
    t: int,
    fixed: tuple[str, ...],
    fresh: bool,
) -> None:
    """Second pass: every block moves on by one step, from the folder of ``store`` to that of ``after``.

    A parameter named in ``fixed`` keeps its values and moments; ``fresh`` starts with moments of zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                block = store.read(number)
                if fresh:
                    block = {name: v if name == "theta" else np.zeros_like(v) for name, v in block.items()}
                grad = block_gradient(block["theta"], store.first_class(number), files, source) / rows
                moved = adam_block(block, grad, hp, t)
                for name, part in ((CLASSIFIER_WEIGHT, np.s_[:, :-1]), (CLASSIFIER_BIAS, np.s_[:, -1:])):
                    if name in fixed:
                        for column, value in moved.items():
                            value[part] = block[column][part]
                after.write(number, moved)
            yield batch

    done = _block_numbers(spark, store).mapInArrow(run, "id BIGINT").count()
    if done != len(store.sizes):
        raise RuntimeError(f"{done} of {len(store.sizes)} blocks were written")


def train_stored(
    spark: SparkSession,
    path: str,
    batches: list[tuple[int, int]],
    params: DataFrame,
    hp: AdamParams,
    epochs: int,
    source: str,
    optimizer_lifetime: str,
    schedule: Schedule | None,
    run_id: str,
    fixed: tuple[str, ...],
    block_entries: int = BLOCK_ENTRIES,
) -> tuple[DataFrame, list[tuple[str, int, int, int, float]]]:
    """The steps of ``train_head`` over batches stored in ``path``; returns the state and the log.

    Rows and blocks of a step are removed when it is done or has failed. The last blocks stay, as
    the returned table reads them.
    """
    store = store_head(params, ("m", "v", *(["vmax"] if hp.amsgrad else [])), block_entries)
    log: list[tuple[str, int, int, int, float]] = []
    t = 0
    for epoch in range(epochs):
        for step, (batch_id, size) in enumerate(batches):
            hp = scheduled(hp, schedule, t)
            t += 1
            fresh = optimizer_lifetime == "step"
            rows_folder = work_path(spark, "rows")
            before, store = store, replace(store, folder=work_path(spark, "classifier"))
            try:
                batch = spark.read.parquet(f"{path}/batch_id={batch_id}")
                files, rows, loss = row_statistics(batch, before, source, rows_folder)
                step_blocks(spark, before, store, files, rows, source, hp, 1 if fresh else t, fixed, fresh)
            except BaseException:
                remove_path(spark, store.folder)
                raise
            finally:
                remove_path(spark, rows_folder)
                remove_path(spark, before.folder)
            log.append((run_id, epoch, step, size, loss / rows))
    return stored_values(spark, store), log
