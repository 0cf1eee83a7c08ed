"""Training of the classifier layer: one distributed aggregation per step."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textloom.functions import dense
from textloom.operators.batching import assign_batches
from textloom.operators.head import CLASSIFIER_BIAS, CLASSIFIER_WEIGHT
from textloom.operators.optimizer import AdamParams, Schedule, adam_step, init_state, scheduled
from textloom.operators.stored_head import BLOCK_ENTRIES, train_stored
from textloom.session import remove_path, work_path
from textloom.sources.metrics import METRIC_SCHEMA
from textloom.sources.parameters import FLOAT_TYPES, MAX_LOCAL_ENTRIES, matrix

# Settings of the training programs.
LEARNING_RATE = 2e-5
EPOCHS = 3

# Steps are sequential and each costs a job, so the default batch is large.
BATCH_SIZE = 100_000

PARTIAL_SCHEMA = "param STRING, row INT, col INT, total DOUBLE, rows BIGINT"
LOSS = "loss"

Gradient = Callable[[DataFrame, Mapping[str, np.ndarray]], DataFrame]


def head_gradient(
    batch: DataFrame,
    weight: np.ndarray,
    bias: np.ndarray,
    input: str = "probs",
    features: str = "features",
    label: str = "label",
    with_loss: bool = False,
) -> DataFrame:
    """``(param, row, col, grad)`` of the mean loss of a batch for the classifier layer.

    The loss takes the log-softmax of the classifier's probabilities (``input="probs"``, as
    the training programs do) or of its logits (``input="logits"``). Each task sums over its
    own rows; the shuffle carries one number per parameter entry and task. ``with_loss`` adds
    the mean loss as a row named ``loss``.
    """
    if input not in ("probs", "logits"):
        raise ValueError(f"unknown input {input!r}")
    classes, width = weight.shape
    shift = np.asarray(bias).reshape(1, -1)

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d_weight, d_bias = np.zeros((classes, width)), np.zeros(classes)
        loss, rows = 0.0, 0
        for part in batches:
            if part.num_rows == 0:
                continue
            x, y = labelled_vectors(part, classes)
            part_loss, dz = dense.loss_slope(x @ weight.T + shift, y, input)
            loss += part_loss
            d_weight += dz.T @ x
            d_bias += dz.sum(axis=0)
            rows += len(y)
        if rows:
            sums = {CLASSIFIER_WEIGHT: d_weight, CLASSIFIER_BIAS: d_bias, LOSS: np.array([loss])}
            yield from tensor_entries(sums, rows)

    return mean_gradient(batch.select(features, label).mapInArrow(partial_sums, PARTIAL_SCHEMA), with_loss)


def labelled_vectors(part: pa.RecordBatch, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and classes of a batch of two columns; one that is missing or out of range is an error."""
    if part.column(0).null_count:
        raise ValueError("a row has no features")
    y = part.column(1).to_numpy(zero_copy_only=False)
    if part.column(1).null_count or ((y < 0) | (y >= classes)).any():
        raise ValueError(f"a label is outside 0..{classes - 1}; see audit_labels")
    return dense.to_matrix(part.column(0)), y.astype(np.int64)


def tensor_entries(sums: Mapping[str, np.ndarray], rows: int) -> Iterator[pa.RecordBatch]:
    """The entries of each tensor as rows, with the number of training rows they were summed over."""
    for name, tensor in sums.items():
        table = np.atleast_2d(tensor)
        row, col = np.indices(table.shape, dtype=np.int32)
        columns = [
            pa.array([name]).take(pa.array(np.zeros(table.size, np.int32))),
            pa.array(row.ravel()),
            pa.array(col.ravel()),
            pa.array(table.ravel()),
            pa.array(np.full(table.size, rows)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["param", "row", "col", "total", "rows"])


def mean_gradient(parts: DataFrame, with_loss: bool) -> DataFrame:
    sums = parts.groupBy("param", "row", "col").agg((F.sum("total") / F.sum("rows")).alias("grad"))
    return sums if with_loss else sums.where(F.col("param") != LOSS)


def write_batches(
    df: DataFrame, order_by: str, batch_size: int, features: str, label: str, path: str
) -> list[tuple[int, int]]:
    """Store the training rows with one folder per batch; returns each batch and its row count.

    Every step then reads its own batch only, and a lost executor costs a read from shared
    storage and not the work before it.
    """
    rows = df.select(order_by, F.col(features).alias("features"), F.col(label).cast("int").alias("label"))
    assign_batches(rows, order_by, batch_size).write.partitionBy("batch_id").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return [(r["batch_id"], r["n"]) for r in stored.groupBy("batch_id").agg(F.count("*").alias("n")).sort("batch_id").collect()]


def train_head(
    df: DataFrame,
    weight: np.ndarray | DataFrame,
    bias: np.ndarray | None = None,
    hp: AdamParams = AdamParams(lr=LEARNING_RATE),
    epochs: int = EPOCHS,
    batch_size: int = BATCH_SIZE,
    order_by: str = "doc_id",
    features: str = "features",
    label: str = "label",
    input: str = "probs",
    optimizer_lifetime: str = "run",
    schedule: Schedule | None = None,
    run_id: str | None = None,
    dtypes: Mapping[str, str] | None = None,
    limit: int = MAX_LOCAL_ENTRIES,
    block_entries: int = BLOCK_ENTRIES,
) -> tuple[DataFrame, DataFrame]:
    """Train the classifier layer; returns ``(params, metrics)``.

    Batches are consecutive rows in the order of ``order_by``. ``optimizer_lifetime="step"``
    starts with new moments at each batch, as the training programs do; ``"run"`` keeps them.
    ``schedule`` maps a step, counted from 0 over the whole run, to the learning rate and betas
    that hold from there on, or to a whole set of hyperparameters (see ``change_params``). ``dtypes`` names the type of a parameter; one whose type is
    no float type is not trained. The stored batches are removed when the run ends or fails.

    The layer is two arrays, or a parameter table ``(param, row, col, theta)`` with no ``bias``
    beside it. Up to ``limit`` entries it returns to the driver after each step, which also ends
    its lineage. A larger one stays in the shared folder in blocks of ``block_entries`` (see
    ``stored_head``); the result is the same but for rounding.
    """
    if isinstance(weight, DataFrame) is not (bias is None):
        raise ValueError("give a weight and a bias, or one parameter table")
    fixed = [name for name, kind in (dtypes or {}).items() if kind not in FLOAT_TYPES]
    if optimizer_lifetime not in ("run", "step"):
        raise ValueError(f"unknown optimizer_lifetime {optimizer_lifetime!r}")
    spark = df.sparkSession
    run_id = run_id or uuid.uuid4().hex
    large = _entries(weight, bias) > limit
    path = work_path(spark, "batches")
    try:
        batches = write_batches(df, order_by, batch_size, features, label, path)
        if large:
            params = weight
            if not isinstance(weight, DataFrame):
                tensors = {CLASSIFIER_WEIGHT: np.asarray(weight, np.float64), CLASSIFIER_BIAS: np.ravel(bias).astype(np.float64)}
                params = parameter_table(spark, tensors)
            state, log = train_stored(
                spark, path, batches, params, hp, epochs, input, optimizer_lifetime, schedule, run_id, tuple(fixed), block_entries
            )
        else:
            if isinstance(weight, DataFrame):
                weight, bias = matrix(weight, CLASSIFIER_WEIGHT), matrix(weight, CLASSIFIER_BIAS)

            def gradient(batch: DataFrame, held: Mapping[str, np.ndarray]) -> DataFrame:
                return head_gradient(batch, held[CLASSIFIER_WEIGHT], held[CLASSIFIER_BIAS], input, with_loss=True)

            tensors = {CLASSIFIER_WEIGHT: np.atleast_2d(weight), CLASSIFIER_BIAS: np.ravel(bias)}
            state, log = train_tensors(
                spark, path, batches, tensors, gradient, hp, epochs, optimizer_lifetime, schedule, run_id, fixed
            )
    finally:
        remove_path(spark, path)
    return state, spark.createDataFrame(log, METRIC_SCHEMA)


def _entries(weight: np.ndarray | DataFrame, bias: np.ndarray | None) -> int:
    if isinstance(weight, DataFrame):
        return weight.where(F.col("param").isin(CLASSIFIER_WEIGHT, CLASSIFIER_BIAS)).count()
    return np.size(weight) + np.size(bias)


def parameter_table(spark: SparkSession, tensors: Mapping[str, np.ndarray]) -> DataFrame:
    entries = pa.Table.from_batches(tensor_entries(tensors, 0))
    return spark.createDataFrame(entries).select("param", "row", "col", F.col("total").alias("theta"))


def train_tensors(
    spark: SparkSession,
    path: str,
    batches: list[tuple[int, int]],
    tensors: Mapping[str, np.ndarray],
    gradient: Gradient,
    hp: AdamParams,
    epochs: int,
    optimizer_lifetime: str,
    schedule: Schedule | None,
    run_id: str,
    fixed: Sequence[str] = (),
) -> tuple[DataFrame, list[tuple[str, int, int, int, float]]]:
    """The steps for tensors that the driver holds, over batches stored in ``path``; returns state and log.

    ``gradient`` makes ``(param, row, col, grad)``, with the loss as a row of that name, from a
    batch and the current tensors. Each step is one aggregation of its batch.
    """
    held = {name: np.array(tensor, dtype=np.float64) for name, tensor in tensors.items()}
    state = init_state(parameter_table(spark, held), hp)
    log: list[tuple[str, int, int, int, float]] = []
    t = 0
    for epoch in range(epochs):
        for step, (batch_id, size) in enumerate(batches):
            hp = scheduled(hp, schedule, t)
            t += 1
            if optimizer_lifetime == "step":
                state = init_state(state, hp)
            batch = spark.read.parquet(f"{path}/batch_id={batch_id}")  # no other folder is listed
            seen = Observation()
            found = gradient(batch, held).observe(seen, F.max(F.when(F.col("param") == LOSS, F.col("grad"))).alias(LOSS))
            trained = found.where(~F.col("param").isin(*fixed)) if fixed else found
            # one gradient row per row of the parameter table, whose size is checked by the caller
            moved = adam_step(state, F.broadcast(trained), hp, 1 if optimizer_lifetime == "step" else t).toArrow()
            for name, tensor in held.items():
                own = moved.filter(pc.equal(moved["param"], name))
                np.atleast_2d(tensor)[own["row"].to_numpy(), own["col"].to_numpy()] = own["theta"].to_numpy()
            state = spark.createDataFrame(moved)
            log.append((run_id, epoch, step, size, float(seen.get[LOSS])))
    return state, log
