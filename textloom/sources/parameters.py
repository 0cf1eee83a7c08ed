"""Named parameters in long form: one row per entry of each tensor."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARAMETER_SCHEMA = "param STRING, row INT, col INT, theta DOUBLE"

# Type names that count as trainable.
FLOAT_TYPES = ("f16", "bf16", "f32", "f64")

# A tensor up to this many entries may be held whole in one process (512 MB of doubles).
MAX_LOCAL_ENTRIES = 64_000_000


def read_parameters(spark: SparkSession, path: str, name: str | None = None, shape: tuple[int, int] | None = None) -> DataFrame:
    """All parameters, or the one called ``name``; with ``shape``, its entries are checked."""
    params = spark.read.schema(PARAMETER_SCHEMA).parquet(path)
    if name is None:
        return params
    found = params.where(F.col("param") == name)
    if shape is not None:
        check_shape(found, name, shape)
    return found


def check_shape(params: DataFrame, name: str, shape: tuple[int, int]) -> None:
    rows, cols = shape
    inside = F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1)
    places = params.groupBy("row", "col").agg(F.count("*").alias("n"), F.max(inside).alias("inside"))
    got = places.agg(
        F.count("*").alias("places"), F.sum("n").alias("n"), F.sum(F.col("inside").cast("int")).alias("inside")
    ).first()
    if not got["places"] == got["n"] == got["inside"] == rows * cols:
        raise ValueError(
            f"parameter {name!r} does not have shape {rows}x{cols} "
            f"(found {got['n']} entries at {got['places']} places, {got['inside']} of them inside)"
        )


def write_parameters(params: DataFrame, path: str) -> None:
    """Write current values only; optimiser state stays behind."""
    current_values(params).write.parquet(path)


def current_values(params: DataFrame) -> DataFrame:
    return params.select("param", "row", "col", "theta")


def trainable(params: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Parameters whose type in ``catalogue (param, dtype)`` is a float type."""
    floats = catalogue.where(F.col("dtype").isin(*FLOAT_TYPES)).select("param")
    return params.join(floats, "param", "left_semi")


def matrix(params: DataFrame, name: str) -> np.ndarray:
    """One parameter as a dense array, after a check that it is small enough to hold."""
    found = params.where(F.col("param") == name)
    size = found.agg(F.count("*").alias("n"), F.max("row").alias("r"), F.max("col").alias("c")).first()
    if not size["n"]:
        raise KeyError(name)
    rows, cols = size["r"] + 1, size["c"] + 1
    check_shape(found, name, (rows, cols))
    if size["n"] > MAX_LOCAL_ENTRIES:
        raise ValueError(f"parameter {name!r} is too large to hold whole; use the long-form operators")
    entries = found.select("row", "col", "theta").toPandas()
    dense = np.zeros((rows, cols))
    dense[entries["row"], entries["col"]] = entries["theta"]
    return dense


def matrix_rows(name: str, values: np.ndarray) -> list[tuple[str, int, int, float]]:
    dense = np.atleast_2d(values)
    return [(name, r, c, float(dense[r, c])) for r in range(dense.shape[0]) for c in range(dense.shape[1])]
