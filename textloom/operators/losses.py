"""Losses per step and per epoch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.math import log_softmax

# Fixed value: every tenth step is logged, and the last one.
LOG_EVERY = 10


def _own_class(logp: Column, label: Column) -> Column:
    """Log-probability of the row's class; a label outside the classes is an error."""
    wrong = F.raise_error(F.concat(F.lit("label out of range: "), F.coalesce(label.cast("string"), F.lit("NULL"))))
    unscored = F.raise_error(F.lit("a row has no scores"))
    return F.coalesce(F.get(logp, label), F.when(logp.isNull(), unscored).otherwise(wrong))


def nll(df: DataFrame, logp: str, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean negative log-probability, over all rows or per group: ``(*by, loss, n)``."""
    loss = -_own_class(F.col(logp), F.col(label))
    return df.groupBy(*by).agg(F.avg(loss).alias("loss"), F.count("*").alias("n"))


def cross_entropy(df: DataFrame, x: str, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The same from scores, which pass a log-softmax first."""
    return nll(df.select(*by, label, log_softmax(F.col(x)).alias("_logp")), "_logp", label, by)


def epoch_loss(steps: DataFrame, weighted: bool = False) -> DataFrame:
    """``(epoch, loss)``: plain mean of the step losses, or weighted by batch size."""
    plain = F.avg("loss")
    by_size = F.sum(F.col("loss") * F.col("batch_size")) / F.sum("batch_size")
    return steps.groupBy("epoch").agg((by_size if weighted else plain).alias("loss"))


def sample_steps(steps: DataFrame, every: int = LOG_EVERY) -> DataFrame:
    """Steps to log: each ``every``-th of an epoch and its last; steps count from 0."""
    last = steps.groupBy("epoch").agg(F.max("step").alias("_last"))
    due = ((F.col("step") + 1) % every == 0) | (F.col("step") == F.col("_last"))
    return steps.join(last, "epoch").where(due).drop("_last")
