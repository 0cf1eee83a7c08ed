"""Session for local runs, and the shared folder for tables a job writes on its way."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


# Paths given out within the innermost ``cleaned`` block.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def local_session(app: str = "textloom", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder of the session.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session without
    one gets a temporary folder; on a cluster such a folder would not be shared.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not re.match(r"local(\[|$)", context.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
        root = context.getCheckpointDir()
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Remove what the block has put under ``work_path`` when it ends, also by an error.

    Tables that were made in the block cannot be read after it; write what is to stay elsewhere,
    or under a path taken before.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            remove_path(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so later jobs do not repeat its work."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of a finished run from the shared storage."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
