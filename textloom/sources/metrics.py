"""Training metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_SCHEMA = "run_id STRING, epoch INT, step INT, batch_size BIGINT, loss DOUBLE"
STEP = ["run_id", "epoch", "step"]


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Append step or epoch metrics, one folder per run; steps that are there already are left out.

    A repeated write, after a failure or of overlapping steps, adds nothing twice: the first
    figures of a step stay. Only the keys of the runs in question are read again. NULL keys are
    keys like others. One writer at a time writes a run.
    """
    new = metrics.dropDuplicates(STEP)
    spark = metrics.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        there = read_metrics(spark, path).select(*[F.col(c).alias(f"_{c}") for c in STEP])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in STEP]
        new = new.join(there, same[0] & same[1] & same[2], "left_anti")
    new.write.mode("append").partitionBy("run_id").parquet(path)


def read_metrics(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    metrics = spark.read.schema(METRIC_SCHEMA).parquet(path)
    return metrics if run_id is None else metrics.where(F.col("run_id") == run_id)


def metric_sink(path: str):
    """For ``writeStream.foreachBatch``: a batch that comes again after a restart changes nothing."""
    return lambda batch, number: write_metrics(batch, path)
