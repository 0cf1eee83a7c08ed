"""The stateless operators on a stream of documents.

Encoding with a small vocabulary, scoring, prediction and the column functions keep no state
and start no job, so they take a streaming DataFrame as they are. Only reading and writing
differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DOCUMENT_SCHEMA = "doc_id BIGINT, text STRING"


def stream_documents(
    spark: SparkSession, path: str, schema: str = DOCUMENT_SCHEMA, max_files: int | None = None
) -> DataFrame:
    """``(doc_id, text, ...)`` from Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def write_stream(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the rows to Parquet files; ``trigger`` as for ``DataStreamWriter.trigger``."""
    writer = rows.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start(path)
