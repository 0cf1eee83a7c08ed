"""Text corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    multi_line: bool | None = None,
    schema: str | None = None,
) -> DataFrame:
    """``(doc_id, text, *keep)`` from Parquet or CSV with a header.

    For CSV, ``multi_line`` must be chosen: quoted line breaks need it, and it makes a file
    one task; without it large files are split. ``schema`` gives the types of all columns of a
    CSV; by default the id is a number and all else text.
    """
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    elif fmt == "csv":
        if multi_line is None:
            raise ValueError("say whether quoted line breaks occur (multi_line)")
        if schema is None:
            names = spark.read.option("header", True).csv(path).columns
            schema = ", ".join(f"`{n}` {'BIGINT' if n == id_col else 'STRING'}" for n in names)
        raw = (
            spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", multi_line)
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .csv(path)
        )
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return raw.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), *keep)
