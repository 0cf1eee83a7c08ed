"""Class labels: maps, attachment to documents, audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.joins import lookup_join
from textloom.operators.ordering import rank_rows

LABEL_SCHEMA = "label_id INT, label STRING"


def label_map(spark: SparkSession, classes: Sequence[str]) -> DataFrame:
    """``(label_id, label)``; the id of a class is its position."""
    return spark.createDataFrame([(i, c) for i, c in enumerate(classes)], LABEL_SCHEMA)


def label_map_from(df: DataFrame, col: str) -> DataFrame:
    """Class map of the distinct values of a column, in their order; any number of them."""
    found = df.select(F.col(col).cast("string").alias("label")).where("label IS NOT NULL").distinct()
    ranked = rank_rows(found, ["label"], "_rank")
    return ranked.select((F.col("_rank") - 1).cast("int").alias("label_id"), "label")


def encode_labels(df: DataFrame, labels: DataFrame, col: str, out: str = "label_id") -> DataFrame:
    """Name to id; an unknown name gets NULL."""
    names = labels.select(F.col("label").alias(col), F.col("label_id").alias(out))
    return lookup_join(df, names, col, spread=None)


def decode_labels(df: DataFrame, labels: DataFrame, col: str, out: str = "label") -> DataFrame:
    """Id to name; an unknown id gets NULL."""
    ids = labels.select(F.col("label_id").alias(col), F.col("label").alias(out))
    return lookup_join(df, ids, col, spread=None)


def num_classes(labels: DataFrame | None) -> int:
    return 0 if labels is None else labels.count()


def attach_labels(docs: DataFrame, labels: DataFrame, on: str = "doc_id", how: str = "left") -> DataFrame:
    """Add the label columns to each document by key."""
    return docs.join(labels, on, how)


def audit_labels(docs: DataFrame, labels: DataFrame, classes: int, label_col: str = "label") -> DataFrame:
    """``(doc_id, label, issue)`` for every label that cannot be used as it is.

    ``missing``: a document without label; ``orphan``: a label without document;
    ``duplicate``: a document with several labels; ``out_of_range``: an id outside
    ``0..classes-1`` or NULL. The first three carry no label.
    """
    label = F.col(label_col).cast("int")
    wrong = labels.where(label.isNull() | (label < 0) | (label >= classes)).select(
        "doc_id", label.alias("label"), F.lit("out_of_range").alias("issue")
    )
    counted = labels.groupBy("doc_id").agg(F.count("*").alias("n_labels"))
    known = docs.select("doc_id", F.lit(True).alias("has_doc"))
    both = known.join(counted, "doc_id", "full")
    issues = F.array_compact(
        F.array(
            F.when(F.col("n_labels").isNull(), "missing"),
            F.when(F.col("has_doc").isNull(), "orphan"),
            F.when(F.col("n_labels") > 1, "duplicate"),
        )
    )
    keyed = both.select("doc_id", F.lit(None).cast("int").alias("label"), F.explode(issues).alias("issue"))
    return keyed.unionByName(wrong)
