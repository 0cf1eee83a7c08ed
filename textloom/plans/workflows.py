"""Whole jobs made of the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.encoding import MAX_LENGTH
from textloom.functions.math import layer_norm
from textloom.operators.batching import assign_batches
from textloom.operators.head import CLASSIFIER_BIAS, CLASSIFIER_WEIGHT, NORM_EPS, Head, head_vector, predict, score_head
from textloom.operators.joins import BROADCAST_ENTRIES
from textloom.operators.labels import encode_labels, label_map_from
from textloom.operators.optimizer import AdamParams
from textloom.operators.ordering import build_order_index
from textloom.operators.tokens import build_vocab, encode, encoded_lengths, tokenize
from textloom.operators.training import BATCH_SIZE, EPOCHS, train_head
from textloom.operators.vectors import pool_tokens
from textloom.session import stored
from textloom.sources.parameters import matrix


def packed_batches(
    docs: DataFrame, vocab_size: int, batch_size: int, max_length: int = MAX_LENGTH
) -> DataFrame:
    """Encode a corpus and batch it: ``(doc_id, input_ids, attention_mask, seqlen, batch_id, slot)``.

    Batches follow ``doc_id``. The ranges of the order come from the key column of the corpus,
    and only the encoded rows are shuffled, never the texts.
    """
    vocab = build_vocab(tokenize(docs), vocab_size)
    encoded = encode(docs, vocab, max_length, vocab_size=vocab_size)
    index = build_order_index(docs.select("doc_id"), "doc_id")
    return assign_batches(encoded, "doc_id", batch_size, index)


def packed_lengths(docs: DataFrame, batch_size: int, max_length: int = MAX_LENGTH) -> DataFrame:
    """The same without ids, ``(doc_id, seqlen, batch_id, slot)``: no vocabulary is built."""
    lengths = encoded_lengths(docs, max_length).select("doc_id", "seqlen")
    index = build_order_index(docs.select("doc_id"), "doc_id")
    return assign_batches(lengths, "doc_id", batch_size, index)


def packing_report(batches: DataFrame) -> DataFrame:
    """One row per batch: documents, tokens without padding, longest sequence."""
    return batches.groupBy("batch_id").agg(
        F.count("*").alias("n_docs"),
        F.sum("seqlen").alias("total_tokens"),
        F.max("seqlen").alias("max_seqlen"),
    )


def document_vectors(
    docs: DataFrame,
    token_vectors: DataFrame,
    dims: int,
    vocab_size: int,
    pooling: str = "mean",
    max_length: int = MAX_LENGTH,
    keep: tuple[str, ...] = (),
    limit: int = BROADCAST_ENTRIES,
    norm: Sequence[float] | None = None,
    eps: float = NORM_EPS,
) -> DataFrame:
    """``(doc_id, *keep, pooled)``: vectors of the encoded tokens, pooled per document.

    ``pooling`` is ``"cls"`` or ``"mean"``; see ``pool_tokens`` for small and large vector tables.
    With the weights ``norm``, the vectors are normalised before they are looked up and the
    pooled ones once more, as the model does around its embedding.
    """
    if norm is not None:
        weight = F.lit([float(w) for w in norm])
        normed = token_vectors.withColumn("vector", layer_norm(F.col("vector"), weight, eps))
        plain = document_vectors(docs, normed, dims, vocab_size, pooling, max_length, keep, limit)
        return plain.withColumn("pooled", layer_norm(F.col("pooled"), weight, eps))
    vocab = build_vocab(tokenize(docs), vocab_size)
    encoded = encode(docs, vocab, max_length, vocab_size=vocab_size, keep=keep)
    return pool_tokens(encoded, token_vectors, pooling, dims, ["doc_id", *keep], limit=limit)


@dataclass(frozen=True)
class TrainedClassifier:
    predictions: DataFrame
    params: DataFrame
    metrics: DataFrame


def train_document_classifier(
    docs: DataFrame,
    label_col: str,
    token_vectors: DataFrame,
    head: Head,
    vocab_size: int,
    hp: AdamParams,
    epochs: int = EPOCHS,
    batch_size: int = BATCH_SIZE,
    pooling: str = "mean",
    input: str = "probs",
    optimizer_lifetime: str = "run",
) -> TrainedClassifier:
    """Encode, pool, train the classifier layer of ``head`` and classify the corpus with it.

    The pooled vectors are stored once; training and prediction read them, not the texts.
    """
    classes = label_map_from(docs, label_col)
    vectors = document_vectors(docs, token_vectors, head.dense.shape[1], vocab_size, pooling, keep=(label_col,))
    samples = stored(encode_labels(vectors, classes, label_col), "samples")
    featured = head_vector(samples, "pooled", head)
    params, metrics = train_head(
        featured.withColumnRenamed("label_id", "target"),
        head.weight,
        head.bias,
        hp,
        epochs,
        batch_size,
        label="target",
        input=input,
        optimizer_lifetime=optimizer_lifetime,
    )
    trained = Head(
        head.norm, head.dense, matrix(params, CLASSIFIER_WEIGHT), np.ravel(matrix(params, CLASSIFIER_BIAS)), head.eps
    )
    scored = predict(score_head(samples, "pooled", trained), classes)
    return TrainedClassifier(scored.select("doc_id", label_col, "predicted_label", "probs"), params, metrics)
