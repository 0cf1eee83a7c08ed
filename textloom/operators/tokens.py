"""From text to fixed-length id and mask arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.encoding import (
    CLS_ID,
    MAX_LENGTH,
    PAD_ID,
    RESERVED_IDS,
    SEP_ID,
    TOKEN_PATTERN,
    UNK_ID,
    add_special_ids,
    attention_mask,
    content_length,
    first_tokens,
    pad,
    token_array,
)
from textloom.operators.joins import BROADCAST_ROWS, fits_broadcast
from textloom.operators.vocab_file import StoredVocab, store_vocab, stored_id_arrays, stored_ids

# Tokens looked up, or ids summed, at a time within a task.
TOKENS_AT_ONCE = 250_000


def tokenize(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = TOKEN_PATTERN
) -> DataFrame:
    """``(doc_id, pos, token)``, positions from 0."""
    return df.select(id_col, F.posexplode(token_array(F.col(text_col), pattern)).alias("pos", "token"))


def build_vocab(tokens: DataFrame, max_size: int, min_count: int = 1) -> DataFrame:
    """``(token, token_id, n)`` of the most frequent tokens, by count and then by token.

    Counts are combined before the shuffle. Before the final sort, tokens whose count is too
    short in binary digits to reach the top are left out, so that the sort sees a small
    multiple of ``max_size`` rows and not every distinct token.
    """
    counts = tokens.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    digits = F.length(F.bin("n"))
    per_length = counts.groupBy(digits.alias("digits")).agg(F.count("*").alias("tokens"))
    longer_first = Window.orderBy(F.desc("digits"))  # at most 64 rows
    above = F.sum("tokens").over(longer_first) - F.col("tokens")
    needed = per_length.withColumn("above", above).where(F.col("above") < max_size)
    threshold = needed.agg(F.min("digits")).scalar()
    top = counts.where(digits >= threshold).orderBy(F.desc("n"), "token").limit(max_size)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))  # at most max_size rows
    return top.select("token", (rank + F.lit(RESERVED_IDS - 1)).alias("token_id"), "n")


def lookup_ids(
    tokens: DataFrame,
    vocab: DataFrame | StoredVocab,
    unk_id: int = UNK_ID,
    vocab_size: int | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``token_id``; a token outside the vocabulary gets ``unk_id``.

    A vocabulary of up to ``limit`` entries is broadcast. A larger one, or one that is stored
    already, is read by the tasks themselves, and no token is shuffled.
    """
    if not isinstance(vocab, StoredVocab):
        ids = vocab.select("token", "token_id")
        if fits_broadcast(ids, vocab_size, limit):
            joined = tokens.join(F.broadcast(ids), "token", "left")
            return joined.select(*tokens.columns, F.coalesce("token_id", F.lit(unk_id)).alias("token_id"))
        vocab = store_vocab(ids)
    return tokens.withColumn("token_id", stored_ids(vocab, F.col("token"), unk_id))


def small_vocab(vocab: DataFrame, vocab_size: int | None = None, limit: int = BROADCAST_ROWS) -> pa.Table | None:
    """The whole vocabulary if it has at most ``limit`` entries, else None."""
    if limit < 1 or (vocab_size or 0) > limit:
        return None
    table = vocab.select("token", "token_id").limit(limit + 1).toArrow()
    return table.combine_chunks() if len(table) <= limit else None


def id_array_lookup(spark: SparkSession, table: pa.Table, unk_id: int = UNK_ID):
    """A function from a token array to its id array, for a vocabulary that is small enough.

    The vocabulary is held by every worker and looked up ``TOKENS_AT_ONCE`` tokens at a time, so
    encoding a document needs no shuffle and what is held beside a batch does not grow with it.
    """
    names = table["token"].combine_chunks() if len(table) else pa.array([], pa.string())
    known = spark.sparkContext.broadcast((names, table["token_id"].to_numpy().astype(np.int32)))

    @F.arrow_udf("array<int>")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, numbers = known.value
        numbers = np.append(numbers, np.int32(unk_id))
        for tokens in (part for batch in batches for part in parts_of_lists(batch, TOKENS_AT_ONCE)):
            slots = pc.fill_null(pc.index_in(tokens.flatten(), value_set=names), len(names))
            lengths = pc.list_value_length(tokens).to_numpy()
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers[slots.to_numpy()]))

    return look_up


def encoded_lengths(
    df: DataFrame,
    max_length: int = MAX_LENGTH,
    add_special: bool = True,
    id_col: str | Sequence[str] = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    pattern: str = TOKEN_PATTERN,
) -> DataFrame:
    """``(doc_id, *keep, attention_mask, seqlen)`` as ``encode`` gives them; lengths need no vocabulary."""
    room = content_length(max_length, add_special)
    size = F.size(first_tokens(F.col(text_col), room, pattern)) + F.lit(max_length - room)
    sized = df.select(*_names(id_col), *keep, size.alias("seqlen"))
    return sized.select(*_names(id_col), *keep, attention_mask(F.col("seqlen"), max_length).alias("attention_mask"), "seqlen")


def encode(
    df: DataFrame,
    vocab: DataFrame | StoredVocab,
    max_length: int = MAX_LENGTH,
    pad_id: int = PAD_ID,
    unk_id: int = UNK_ID,
    cls_id: int = CLS_ID,
    sep_id: int = SEP_ID,
    add_special: bool = True,
    id_col: str | Sequence[str] = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    pattern: str = TOKEN_PATTERN,
    vocab_size: int | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(doc_id, *keep, input_ids, attention_mask, seqlen)``, both arrays ``max_length`` long.

    One row for each input row, also where ids repeat; ``id_col`` may be several columns. A
    vocabulary of up to ``limit`` entries is held by every worker, and the encoding is one
    projection. A larger one, or one that is stored already, is read by the tasks themselves
    (see ``vocab_file``); that is one projection too, and the result is the same. ``vocab_size`` is the bound the vocabulary was built with, if known.
    """
    names, room = _names(id_col), content_length(max_length, add_special)
    cut = df.select(*names, *keep, first_tokens(F.col(text_col), room, pattern).alias("_tokens"))
    cut = cut.withColumn("seqlen", F.size("_tokens") + F.lit(max_length - room))
    table = None if isinstance(vocab, StoredVocab) else small_vocab(vocab, vocab_size, limit)
    if table is not None:
        coded = cut.withColumn("ids", id_array_lookup(df.sparkSession, table, unk_id)(F.col("_tokens")))
    else:
        store = vocab if isinstance(vocab, StoredVocab) else store_vocab(vocab)
        coded = cut.withColumn("ids", stored_id_arrays(store, F.col("_tokens"), unk_id))
    ids = add_special_ids(F.col("ids"), cls_id, sep_id) if add_special else F.col("ids")
    return coded.select(
        *names,
        *keep,
        pad(ids, max_length, pad_id).alias("input_ids"),
        attention_mask(F.col("seqlen"), max_length).alias("attention_mask"),
        "seqlen",
    )


def parts_of_lists(lists: pa.Array, entries: int) -> Iterator[pa.Array]:
    """The rows of a list array in parts with about ``entries`` entries, a longer row alone."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(), dtype=np.int64)
    start = 0
    while start < len(lists):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + entries, side="right")))
        yield lists.slice(start, stop - start)
        start = stop
    if not len(lists):
        yield lists


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)
